"""Envelope router, decoding and flattening."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.envelope import (decode_json, flatten_posts, normalize_bars,
                                         to_envelope, to_json_value)
from tidemark import schemas

NOW = "2024-01-31T00:00:00"


def _records(spark, rows):
    return spark.createDataFrame(
        [(t, 0, i, 1000 + i, v) for i, (t, v) in enumerate(rows)],
        "topic string, partition int, offset bigint, timestamp_ms bigint, value string")


def test_router_branches(spark):
    recs = _records(spark, [
        ("prices_raw", json.dumps({"symbol": "MSFT", "closing_price": 1.5, "opening_price": 1.0,
                                   "high": 2.0, "low": 0.5, "volume": 10.0, "timestamp": "2024-01-02"})),
        ("sentiment_scored", json.dumps({"company": "microsoft", "text": "x", "sentiment": "NEGATIVE",
                                         "id": "a", "timestamp": "2024-01-02T10:00:00"})),
        ("twitter_raw", json.dumps({"company": "microsoft", "text": "t", "id": "b", "timestamp": ""})),
        ("alerts", json.dumps({"symbol": "", "company": "nvidia", "k": 1})),
        ("alerts", json.dumps("plain")),
        ("prices_raw", "not json"),
    ])
    env = to_envelope(recs, ingest_ts=NOW, keep_dead_letters=True)
    got = {r["kafka_offset"]: r for r in env.collect()}
    assert got[0]["data"]["type"] == "price" and got[0]["symbol"] == "MSFT"
    assert got[0]["data"]["closing_price"] == 1.5 and got[0]["timestamp"] == "2024-01-02"
    assert got[1]["data"]["type"] == "sentiment" and got[1]["symbol"] == "microsoft"
    assert got[1]["data"]["sentiment_label"] == "NEGATIVE"          # D3 fallback
    assert got[1]["data"]["sentiment_score"] is None
    assert got[2]["data"]["type"] == "twitter_raw" and got[2]["timestamp"] == NOW   # falsy -> now
    assert got[3]["data"]["type"] == "unknown_topic" and got[3]["symbol"] == "nvidia"
    assert json.loads(got[3]["data"]["payload"])["k"] == 1
    assert got[4]["data"]["type"] == "unknown" and got[4]["symbol"] is None
    assert got[4]["timestamp"] == NOW and got[4]["data"]["payload"] == '"plain"'
    assert got[5]["data"]["type"] == "dead_letter"
    assert to_envelope(recs, ingest_ts=NOW).count() == 5


def test_decode_objects_only(spark):
    recs = _records(spark, [("prices_raw", '{"symbol": "A", "closing_price": 2}'),
                            ("prices_raw", '"plain"'), ("prices_raw", "nope")])
    out = decode_json(recs, schemas.PRICE).collect()
    assert len(out) == 1 and out[0]["symbol"] == "A" and out[0]["closing_price"] == 2.0


def test_flatten_posts(spark):
    df = spark.createDataFrame(
        [("tesla", ("c1", ("2024-01-01T10:00:00Z", "hi"), None, 3, None, 1)),
         ("tesla", ("c2", (None, None), 1, None, 2, None))],
        T.StructType([T.StructField("company", T.StringType()),
                      T.StructField("post", schemas.POST)]))
    out = {r["id"]: r for r in flatten_posts(df).collect()}
    assert out["c1"]["timestamp"] == "2024-01-01" and out["c1"]["replyCount"] == 0
    assert out["c2"]["timestamp"] == "unknown" and out["c2"]["text"] == ""
    assert out["c2"]["likeCount"] == 0 and out["c2"]["quoteCount"] == 0


def test_normalize_and_json(spark):
    df = spark.createDataFrame([("A", "2024-01-02 10:00:00", 1.005, 2.675, 3.0, 1.0, 7.123)],
                               "symbol string, ts string, close double, open double, high double, low double, volume double")
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    r = normalize_bars(df).collect()[0]
    assert r["timestamp"] == "2024-01-02" and r["volume"] == 7.12
    v = to_json_value(spark.createDataFrame([("a", None)], "x string, y string")).collect()[0][0]
    assert v == '{"x":"a"}'                              # NULL fields omitted (C11)


def test_blanks_in_front_of_an_object(spark):
    """All of JSON's blanks may stand before an object; other white space makes no JSON."""
    from tidemark.operators.envelope import decode_json, to_envelope
    from tidemark.schemas import PRICE, TOPIC_RECORD
    body = '{"symbol": "S", "closing_price": 1.5, "timestamp": "2024-01-01"}'
    fronts = ["", " ", "\n", "\t", "\r\n", " \n\t\r "]
    rows = [("prices_raw", 0, i, 1, f + body) for i, f in enumerate(fronts)]
    rows += [("prices_raw", 0, 90, 1, "\n[1]"), ("prices_raw", 0, 91, 1, '\t"{"'), ("prices_raw", 0, 92, 1, "\n"), ("prices_raw", 0, 93, 1, None)]
    recs = spark.createDataFrame(rows, TOPIC_RECORD)
    kinds = {r["kafka_offset"]: r["type"] for r in to_envelope(recs, "t", keep_dead_letters=True).select("kafka_offset", "data.type").collect()}
    assert kinds == {**dict.fromkeys(range(len(fronts)), "price"), 90: "unknown", 91: "unknown", 92: "dead_letter", 93: "dead_letter"}
    got = decode_json(recs, PRICE).collect()
    assert sorted(r["offset"] for r in got) == list(range(len(fronts)))
    assert all(r["closing_price"] == 1.5 and r["symbol"] == "S" for r in got)
