"""Streaming jobs on file sources with availableNow: restart, redelivery
de-duplication, dead letters, and stream == batch."""

import json
import tempfile

from pyspark.sql import functions as F

from tidemark.operators.envelope import to_envelope
from tidemark.schemas import TOPIC_RECORD
from tidemark.streaming import jobs as P
from tidemark.streaming.sources import file_stream, kafka_options


def _write(spark, path, rows):
    spark.createDataFrame(rows, TOPIC_RECORD).write.mode("append").parquet(path)


def _msg(i, topic="twitter_raw", text="u shares tumble"):
    return (topic, 0, i, 1_700_000_000_000 + i,
            json.dumps({"id": str(i), "company": "u", "timestamp": "2024-01-01T00:00:00", "text": text}))


def test_kafka_options():
    o = kafka_options("b:9092", ["a", "b"])
    assert o["subscribe"] == "a,b" and o["startingOffsets"] == "earliest"
    assert o["failOnDataLoss"] == "false"


def test_scored_stream_restart(spark):
    base = tempfile.mkdtemp()
    src, out, ck = base + "/src", base + "/out", base + "/ck"
    _write(spark, src, [_msg(i) for i in range(3)] + [("twitter_raw", 0, 3, 1, "not json")])

    def once():
        s = P.scored_stream(file_stream(spark, src))
        P.run(s.writeStream.format("parquet").option("path", out), ck)
    once()
    assert spark.read.parquet(out).count() == 3
    _write(spark, src, [_msg(i, text="record day") for i in range(10, 12)])
    once()                                               # only the new file is read
    got = spark.read.parquet(out)
    assert got.count() == 5
    assert {r["sentiment"] for r in got.where("offset >= 10").collect()} == {"POSITIVE"}


def test_envelope_stream_dedupes_redelivery(spark):
    base = tempfile.mkdtemp()
    src, out, ck = base + "/src", base + "/out", base + "/ck"
    rows = [_msg(i) for i in range(4)]
    _write(spark, src, rows)
    _write(spark, src, rows[:2] + [("twitter_raw", 0, 9, 1_700_000_000_009, "bad")])  # redelivered + dead letter
    P.start_envelope_job(file_stream(spark, src, max_files_per_trigger=1), out, ck)
    t = spark.read.parquet(out)
    assert t.where("doc_type = 'twitter_raw'").count() == 4
    assert t.where("doc_type = 'dead_letter'").count() == 1


def test_index_writer_dead_letters(spark):
    base = tempfile.mkdtemp()
    df = spark.createDataFrame([("a", 1), (None, 2)], "id string, v int")
    P.index_writer(base + "/idx", base + "/dead")(df, 0)
    assert spark.read.parquet(base + "/idx").count() == 1
    assert spark.read.parquet(base + "/dead").select("error").first()[0] == "missing document id"


def test_topic_counts_state(spark):
    base = tempfile.mkdtemp()
    src, out, ck = base + "/src", base + "/out", base + "/ck"
    _write(spark, src, [_msg(i) for i in range(3)])
    _write(spark, src, [_msg(i, topic="prices_raw") for i in range(3, 5)])
    c = P.topic_counts_stream(file_stream(spark, src, max_files_per_trigger=1))
    P.run(c.writeStream.outputMode("update").foreachBatch(P.batch_dir_writer(out)), ck)
    _write(spark, src, [_msg(i) for i in range(5, 7)])
    c = P.topic_counts_stream(file_stream(spark, src, max_files_per_trigger=1))
    P.run(c.writeStream.outputMode("update").foreachBatch(P.batch_dir_writer(out)), ck)
    got = {r["topic"]: r["n_rows"] for r in P.latest_per_key(out, spark, ["topic"]).collect()}
    assert got == {"twitter_raw": 5, "prices_raw": 2}     # state survived the restart


def test_dead_letter_split(spark):
    recs = spark.createDataFrame([("t", 0, 1, 1, "{}"), ("t", 0, 2, 1, "x"), ("t", 0, 3, 1, None)],
                                 TOPIC_RECORD)
    good, bad = P.dead_letter_split(recs)
    assert good.count() == 1 and bad.count() == 2


def test_observed_counts_listener(spark):
    import time
    base = tempfile.mkdtemp()
    src, out, ck = base + "/src", base + "/out", base + "/ck"
    _write(spark, src, [_msg(i) for i in range(4)])
    _write(spark, src, [_msg(i) for i in range(4, 7)])
    obs = P.ObservedCounts()
    spark.streams.addListener(obs.listener)
    try:
        s = P.scored_stream(file_stream(spark, src, max_files_per_trigger=1))
        P.run(s.writeStream.format("parquet").option("path", out), ck)
        for _ in range(50):                       # progress events arrive asynchronously
            if obs.totals.get("records") == 7:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(obs.listener)
    assert obs.totals.get("twitter_raw") == 7 and obs.totals.get("records") == 7
    assert len(obs.batches) >= 2


def test_late_and_shuffled_files_lose_nothing(spark):
    """Records hours apart in many files of arbitrary order: the sinks equal the batch result."""
    import random

    from tidemark.operators.envelope import to_envelope
    base = tempfile.mkdtemp()
    src, out, ck = base + "/src", base + "/out", base + "/ck"
    hour = 3_600_000
    rows = [("sentiment_scored", i % 3, i, 1_700_000_000_000 + i * 7 * hour, json.dumps(
        {"id": str(i), "company": f"c{i % 4}", "text": "x", "sentiment_label": "positive" if i % 2 else "negative",
         "sentiment_score": i / 10, "timestamp": f"2024-01-{1 + i % 28:02d}T10:00:00"})) for i in range(60)]
    random.Random(3).shuffle(rows)
    for k in range(0, 60, 5):
        _write(spark, src, rows[k:k + 5])
    _write(spark, src, rows[10:20])                     # redelivered, long after
    P.start_envelope_job(file_stream(spark, src, max_files_per_trigger=2), out, ck)
    t = spark.read.parquet(out)
    assert t.count() == 60 and t.select("kafka_offset").distinct().count() == 60
    assert "event_date" in t.columns
    env = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", "3").parquet(out)
    P.start_daily_sentiment(env, base + "/daily", base + "/ck2")
    got = P.read_daily_sentiment(spark, base + "/daily")
    recs = spark.createDataFrame(rows, TOPIC_RECORD)
    want = P.merge_sentiment_partials(P.sentiment_partials(to_envelope(recs)))
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert got.agg(F.sum("sentiment_count")).first()[0] == 60


def test_a_new_query_does_not_overwrite_an_older_ones_batches(spark):
    base = tempfile.mkdtemp()
    src, out = base + "/src", base + "/out"
    _write(spark, src, [_msg(i) for i in range(3)])
    for ck in ("/ck1", "/ck2"):
        s = file_stream(spark, src)
        P.run(s.writeStream.foreachBatch(P.batch_dir_writer(out)), base + ck)
    assert spark.read.parquet(out).select("query_id").distinct().count() == 2


def test_client_index_writer_keeps_errors(spark):
    base = tempfile.mkdtemp()
    df = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "id string, v int")

    def send(docs):
        return [None if x["id"] else "no id" for x in docs]
    P.client_index_writer(send, base + "/dead")(df, 0)
    dead = spark.read.parquet(base + "/dead").collect()
    assert [(r["v"], r["error"]) for r in dead] == [(2, "no id")]


def test_scoring_from_topic_to_topic(spark):
    """The broker's reader and writer by stand-ins of their shape; their options as a broker takes them."""
    from tidemark.streaming.sources import index_source
    base = tempfile.mkdtemp()
    _write(spark, base + "/src", [_msg(i) for i in range(3)] + [_msg(9, topic="prices_raw")])
    asked = []

    def source(spark, servers, topics, **kw):
        asked.append(kafka_options(servers, topics, **kw))
        return file_stream(spark, base + "/src")
    P.start_topic_scoring(spark, "b:9092", ["twitter_raw"], "sentiment_scored", base + "/ck", source, "json", {"path": base + "/out"},
                          available_now=True, max_offsets_per_trigger=500)
    rows = [json.loads(r["value"]) for r in spark.read.json(base + "/out").collect()]
    assert len(rows) == 3 and {r["sentiment"] for r in rows} == {"NEGATIVE"}
    assert asked == [{"kafka.bootstrap.servers": "b:9092", "subscribe": "twitter_raw", "startingOffsets": "earliest",
                      "failOnDataLoss": "false", "maxOffsetsPerTrigger": "500"}]
    assert P.kafka_sink_options("b:9092", "t") == {"kafka.bootstrap.servers": "b:9092", "topic": "t"}
    import inspect
    assert inspect.signature(index_source).parameters["starting"].default == "latest"


def test_topic_writer(spark):
    base = tempfile.mkdtemp()
    df = spark.createDataFrame([("a", 1)], "id string, v int")
    P.topic_writer({"path": base + "/t"}, fmt="json")(df, 0)
    assert json.loads(spark.read.json(base + "/t").first()["value"]) == {"id": "a", "v": 1}
