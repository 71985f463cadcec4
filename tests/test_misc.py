"""Local ingest, simulated feature, console sink, batch fan-out, scorer protocol."""

import tempfile

import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators.envelope import load_bars
from tidemark.operators.ml import gbt_estimator, simulated_sentiment
from tidemark.operators.scoring import LexiconScorer, Scorer, batch_score
from tidemark.schemas import TOPIC_RECORD
from tidemark.streaming import jobs as P
from tidemark.streaming.sources import file_stream


def test_local_frame_ingest_arrow(spark):
    pdf = pd.DataFrame({"Date": pd.to_datetime(["2024-01-02", "2024-01-03"]),
                        "Open": [1.0, 2.0], "Close": [1.5, 2.5]})
    df = load_bars(spark.createDataFrame(pdf))            # A6/A7 (Arrow enabled in session)
    assert df.columns == ["date", "open", "close"]
    assert [r["date"] for r in df.orderBy("date").collect()] == ["2024-01-02", "2024-01-03"]


def test_simulated_sentiment_range_and_stability(spark):
    df = spark.range(200).withColumn("symbol", F.lit("A"))
    a = simulated_sentiment(df, key=["id"]).collect()
    b = simulated_sentiment(df, key=["id"]).collect()
    assert a == b and all(-1.0 <= r["avg_sentiment"] < 1.0 for r in a)
    r = simulated_sentiment(df, seed=7).agg(F.min("avg_sentiment"), F.max("avg_sentiment")).first()
    assert -1.0 <= r[0] and r[1] < 1.0


def test_console_and_fan_out(spark):
    base = tempfile.mkdtemp()
    src = base + "/src"
    spark.createDataFrame([("twitter_raw", 0, 1, 1, '{"id": "1", "text": "moon"}')],
                          TOPIC_RECORD).write.parquet(src)
    s = P.scored_stream(file_stream(spark, src))
    P.run(P.console_writer(s), base + "/ck_console")      # B2 (prints the batch)
    sink = P.fan_out(P.json_value_writer(base + "/values"), P.topic_count_writer(base + "/counts"))
    P.run(s.writeStream.foreachBatch(sink), base + "/ck")
    assert spark.read.json(base + "/values").count() == 1
    assert spark.read.parquet(base + "/counts").first()["n_rows"] == 1


def test_pluggable_scorer_loaded_once_per_worker(spark):
    class Upper(Scorer):
        def score(self, texts):
            lab = texts.map(lambda t: None if t is None else ("POSITIVE" if t.isupper() else "NEUTRAL"))
            return lab, lab.map(lambda x: None if x is None else (1.0 if x == "POSITIVE" else 0.0))
    df = spark.createDataFrame([("A", "LOUD"), ("B", "quiet"), ("C", None)], "k string, text string")
    got = {r["k"]: (r["sentiment_label"], r["sentiment_score"]) for r in batch_score(df, "text", Upper()).collect()}
    assert got == {"A": ("POSITIVE", 1.0), "B": ("NEUTRAL", 0.0), "C": (None, None)}
    lex = {r["k"]: r["sentiment_label"] for r in
           batch_score(df.withColumn("text", F.lower("text")), "text", LexiconScorer(["quiet"], ["loud"])).collect()}
    assert lex == {"A": "POSITIVE", "B": "NEGATIVE", "C": None}


def test_model_loads_once_a_worker(spark, tmp_path):
    import os

    class CountingScorer(Scorer):       # of the function, so it travels by value
        """Notes each load with its worker."""

        def __init__(self, folder):
            self.folder = folder

        def load(self):
            import os
            import uuid
            with open(f"{self.folder}/{os.getpid()}-{uuid.uuid4().hex}", "w"):
                pass

        def score(self, texts):
            return texts.map(lambda t: "NEUTRAL"), texts.map(lambda t: 0.0)
    df = spark.range(1200).selectExpr("cast(id as string) as text").repartition(12)
    batch_score(df, "text", CountingScorer(str(tmp_path))).write.format("noop").mode("overwrite").save()
    loads = [f.split("-")[0] for f in os.listdir(tmp_path)]
    assert loads and len(loads) == len(set(loads))


def test_repeated_updates_do_not_multiply_documents(spark):
    from tidemark.operators.envelope import to_envelope
    from tidemark.operators.scoring import apply_scores, score_updates
    recs = spark.createDataFrame([("twitter_raw", 0, i, 1, '{"id": "%d", "company": "c", "text": "great"}' % i)
                                  for i in range(5)],
                                 "topic string, partition int, offset long, timestamp_ms long, value string")
    env = to_envelope(recs, "2024-01-01T00:00:00")
    once = score_updates(env, "2024-01-02")
    both = once.unionByName(score_updates(env, "2024-01-03"))
    got = apply_scores(env, both)
    assert got.count() == 5
    assert {r[0] for r in got.select("data.processed_at").collect()} == {"2024-01-03"}


def test_scratch_needs_a_shared_folder_on_a_cluster():
    import pytest

    from tidemark.session import _local_folder

    class Context:
        master = "spark://somewhere:7077"
    with pytest.raises(ValueError):
        _local_folder(Context())


def test_gbt_estimator_small(spark):
    df = spark.createDataFrame([(float(i), float(i % 3), float(2 * i)) for i in range(30)],
                               "open double, avg_sentiment double, target_price double")
    m = gbt_estimator(["open", "avg_sentiment"], params={"maxIter": 3}).fit(df)
    assert m.transform(df).where(F.col("prediction").isNull()).count() == 0
