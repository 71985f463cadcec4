"""Training that validation rows stop, its errors per tree; bucketed tables scanned without a shuffle."""

import random

from pyspark.sql import functions as F

from tidemark.operators import ml as M
from tidemark.operators import series as S
from tidemark.sources.bucketed import month_of, write_bucketed


def test_validation_stops_training_and_errors_are_those_of_the_predictions(spark, tmp_path):
    rng = random.Random(1)
    rows = [(float(i % 40), rng.uniform(0, 1), float((i % 40) * 2) + rng.gauss(0, 6), ("train", "train", "val", "test")[i % 4]) for i in range(400)]
    df = spark.createDataFrame(rows, "open double, noise double, target_price double, split string")
    params = {"maxIter": 30, "maxDepth": 3, "stepSize": 0.3}
    model, n, errors = M.fit_with_validation(df, ["open", "noise"], params=params, tolerance=0.05, checkpoint_every=4)
    assert 1 <= n < 30
    got = {(r["iteration"], r["split"]): r["mse"] for r in errors.collect()}
    assert set(got) == {(i, s) for i in range(1, n + 1) for s in ("train", "val")} and got[n, "train"] <= got[1, "train"]
    path = str(tmp_path / "pred")
    model.transform(df).select("split", "target_price", "prediction").write.parquet(path)
    stored = {r["split"]: r for r in M.stored_errors(spark, path).collect()}
    sql = spark.sql(f"SELECT split, avg(pow(target_price - prediction, 2)) AS mse, avg(abs(target_price - prediction)) AS mae "
                    f"FROM parquet.`{path}` GROUP BY split").collect()
    assert {r["split"] for r in sql} == {"train", "val", "test"}
    for r in sql:
        assert abs(stored[r["split"]]["mse"] - r["mse"]) < 1e-9 and abs(stored[r["split"]]["mae"] - r["mae"]) < 1e-9
    assert all(abs(got[n, s] - stored[s]["mse"]) < 1e-6 for s in ("train", "val"))
    # the scaling knows the training rows alone
    wide = df.withColumn("open", F.when(F.col("split") == "val", F.col("open") * 100).otherwise(F.col("open")))
    again, _, _ = M.fit_with_validation(wide, ["open", "noise"], params={**params, "maxIter": 2})
    assert again.stages[1].originalMax[0] == 37.0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_over_a_bucketed_table_need_no_exchange(spark, tmp_path):
    rng = random.Random(2)
    rows = [("HOT" if rng.random() < 0.4 else f"S{i % 9}", f"2024-{1 + i % 12:02d}-{1 + i // 12 % 28:02d}", rng.choice([None, 1.0, 2.0, 4.0]))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "symbol string, date string, close double").dropDuplicates(["symbol", "date"])
    df = df.withColumn("month", month_of())
    df.write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    t = write_bucketed(df, "test_bars", ["symbol", "month"], ["date"], 6, str(tmp_path / "bars"))
    assert t.count() == df.count()
    plans = []
    plain = S._stage
    S._stage = lambda d: (plans.append((d.columns, _plan(d))), plain(d))[1]
    try:
        got = S.fused_scan(t, ["symbol"], ["date"], F.col("month"), pct=[("close", "ret")], ffill=["close"])
        rows = sorted(map(tuple, got.select("symbol", "date", "close", "ret").collect()), key=repr)
    finally:
        S._stage = plain
    first = next(p for c, p in plans if "date" in c)
    assert "Window" in first and "Exchange" not in first
    want = S.fused_scan(df, ["symbol"], ["date"], None, pct=[("close", "ret")], ffill=["close"])
    assert rows == sorted(map(tuple, want.select("symbol", "date", "close", "ret").collect()), key=repr)
    # the hot symbol lies in several buckets, a month in one
    where = t.select("symbol", "month", F.input_file_name().alias("f")).distinct()
    assert where.where("symbol = 'HOT'").select("f").distinct().count() > 2
    assert where.groupBy("symbol", "month").count().agg(F.max("count")).first()[0] == 1
    # a rebuild replaces the table
    assert write_bucketed(df.limit(10), "test_bars", ["symbol", "month"], ["date"], 6, str(tmp_path / "bars2")).count() == 10
    spark.sql("DROP TABLE test_bars")


def test_training_reads_the_stored_frame_and_computes_it_once(spark, tmp_path):
    from tidemark.plans import ml_queries as Q
    (spark.range(600).selectExpr("id event_id", "timestamp_seconds(1704067200 + id * 3600) ts", "id % 7 user_id",
                                 "element_at(array('click', 'view', 'error', 'purchase', 'signup'), cast(id % 5 + 1 as int)) event_type",
                                 "100.0D + id % 31 value", "'{}' props").write.parquet(str(tmp_path / "events.parquet")))
    d = str(tmp_path)
    for frame, keys in ((Q._features(spark, d), {"date", "symbol"}), (Q._feature_frame(spark, d), {"date", "symbol", "target_price", "split"})):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and not any(step in plan for step in ("Exchange", "Window", "Join", "ExistingRDD"))
        assert keys <= set(frame.columns) and frame.count()
    assert Q._feature_frame(spark, d).inputFiles() == Q._feature_frame(spark, d).inputFiles()
    assert Q.q_ml_split_rows(spark, d).count() == Q._feature_frame(spark, d).count()
