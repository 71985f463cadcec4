"""Cumulative returns share the range pass of the returns: one staged copy, equal to the plain window."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import series as S


def _frame(spark):
    rng = random.Random(6)
    rows = [(("hot" if rng.random() < 0.5 else f"s{i % 7}"), i, rng.choice([None, 0.0, 1.0, 2.5, 4.0]), rng.choice([None, 3.0, 5.0]))
            for i in range(900)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "symbol string, date long, a double, b double").repartition(6)


@pytest.mark.parametrize("bucket", ["range", "column"])
def test_equals_the_plain_window_and_stages_once(spark, bucket, monkeypatch):
    df = _frame(spark)
    spark.conf.set("spark.tidemark.range.partitions", "9")
    staged = []
    plain = S._stage
    monkeypatch.setattr(S, "_stage", lambda d: (staged.append(d.columns), plain(d))[1])
    try:
        got = S.cumulative_return(df, ["a", "b"], bucket="range" if bucket == "range" else F.col("date") % 1000 / 100)
        rows = sorted((r["symbol"], r["date"], round(r["ret_a"], 9), round(r["cum_a"], 9), round(r["cum_b"], 9)) for r in got.collect())
    finally:
        spark.conf.unset("spark.tidemark.range.partitions")
    want = S.cumulative_return(df, ["a", "b"])
    assert rows == sorted((r["symbol"], r["date"], round(r["ret_a"], 9), round(r["cum_a"], 9), round(r["cum_b"], 9)) for r in want.collect())
    assert len(rows) > 100
    # the rows once; the other staged frames are summaries, a row per symbol and bucket
    assert sum("date" in columns for columns in staged) == 1
    assert got.columns == want.columns


def test_small_tables_are_one_piece(spark):
    df = spark.range(1000).selectExpr("'s' AS symbol", "id AS date", "cast(id + 1 AS double) AS close")
    assert S.range_buckets(df, ["symbol"], ["date"]).select(F.col(S._B)).distinct().count() == 1
