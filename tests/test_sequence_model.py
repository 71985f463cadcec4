"""Sequence prediction with a saved linear model, its statuses; groups streamed in pieces."""

import random
import tempfile

import numpy as np
import pandas as pd
import pytest

from tidemark.operators import sequence_model as M
from tidemark.operators.grouped import per_key_stream

FEATURES, LENGTH = ["open", "close"], 4
WEIGHTS = [[0.1, -0.2], [0.3, 0.0], [-0.4, 0.5], [0.25, 0.125]]


def _frame(spark):
    rng = random.Random(4)
    rows = [(s, f"2024-01-{k + 1:02d}", rng.uniform(10, 20), rng.uniform(5, 9)) for s, n in (("A", 12), ("B", 4), ("C", 3), ("D", 8), ("E", 6))
            for k in range(n)]
    rows = [(s, d, o, None if s == "D" and d == "2024-01-07" else c) for s, d, o, c in rows]
    rows += [(None, "2024-01-01", 1.0, 1.0)]
    return rows, spark.createDataFrame(rows, "symbol string, date string, open double, close double").repartition(5)


def _artefact(train):
    return M.fit_artefact(train, FEATURES, "open", LENGTH, "tidemark.operators.sequence_model.LinearSequenceModel",
                          {"weights": WEIGHTS, "bias": 0.05})


def test_all_symbols_in_one_job_exactly(spark):
    rows, frame = _frame(spark)
    train = frame.where("date <= '2024-01-05' and symbol is not null")
    path = tempfile.mkdtemp() + "/artefact"
    _artefact(train).save(spark, path)
    _artefact(train).save(spark, path)              # replaced
    art = M.SequenceArtefact.load(spark, path)
    assert art == _artefact(train)
    wanted = spark.createDataFrame([("A",), ("B",), ("C",), ("D",), ("Z",), ("A",), (None,)], "symbol string")
    got = {r["symbol"]: r for r in M.predict_sequences(frame, art, wanted).collect()}
    assert {s: r["status"] for s, r in got.items()} == {"A": "ok", "B": "ok", "C": "too_short", "D": "incomplete", "Z": "unknown"}
    assert got["Z"]["n_rows"] == 0 and got["Z"]["last_date"] is None and got["C"]["n_rows"] == 3
    lim = {c: (min(v), max(v)) for c, v in (("open", [r[2] for r in rows if r[0] and r[1] <= "2024-01-05"]),
                                           ("close", [r[3] for r in rows if r[0] and r[1] <= "2024-01-05"]))}
    for s in ("A", "B"):
        last = sorted(r for r in rows if r[0] == s)[-LENGTH:]
        y = 0.05 + sum(WEIGHTS[i][j] * ((r[2 + j] - lim[c][0]) / (lim[c][1] - lim[c][0]) * 2 - 1)
                       for i, r in enumerate(last) for j, c in enumerate(FEATURES))
        want = (y + 1) / 2 * (lim["open"][1] - lim["open"][0]) + lim["open"][0]
        assert abs(got[s]["prediction"] - want) < 1e-9 and got[s]["last_date"] == last[-1][1]
    assert all(got[s]["prediction"] is None for s in "CDZ")
    assert sorted(r["symbol"] for r in M.predict_sequences(frame, art).collect()) == list("ABCDE")


def test_constant_features_and_missing_artefacts(spark):
    art = M.SequenceArtefact(["open"], "open", 1, {"min_open": 3.0, "max_open": 3.0}, "x.y", {})
    assert art.scaled(np.array([[[3.0]], [[9.0]]])).tolist() == [[[-1.0]], [[-1.0]]] and art.unscaled(np.array([0.7])).tolist() == [3.0]
    with pytest.raises(Exception):
        M.SequenceArtefact.load(spark, "/nowhere/at/all")


def test_empty_frame(spark):
    _, frame = _frame(spark)
    art = _artefact(frame.where("symbol is not null"))
    assert M.predict_sequences(frame.limit(0), art).count() == 0
    wanted = spark.createDataFrame([("A",)], "symbol string")
    assert [tuple(r) for r in M.predict_sequences(frame.limit(0), art, wanted).collect()] == [("A", None, 0, "unknown", None)]


def test_a_worker_builds_a_model_once(spark):
    _, frame = _frame(spark)
    art = _artefact(frame.where("symbol is not null"))
    M._BUILT.clear()
    assert M.built(art) is M.built(_artefact(frame.where("symbol is not null")))


def test_streamed_groups_equal_plain_ones(spark):
    def total(key, pieces):
        n, last, longest = 0, None, 0
        for p in pieces:
            v = p["v"].tolist()
            assert v == sorted(v) and (last is None or last <= v[0])
            n, last, longest = n + len(v), v[-1], max(longest, len(v))
        yield pd.DataFrame({"k": [key[0]], "j": [key[1]], "n": [n], "last": [last], "piece": [longest]})

    rng = random.Random(5)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None]), rng.choice([1, 2, None]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, j int, v long").repartition(6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = per_key_stream(df, ["k", "j"], total, "k string, j int, n long, last long, piece long", ["v"]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {(r["k"], r["j"]): (r["n"], r["m"]) for r in df.groupBy("k", "j").agg({"v": "max", "*": "count"}).toDF("k", "j", "m", "n").collect()}
    assert {(r["k"], r["j"]): (r["n"], r["last"]) for r in got} == want and len(got) == len(want)
    # a group of very many rows is never one frame
    assert max(r["piece"] for r in got) <= 100 and max(r["n"] for r in got) > 600


def test_streamed_groups_may_be_left_early(spark):
    df = spark.range(500).selectExpr("id % 5 AS k", "id AS v")

    def first(key, pieces):
        yield next(pieces).head(1)[["k", "v"]]
        if key[0] == 3:
            yield pd.DataFrame({"k": [3], "v": [-1]})
    got = per_key_stream(df, ["k"], first, "k long, v long", ["v"]).collect()
    assert sorted(map(tuple, got)) == [(0, 0), (1, 1), (2, 2), (3, -1), (3, 3), (4, 4)]

    def none(key, pieces):
        return iter(())
    assert per_key_stream(df, ["k"], none, "k long, v long").count() == 0
    assert per_key_stream(df.limit(0), ["k"], first, "k long, v long").count() == 0
