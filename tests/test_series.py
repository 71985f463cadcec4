"""Time-series operators against a pandas oracle on random frames with NULLs,
gaps, zeros and hot keys; the two-pass (bucketed) and chunked paths must equal
the plain single-window results."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.dates import month_bucket
from tidemark.operators import series as S


def _frame(seed, n_keys=4, n=120, hot=True):
    rnd = random.Random(seed)
    rows = []
    for k in range(n_keys):
        m = n * (6 if hot and k == 0 else 1)        # key 0 is a hot key
        for i in range(m):
            day = f"2024-{1 + (i // 28) % 12:02d}-{1 + i % 28:02d}"
            day = f"{2024 + i // 336}-{day[5:]}"
            v = rnd.choice([None, 0.0, rnd.uniform(1, 100), rnd.uniform(1, 100)])
            s = rnd.choice([None, None, rnd.uniform(-1, 1)])
            rows.append((f"K{k}", day, i, v, s))
    return rows


def _df(spark, rows):
    return spark.createDataFrame(rows, "symbol string, date string, tie long, close double, sent double")


def _pandas(rows):
    p = pd.DataFrame(rows, columns=["symbol", "date", "tie", "close", "sent"])
    return p.sort_values(["symbol", "date", "tie"]).reset_index(drop=True)


def _eq(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return b is not None and abs(a - b) <= 1e-9 * max(1.0, abs(a))


@pytest.mark.parametrize("bucket", [None, "month"])
def test_pct_change_and_ffill(spark, bucket):
    rows = _frame(1)
    b = month_bucket("date") if bucket else None
    df = _df(spark, rows)
    got = S.pct_change(df, "close", "ret", ["symbol"], ["date", "tie"], b)
    got = S.forward_fill(got, ["sent"], ["symbol"], ["date", "tie"], b)
    got = {(r["symbol"], r["tie"]): r for r in got.collect()}
    p = _pandas(rows)
    padded = p.groupby("symbol")["close"].ffill()
    prev = padded.groupby(p["symbol"]).shift(1)
    ret = padded / prev.where(prev != 0) - 1
    fill = p.groupby("symbol")["sent"].ffill()
    for i, r in p.iterrows():
        g = got[(r["symbol"], r["tie"])]
        assert _eq(ret.iloc[i], g["ret"]), (i, ret.iloc[i], g["ret"])
        assert _eq(fill.iloc[i], g["sent"])


@pytest.mark.parametrize("bucket", [None, "month"])
def test_next_value_positions_cumprod(spark, bucket):
    rows = [r for r in _frame(2) if r[3] not in (None, 0.0)]
    b = month_bucket("date") if bucket else None
    df = _df(spark, rows)
    nv = {(r["symbol"], r["tie"]): r["nx"] for r in
          S.next_value(df, "close", "nx", ["symbol"], ["date", "tie"], b).collect()}
    pos = {(r["symbol"], r["tie"]): (r["rn"], r["n"]) for r in
           S.positions(df, ["symbol"], ["date", "tie"], b).collect()}
    cum = {(r["symbol"], r["tie"]): r["cum_close"] for r in
           S.cumulative_return(df, ["close"], ["symbol"], ["date", "tie"], b).collect()}
    p = _pandas(rows)
    p["nx"] = p.groupby("symbol")["close"].shift(-1)
    p["rn"] = p.groupby("symbol").cumcount() + 1
    p["n"] = p.groupby("symbol")["close"].transform("size")
    r = p.groupby("symbol")["close"].pct_change()
    p["cum"] = (1 + r).groupby(p["symbol"]).cumprod()
    for _, row in p.iterrows():
        key = (row["symbol"], row["tie"])
        assert _eq(row["nx"], nv[key])
        assert pos[key] == (row["rn"], row["n"])
        if not math.isnan(row["cum"]):
            assert _eq(row["cum"], cum[key])
        else:
            assert key not in cum


def test_chunked_windows_equal_plain(spark):
    rows = [r for r in _frame(3) if r[3] is not None]
    df = _df(spark, rows)
    b = month_bucket("date")
    plain = {(r["symbol"], r["tie"]): r["m"] for r in
             S.rolling_mean(df, "sent", 3, "m", ["symbol"], ["date", "tie"]).collect()}
    chunk = {(r["symbol"], r["tie"]): r["m"] for r in
             S.rolling_mean(df, "sent", 3, "m", ["symbol"], ["date", "tie"], b, chunk_rows=7).collect()}
    assert plain.keys() == chunk.keys()
    assert all(_eq(plain[k], chunk[k]) for k in plain)
    a = S.sequence_windows(df, 4, ["close", "sent"], "close", ["symbol"], ["date", "tie"]).collect()
    c = S.sequence_windows(df, 4, ["close", "sent"], "close", ["symbol"], ["date", "tie"], bucket=b,
                           chunk_rows=5).collect()
    norm = lambda rs: sorted((r["symbol"], r["idx"], r["first_date"], r["last_date"], r["label_date"],
                              str(r["x"]), r["y"]) for r in rs)
    assert norm(a) == norm(c)


def test_sequence_rule_and_latest(spark):
    # N rows -> N - L windows; the last full window is excluded; N <= L -> none
    rows = [("A", f"2024-01-{d:02d}", d, float(d), None) for d in range(1, 8)] + \
           [("B", f"2024-01-{d:02d}", d, float(d), None) for d in range(1, 4)]
    df = _df(spark, rows)
    seq = S.sequence_windows(df, 3, ["close"], "close", ["symbol"], ["date"]).collect()
    a = sorted((r["idx"], [e["close"] for e in r["x"]], r["y"], r["label_date"])
               for r in seq if r["symbol"] == "A")
    assert [x[0] for x in a] == [0, 1, 2, 3]
    assert a[0][1] == [1.0, 2.0, 3.0] and a[0][2] == 3.0 and a[0][3] == "2024-01-04"
    assert not [r for r in seq if r["symbol"] == "B"]
    lat = {r["symbol"]: r for r in S.latest_sequence(df, 3, ["close"]).collect()}
    assert [e["close"] for e in lat["A"]["x"]] == [5.0, 6.0, 7.0]
    assert lat["B"]["n_rows"] == 3 and lat["B"]["first_date"] == "2024-01-01"


def test_pct_change_padding_example(spark):
    df = spark.createDataFrame([("A", "1", 10.0), ("A", "2", None), ("A", "3", 20.0), ("A", "4", 0.0),
                                ("A", "5", 5.0)], "symbol string, date string, close double")
    got = [r["r"] for r in S.pct_change(df, "close", "r").orderBy("date").collect()]
    assert got[0] is None and got[1] == 0.0 and got[2] == 1.0 and got[3] == -1.0
    assert got[4] is None                                   # previous is 0 -> NULL (D16)


def test_range_buckets_equal_plain(spark):
    rows = _frame(5, n_keys=3, n=150)           # key 0 holds most rows
    df = _df(spark, rows).repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        nb = S.range_buckets(df, ["symbol"], ["date", "tie"]).where("symbol = 'K0'") \
            .select("_tm_bucket").distinct().count()
        assert nb > 1                           # the hot key is cut into several buckets
        _check_range(spark, df)
        cum_p = {(r["symbol"], r["tie"]): r["cum_close"] for r in
                 S.cumulative_return(df.where("close > 0"), ["close"], ["symbol"], ["date", "tie"]).collect()}
        cum_r = {(r["symbol"], r["tie"]): r["cum_close"] for r in
                 S.cumulative_return(df.where("close > 0"), ["close"], ["symbol"], ["date", "tie"],
                                     "range").collect()}
        assert cum_p.keys() == cum_r.keys() and all(_eq(cum_p[k], cum_r[k]) for k in cum_p)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _check_range(spark, df):
    kw = dict(keys=["symbol"], order=["date", "tie"], pct=[("close", "ret")], ffill=["sent"],
              nxt=[("close", "nx")], pos=("rn", "n"))
    plain = {(r["symbol"], r["tie"]): r for r in S.fused_scan(df, bucket=None, **kw).collect()}
    ranged = {(r["symbol"], r["tie"]): r for r in
              S.fused_scan(df.repartition(7), bucket="range", **kw).collect()}
    assert plain.keys() == ranged.keys()
    for k, a in plain.items():
        b = ranged[k]
        assert a["rn"] == b["rn"] and a["n"] == b["n"]
        assert _eq(a["ret"], b["ret"]) and _eq(a["sent"], b["sent"]) and _eq(a["nx"], b["nx"])


def test_chunked_windows_with_range_buckets(spark):
    rows = [r for r in _frame(6, n_keys=3, n=80) if r[3] is not None]
    df = _df(spark, rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plain = {(r["symbol"], r["tie"]): r["m"] for r in
                 S.rolling_mean(df, "sent", 4, "m", ["symbol"], ["date", "tie"]).collect()}
        ranged = {(r["symbol"], r["tie"]): r["m"] for r in
                  S.rolling_mean(df, "sent", 4, "m", ["symbol"], ["date", "tie"], "range",
                                 chunk_rows=9).collect()}
        assert plain.keys() == ranged.keys() and all(_eq(plain[k], ranged[k]) for k in plain)
        norm = lambda rs: sorted((r["symbol"], r["idx"], r["first_date"], r["last_date"],
                                  r["label_date"], str(r["x"]), r["y"]) for r in rs)
        a = S.sequence_windows(df, 3, ["close"], "close", ["symbol"], ["date", "tie"]).collect()
        c = S.sequence_windows(df, 3, ["close"], "close", ["symbol"], ["date", "tie"],
                               bucket="range", chunk_rows=6).collect()
        assert norm(a) == norm(c)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
