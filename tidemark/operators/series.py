"""Per-key time-series operators.

All operators take the key columns (usually ``symbol``), a *total* order
(date plus tie-breakers, D8) and work per key.

Skew. A plain ``Window.partitionBy(symbol)`` sends one symbol's whole series
to one task; if one symbol holds a third of all rows that task is the job.
Every scan here therefore accepts ``bucket``: ``"range"`` (the partitions of a
sampled range partitioning on (key, order), balanced under any skew), or a
column that is monotone in the order (e.g. ``month_bucket``). The scan then
runs in two passes, for all requested scans at once (``fused_scan``):

1. a window over ``(key, bucket)`` computes the in-bucket results, which are
   staged with ``checkpoint()`` in the shared checkpoint folder;
2. a one-row-per-bucket summary of the staged data (last value, count, first
   value, product) is carried across buckets by a window over the summaries
   (far smaller than the data) and joined back, by broadcast when its
   measured size is under ``BROADCAST_MAX_BYTES``, else by sort-merge join.

Bounded frames (sliding sequences, rolling means) use per-key positions from
the same scheme and run over fixed-size row chunks with an ``L - 1``-row halo
copied from the previous chunk, so no task ever holds more than
``chunk_rows + L`` rows of one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import safe_div

UNB = Window.unboundedPreceding

_B = "_tm_bucket"

# How the in-bucket pass of a two-pass scan is staged before its two readers
# (the per-bucket summary and the join back): "checkpoint" writes it once to
# the shared checkpoint folder (reliable, cuts lineage: the input is computed
# once, chained scans do not multiply their lineage, and a lost executor
# recomputes nothing upstream); "none" lets each reader recompute it (only
# sensible for tiny inputs; range buckets require "checkpoint").
MATERIALIZE = "checkpoint"


def _stage(df: DataFrame) -> DataFrame:
    if MATERIALIZE == "checkpoint":
        from tidemark.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    return df


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def _order_cols(order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in _cols(order)]


def _order_key(order) -> Column:
    return F.struct(*_order_cols(order))


# Upper bound for broadcasting a carry summary (one row per key and bucket).
BROADCAST_MAX_BYTES = 64 << 20


def _carry(local: DataFrame, keys: list[str], summary_aggs: list[Column],
           carry_exprs, staged: bool = False) -> DataFrame:
    """Summarise ``local`` per (key, bucket), carry across buckets, join back.

    ``staged``: ``local`` comes from a staged frame with these buckets, so it is read
    again and not written a second time (scans that build on each other
    share one range pass). The summary has one row per (key, bucket). It is staged, its size is
    measured, and it is broadcast only when the estimate stays under
    ``BROADCAST_MAX_BYTES``; beyond that the join back is a sort-merge join.
    """
    local = local if staged else _stage(local)
    summ = local.groupBy(*keys, _B).agg(*summary_aggs)
    ws = Window.partitionBy(*keys).orderBy(_B)
    summ = summ.select(*keys, _B, *carry_exprs(ws))
    if MATERIALIZE == "checkpoint":
        summ = _stage(summ)
        est = summ.count() * (32 + 16 * len(summ.columns))
        if est <= BROADCAST_MAX_BYTES:
            summ = F.broadcast(summ)
    return local.join(summ, [*keys, _B], "left")


# range buckets
def range_buckets(df: DataFrame, keys: Sequence[str], order) -> DataFrame:
    """Buckets that stay balanced under any skew: the partitions of a range
    partitioning on (key, order). Spark samples the bounds, so a key (or a
    key-month) holding a third of all rows is cut into many contiguous
    pieces; within a key, the partition id grows with the order, which is all
    the two-pass scheme needs. Requires staging (the id must not be
    recomputed), so it is only offered with ``MATERIALIZE == "checkpoint"``."""
    if MATERIALIZE != "checkpoint":
        raise ValueError('bucket="range" needs MATERIALIZE = "checkpoint"')
    from tidemark.session import range_partitioned
    ranged = range_partitioned(df, *[F.col(k) for k in keys], *_order_cols(order))
    return ranged.withColumn(_B, F.spark_partition_id())


# fused scan
def fused_scan(df: DataFrame, keys=("symbol",), order=("date",), bucket: Column | None = None,
               pct: Sequence[tuple[str, str]] = (), ffill: Sequence[str] = (),
               nxt: Sequence[tuple[str, str]] = (), pos: tuple[str, str | None] | None = None,
               keep_bucket: bool = False) -> DataFrame:
    """Several per-key scans in one pass over the data (``bucket``: a column
    monotone in the order, ``"range"`` for range-partition buckets, or None).

    * ``pct``: (column, output) padded percent changes (W1);
    * ``ffill``: columns forward-filled in place (W2);
    * ``nxt``: (column, output) next-row values (W3/W4);
    * ``pos``: (position, total) 1-based row number and row count (W5).

    All scans read the *input* columns (so returns are taken before the fill,
    as in the reference, D23). With ``bucket`` the two-pass scheme runs once
    for all of them: one window pass over (key, bucket), one summary row per
    bucket, one carry window, one join back. ``keep_bucket`` leaves the bucket's column
    for a scan that builds on this one.
    """
    keys = _cols(keys)
    ffill = _cols(ffill)
    for k in keys:                      # pandas group-by drops NULL keys
        df = df.where(F.col(k).isNotNull())
    names = df.columns
    part = [*keys, _B] if bucket is not None else keys
    if isinstance(bucket, str) and bucket == "range":
        df = range_buckets(df, keys, order)
    elif bucket is not None:
        df = df.withColumn(_B, bucket)
    w = Window.partitionBy(*part).orderBy(*_order_cols(order))
    run = w.rowsBetween(UNB, 0)
    sel = [F.last(c, ignorenulls=True).over(run).alias(c) if c in ffill else F.col(c) for c in names]
    if bucket is not None:
        sel.append(F.col(_B))
    for i, (c, _) in enumerate(pct):
        sel.append(F.last(c, ignorenulls=True).over(run).alias(f"_tm_c{i}"))
    for i, (c, _) in enumerate(nxt):
        sel.append(F.lead(c).over(w).alias(f"_tm_nx{i}"))
    if nxt:
        sel.append(F.lead(F.lit(1)).over(w).isNull().alias("_tm_last"))
    if pos:
        sel.append(F.row_number().over(w).cast("bigint").alias("_tm_lp"))
    t = df.select(*sel)
    if pct:
        t = t.select("*", *[F.lag(f"_tm_c{i}").over(w).alias(f"_tm_p{i}") for i in range(len(pct))])

    if bucket is None:
        fin = [F.col(c) for c in names]
        for i, (_, out) in enumerate(pct):
            fin.append((safe_div(F.col(f"_tm_c{i}"), F.col(f"_tm_p{i}")) - F.lit(1.0)).alias(out))
        for i, (_, out) in enumerate(nxt):
            fin.append(F.col(f"_tm_nx{i}").alias(out))
        if pos:
            fin.append(F.col("_tm_lp").alias(pos[0]))
            if pos[1]:
                fin.append(F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias(pos[1]))
        return t.select(*fin)

    ok = _order_key(order)
    aggs, carry = [], []
    for i in range(len(pct)):
        aggs.append(F.max_by(f"_tm_c{i}", ok).alias(f"_tm_pb{i}"))
        carry.append(lambda ws, i=i: F.last(f"_tm_pb{i}", ignorenulls=True)
                     .over(ws.rowsBetween(UNB, -1)).alias(f"_tm_pk{i}"))
    for i, c in enumerate(ffill):
        aggs.append(F.max_by(c, ok).alias(f"_tm_fb{i}"))
        carry.append(lambda ws, i=i: F.last(f"_tm_fb{i}", ignorenulls=True)
                     .over(ws.rowsBetween(UNB, -1)).alias(f"_tm_fk{i}"))
    for i, (c, _) in enumerate(nxt):
        aggs.append(F.min_by(c, ok).alias(f"_tm_nb{i}"))
        carry.append(lambda ws, i=i: F.lead(f"_tm_nb{i}").over(ws).alias(f"_tm_nk{i}"))
    if pos:
        aggs.append(F.count(F.lit(1)).alias("_tm_bn"))
        carry.append(lambda ws: F.coalesce(F.sum("_tm_bn").over(ws.rowsBetween(UNB, -1)),
                                           F.lit(0)).alias("_tm_off"))
        if pos[1]:
            carry.append(lambda ws: F.sum("_tm_bn").over(Window.partitionBy(*keys)).alias(pos[1]))
    j = _carry(t, keys, aggs, lambda ws: [f(ws) for f in carry])
    fidx = {c: i for i, c in enumerate(ffill)}
    fin = [F.coalesce(F.col(c), F.col(f"_tm_fk{fidx[c]}")).alias(c) if c in fidx else F.col(c)
           for c in names]
    for i, (_, out) in enumerate(pct):
        cur = F.coalesce(F.col(f"_tm_c{i}"), F.col(f"_tm_pk{i}"))
        prev = F.coalesce(F.col(f"_tm_p{i}"), F.col(f"_tm_pk{i}"))
        fin.append((safe_div(cur, prev) - F.lit(1.0)).alias(out))
    for i, (_, out) in enumerate(nxt):
        fin.append(F.when(F.col("_tm_last"), F.col(f"_tm_nk{i}"))
                    .otherwise(F.col(f"_tm_nx{i}")).alias(out))
    if pos:
        fin.append((F.col("_tm_lp") + F.col("_tm_off")).cast("bigint").alias(pos[0]))
        if pos[1]:
            fin.append(F.col(pos[1]).cast("bigint"))
    if keep_bucket:
        fin.append(F.col(_B))
    return j.select(*fin)


# W1
def pct_change(df: DataFrame, col: str, out: str = "daily_return", keys=("symbol",),
               order=("date",), bucket: Column | None = None) -> DataFrame:
    """``value / previous - 1`` per key, NULLs padded forward first.

    pandas ``pct_change`` pads: ``[10, null, 20] -> [null, 0, 1]``; a zero
    previous value gives NULL (D16), the first row of a key NULL.
    """
    return fused_scan(df, keys, order, bucket, pct=[(col, out)])


# W2
def forward_fill(df: DataFrame, cols: Sequence[str], keys=("symbol",), order=("date",),
                 bucket: Column | None = None) -> DataFrame:
    """Last non-NULL value per key, carried forward (W2); leading NULLs stay.

    Rows with a NULL key are dropped (pandas ``groupby`` drops them too).
    """
    return fused_scan(df, keys, order, bucket, ffill=cols)


# W3 / W4
def next_value(df: DataFrame, col: str, out: str = "target_price", keys=("symbol",),
               order=("date",), bucket: Column | None = None) -> DataFrame:
    """Value of ``col`` on the next row of the same key (W3 ``lead(open)``,
    W4 ``close.shift(-1)`` made per key, D9). NULL on a key's last row."""
    return fused_scan(df, keys, order, bucket, nxt=[(col, out)])


# W5 (per key)
def positions(df: DataFrame, keys=("symbol",), order=("date",), bucket: Column | None = None,
              pos: str = "rn", total: str | None = "n") -> DataFrame:
    """1-based row number per key (``pos``) and the key's row count (``total``)."""
    return fused_scan(df, keys, order, bucket, pos=(pos, total))


def _chunked(df: DataFrame, keys: list[str], halo: int, chunk_rows: int,
             pos: str = "rn", ahead: int = 0) -> DataFrame:
    """Split each key into chunks of ``chunk_rows`` positions; copy the last
    ``halo`` rows of every chunk into the next one and the first ``ahead`` rows
    into the previous one (copies carry ``_tm_own = false``)."""
    if chunk_rows <= max(halo, ahead):
        raise ValueError("chunk_rows must exceed the frame length")
    off = (F.col(pos) - 1) % F.lit(chunk_rows)
    ch = F.floor((F.col(pos) - 1) / F.lit(chunk_rows))
    out = df.withColumn("_tm_chunk", ch).withColumn("_tm_own", F.lit(True))
    if halo > 0:
        out = out.unionByName(
            df.where(off >= F.lit(chunk_rows - halo))
              .withColumn("_tm_chunk", ch + 1).withColumn("_tm_own", F.lit(False)))
    if ahead > 0:
        out = out.unionByName(
            df.where((off < F.lit(ahead)) & (ch > 0))
              .withColumn("_tm_chunk", ch - 1).withColumn("_tm_own", F.lit(False)))
    return out


# W11
def rolling_mean(df: DataFrame, col: str, k: int, out: str | None = None, keys=("symbol",),
                 order=("date",), bucket: Column | None = None,
                 chunk_rows: int = 100_000, pos: str | None = None) -> DataFrame:
    """Mean of ``col`` over the current and ``k - 1`` previous rows of the key.

    ``pos`` names an existing 1-based per-key position column (from
    ``positions``) so it is not computed twice.
    """
    keys = _cols(keys)
    out = out or f"{col}_mean_{k}"
    if bucket is None and pos is None:
        w = Window.partitionBy(*keys).orderBy(*_order_cols(order)).rowsBetween(-(k - 1), 0)
        return df.withColumn(out, F.avg(col).over(w))
    p = df if pos else positions(df, keys, order, bucket, pos="_tm_pos", total=None)
    pc = pos or "_tm_pos"
    c = _chunked(p, keys, k - 1, chunk_rows, pos=pc)
    w = Window.partitionBy(*keys, "_tm_chunk").orderBy(pc).rowsBetween(-(k - 1), 0)
    r = c.withColumn(out, F.avg(col).over(w)).where("_tm_own").drop("_tm_chunk", "_tm_own")
    return r if pos else r.drop("_tm_pos")


# W7 / W8
def sequence_windows(df: DataFrame, length: int, features: Sequence[str], target: str,
                     keys=("symbol",), order=("date",), date: str = "date",
                     bucket: Column | None = None, chunk_rows: int = 100_000,
                     pos: tuple[str, str] | None = None) -> DataFrame:
    """Sliding training sequences.

    For 0-based ``idx`` in ``0 .. N-L-1`` of each key: ``x`` = feature rows
    ``idx .. idx+L-1``, ``y`` = ``target`` of row ``idx+L-1``,
    ``first_date``/``last_date`` the dates of the window and ``label_date``
    the date of row ``idx+L`` (the reference's ``get_dates``). The last full
    window of a key is excluded (``N - L`` windows, as ``__len__`` says).
    Features are wrapped in a struct so NULLs survive ``collect_list``.
    """
    keys = _cols(keys)
    if pos:      # positions computed upstream (e.g. fused with the target scan)
        p = df.withColumnRenamed(pos[0], "_tm_pos").withColumnRenamed(pos[1], "_tm_n")
    else:
        p = positions(df, keys, order, bucket, pos="_tm_pos", total="_tm_n")
    feats = F.struct(*[F.col(f) for f in features])
    if bucket is None:
        c = p.withColumn("_tm_chunk", F.lit(0)).withColumn("_tm_own", F.lit(True))
    else:
        c = _chunked(p, keys, length - 1, chunk_rows, pos="_tm_pos", ahead=1)
    w = Window.partitionBy(*keys, "_tm_chunk").orderBy("_tm_pos")
    fr = w.rowsBetween(-(length - 1), 0)
    out = (c.withColumn("x", F.collect_list(feats).over(fr))
            .withColumn("first_date", F.first(date).over(fr))
            .withColumn("label_date", F.lead(date).over(w))
            .where(F.col("_tm_own") & (F.col("_tm_pos") >= length) &
                   (F.col("_tm_pos") <= F.col("_tm_n") - 1)))
    return out.select(*keys, (F.col("_tm_pos") - length).alias("idx"),
                      "first_date", F.col(date).alias("last_date"), "label_date", "x",
                      F.col(target).alias("y"))


# W9
def latest_sequence(df: DataFrame, length: int, features: Sequence[str], keys=("symbol",),
                    order=("date",), date: str = "date") -> DataFrame:
    """The newest ``length`` rows of every key as one ascending sequence.

    ``row_number() <= L`` lets Spark insert a partial per-task group limit
    before the shuffle, so a hot key ships at most ``L`` rows per map task.
    """
    keys = _cols(keys)
    desc = [c.desc() for c in _order_cols(order)]
    w = Window.partitionBy(*keys).orderBy(*desc)
    top = df.withColumn("_tm_r", F.row_number().over(w)).where(F.col("_tm_r") <= length)
    item = F.struct(_order_key(order).alias("_k"), F.struct(*[F.col(f) for f in features]).alias("f"),
                    F.col(date).alias("d"))
    agg = (top.groupBy(*keys)
              .agg(F.sort_array(F.collect_list(item)).alias("_tm_items"),
                   F.count(F.lit(1)).alias("n_rows")))
    return agg.select(*keys,
                      F.transform("_tm_items", lambda e: e["f"]).alias("x"),
                      F.col("_tm_items")[0]["d"].alias("first_date"),
                      F.element_at("_tm_items", -1)["d"].alias("last_date"),
                      "n_rows")


# W10
def cumulative_return(df: DataFrame, cols: Sequence[str], keys=("symbol",), order=("date",),
                      bucket: Column | None = None) -> DataFrame:
    """``cumprod(1 + pct_change)`` per key for each of ``cols``.

    As in the reference, the returns' NULLs (first row) are dropped first.
    Output columns ``ret_<c>`` and ``cum_<c>``.
    """
    keys = _cols(keys)
    cols = _cols(cols)
    t = fused_scan(df, keys, order, bucket, pct=[(c, f"ret_{c}") for c in cols], keep_bucket=bucket is not None)
    for c in cols:
        t = t.where(F.col(f"ret_{c}").isNotNull())
    growth = {c: F.lit(1.0) + F.col(f"ret_{c}") for c in cols}
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*_order_cols(order)).rowsBetween(UNB, 0)
        for c in cols:
            t = t.withColumn(f"cum_{c}", F.product(growth[c]).over(w))
        return t
    wb = Window.partitionBy(*keys, _B).orderBy(*_order_cols(order)).rowsBetween(UNB, 0)
    local = t       # in the buckets of the returns' scan, which is staged
    for c in cols:
        local = local.withColumn(f"_tm_lc_{c}", F.product(growth[c]).over(wb))
    j = _carry(local, keys,
               [F.product(growth[c]).alias(f"_tm_bp_{c}") for c in cols],
               lambda ws: [F.product(f"_tm_bp_{c}").over(ws.rowsBetween(UNB, -1))
                           .alias(f"_tm_cp_{c}") for c in cols], staged=True)
    for c in cols:
        j = j.withColumn(f"cum_{c}", F.col(f"_tm_lc_{c}") *
                         F.coalesce(F.col(f"_tm_cp_{c}"), F.lit(1.0)))
    return j.drop(_B, *[f"_tm_lc_{c}" for c in cols], *[f"_tm_cp_{c}" for c in cols])
