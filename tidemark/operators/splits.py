"""Global row numbers and temporal train/validation/test splits.

The reference numbers rows with an unpartitioned ``Window.orderBy(date)``,
which moves every row into one task. Here the global number comes from a
range-partitioned sort: Spark samples the order key, so partitions stay
balanced even when one date (or key) holds a large share of the rows. Each
row gets its index inside its partition; the per-partition counts (one row
per partition, a proven small size) become offsets. The numbered frame is
checkpointed to the shared checkpoint folder so that both passes see the
same partitioning, and so a lost executor does not re-sample differently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOW33 = (1 << 33) - 1


def global_row_id(df: DataFrame, order: Sequence[str], out: str = "row_id",
                  partitions: int | None = None, checkpoint: bool = True) -> DataFrame:
    """1-based position of every row in the total order ``order``; adds
    ``out`` and ``n_rows`` (the total count, for split cut points)."""
    from tidemark.session import ensure_checkpoint_dir, range_partitioned
    spark = df.sparkSession
    cols = [F.col(c) for c in order]
    ranged = range_partitioned(df, *cols, partitions=partitions).sortWithinPartitions(*cols)
    tagged = ranged.withColumn("_tm_mid", F.monotonically_increasing_id())
    if checkpoint:
        ensure_checkpoint_dir(spark)
        tagged = tagged.checkpoint(eager=True)
    tagged = (tagged.withColumn("_tm_part", F.shiftright("_tm_mid", 33))
                    .withColumn("_tm_local", F.col("_tm_mid").bitwiseAND(F.lit(_LOW33))))
    counts = tagged.groupBy("_tm_part").agg(F.count(F.lit(1)).alias("_tm_cnt"))
    # one row per partition: a tiny frame, safe to order globally and broadcast
    w = Window.orderBy("_tm_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_tm_part",
        F.coalesce(F.sum("_tm_cnt").over(w), F.lit(0)).alias("_tm_off"),
        F.sum("_tm_cnt").over(Window.partitionBy()).alias("n_rows"))
    out_df = tagged.join(F.broadcast(offsets), "_tm_part")
    return (out_df.withColumn(out, (F.col("_tm_off") + F.col("_tm_local") + 1).cast("bigint"))
                  .drop("_tm_mid", "_tm_part", "_tm_local", "_tm_off"))


def split_label(row_id: Column, n: Column, additive: bool = False) -> Column:
    """'train' / 'val' / 'test' from a 1-based row number and the row count.

    ``additive=False``: cut at ``int(0.7 n)`` and ``int(0.85 n)``;
    ``additive=True``: at ``int(0.7 n)`` and ``int(0.7 n) + int(0.15 n)`` (D14).
    Doubles, not decimals, as in Python.
    """
    from tidemark.constants import TRAIN_FRACTION, VAL_END_FRACTION, VAL_FRACTION
    n = n.cast("double")
    train_end = F.floor(F.lit(TRAIN_FRACTION) * n)
    val_end = (train_end + F.floor(F.lit(VAL_FRACTION) * n)) if additive \
        else F.floor(F.lit(VAL_END_FRACTION) * n)
    return (F.when(row_id <= train_end, F.lit("train"))
             .when(row_id <= val_end, F.lit("val")).otherwise(F.lit("test")))


def temporal_split(df: DataFrame, order: Sequence[str], additive: bool = False,
                   per_key: Sequence[str] | None = None, bucket: Column | None = None,
                   checkpoint: bool = True) -> DataFrame:
    """Add ``row_id`` and ``split``.

    Global (the reference: one ordered series) unless ``per_key`` is given,
    in which case every key is split on its own rows.
    """
    if per_key:
        from tidemark.operators.series import positions
        t = positions(df, per_key, order, bucket, pos="row_id", total="n_rows")
    else:
        t = global_row_id(df, order, "row_id", checkpoint=checkpoint)
    return t.withColumn("split", split_label(F.col("row_id"), F.col("n_rows"), additive))
