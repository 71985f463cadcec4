"""Helpers the corpus operators share: staging, blocks of a group, scratch names."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

#: Rows that go to a Python task at once: whole texts are long.
ARROW_ROWS = 1000

#: Setting by which an execution's shuffle files go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def python_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows of an Arrow batch, so that a batch of long texts stays small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor recomputes nothing before it) and gives
    later readers one fixed copy. An empty frame keeps its schema. The shuffle files of
    the write go as soon as it is done, not when the driver's memory is next cleaned.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{name}") + "/data"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def discard(staged: DataFrame) -> None:
    """Delete a staged table that nothing reads any more (all that was made from it is staged itself)."""
    spark = staged.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(staged._staged_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, or the first ``name_2``, ``name_3`` ... that is not among ``taken``
    (column names compare without case, as Spark resolves them)."""
    low = {c.lower() for c in taken}
    out, i = name, 2
    while out.lower() in low:
        out, i = f"{name}_{i}", i + 1
    return out


def in_blocks(df: DataFrame, keys: list[str], block: int, order: str, weight: str | None = None,
              heaviest: int = 0) -> DataFrame:
    """Deal the rows of each group (rows of equal ``keys``) to pairs of blocks.

    A group of n rows is cut into s = ceil(n / block) blocks by a hash of
    ``order``; a row of block b goes to every pair (b, x). So any two rows of a
    group meet in exactly one pair of blocks (rows of one block in the pair
    (b, b)), a pair holds about 2 x block rows however large the group is, and
    a group with at most ``block`` rows (nearly all) is one pair of one block.
    With ``weight`` a block also weighs about ``heaviest`` at most (one row may weigh more). Adds
    ``_bi``, ``_bj`` (the pair, _bi <= _bj) and ``_b`` (the row's block); drops groups of one row.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), (F.sum(weight) if weight else F.lit(0)).alias("_w")).where("_n > 1")
    out = df.join(sizes, keys)
    s = F.ceil(F.col("_n") / F.lit(block)).cast("int")
    if weight:
        s = F.least(F.greatest(s, F.ceil(F.col("_w") / F.lit(heaviest)).cast("int")), F.col("_n").cast("int"))
    out = out.withColumn("_s", s).withColumn(
        "_b", F.pmod(F.xxhash64(F.col(order), F.lit(17)), F.col("_s")).cast("int"))
    out = out.withColumn("_x", F.explode(F.expr("sequence(0, _s - 1)")))
    return (out.withColumn("_bi", F.least("_b", "_x")).withColumn("_bj", F.greatest("_b", "_x"))
            .drop("_x", "_n", "_w", "_s"))


def each_group(batches, keys: list[str]):
    """From sorted pandas batches, a dict of numpy arrays for each run of equal ``keys``.

    A group may go over several batches; only its own rows are held.
    """
    held: list[dict] = []
    last = None
    for batch in batches:
        cols = {c: batch[c].to_numpy() for c in batch.columns}
        n = len(batch)
        if not n:
            continue
        change = np.zeros(n, dtype=bool)
        for k in keys:
            change[1:] |= cols[k][1:] != cols[k][:-1]
        first = tuple(cols[k][0] for k in keys)
        cuts = np.flatnonzero(change).tolist() + [n]
        start = 0
        if held and first != last:
            yield _joined(held)
            held = []
        for cut in cuts:
            part = {c: v[start:cut] for c, v in cols.items()}
            if cut < n:
                yield _joined(held + [part]) if held else part
                held = []
            else:
                held.append(part)
            start = cut
        last = tuple(cols[k][n - 1] for k in keys)
    if held:
        yield _joined(held)


def _joined(parts: list[dict]) -> dict:
    return parts[0] if len(parts) == 1 else {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
