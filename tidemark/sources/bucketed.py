"""Bars and features as bucketed, sorted catalog tables (B6), so that scans by symbol need no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], order: Sequence[str], buckets: int, path: str) -> DataFrame:
    """(Re)build the catalog table ``name`` at ``path``, bucketed by ``keys`` and sorted by keys and ``order``; the table read.

    Rows are dealt to buckets before the write, so a bucket is one file. Take a span of time among the keys (symbol,
    month): one symbol with a third of all rows then lies in as many buckets as it has spans, and the
    scans of ``operators.series`` carry over from span to span (``bucket=F.col("month")``). A rebuild replaces the
    table; readers of the old one must be done.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys, *order).saveAsTable(name))
    return spark.table(name)


def month_of(date: str = "date"):
    """The month of a day string, as a span."""
    return F.substring(F.col(date), 1, 7)
