"""Offset ledger: which records of a topic are stored, as intervals of offsets.

Of each (source, topic, partition) the ledger holds the disjoint intervals of offsets
that the table holds. It grows with partitions and gaps, not with records: a stream in
order is one interval a partition. A batch is held against the ledger and the ledger
grown by the batch's offsets, both in windows over spans of ``SPAN`` offsets, so no
partition's batch is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Offsets of a span.
SPAN = 65_536
LEDGER = (T.StructType().add("source", T.StringType()).add("topic", T.StringType()).add("partition", T.IntegerType())
          .add("lo", T.LongType()).add("hi", T.LongType()))
_KEY = ["source", "topic", "partition"]


def _spans(offset: F.Column) -> F.Column:
    return F.floor(offset / F.lit(SPAN))


def intervals(records: DataFrame) -> DataFrame:
    """Intervals of the offsets of ``records`` (source, topic, partition, offset), cut at spans; null offsets are left out."""
    rows = records.where("offset is not null").select(*_KEY, "offset", _spans(F.col("offset")).alias("_span")).distinct()
    by = Window.partitionBy(*_KEY, "_span").orderBy("offset")
    rows = rows.withColumn("_run", F.col("offset") - F.row_number().over(by))
    return rows.groupBy(*_KEY, "_span", "_run").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi")).select(*LEDGER.names)


def merged(ledger: DataFrame, more: DataFrame) -> DataFrame:
    """The ledger with more intervals (any, overlapping or touching ones too), disjoint again.

    Intervals are merged within the span they begin in; of each span one row tells how far its intervals
    reach, and from the rows of the spans before follows which interval goes on from an earlier one. Only
    these rows (one a span) are gone through partition by partition.
    """
    rows = ledger.unionByName(more).withColumn("_span", _spans(F.col("lo")))
    by = Window.partitionBy(*_KEY, "_span").orderBy("lo", "hi")
    before = F.max("hi").over(by.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_begins", (F.coalesce(F.col("lo") > before + 1, F.lit(True))).cast("int"))
    rows = rows.withColumn("_run", F.sum("_begins").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    runs = rows.groupBy(*_KEY, "_span", "_run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    # the runs of a span do not touch each other: those within what earlier spans reach come first, and all
    # of these belong to the last run that begins in an earlier span
    earlier = Window.partitionBy(*_KEY).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    ends = runs.groupBy(*_KEY, "_span").agg(F.max("lo").alias("_last"), F.max("hi").alias("_hi"))
    ends = ends.withColumn("_reach", F.max("_hi").over(earlier))
    ends = ends.withColumn("_from", F.max(F.when(F.coalesce(F.col("_last") > F.col("_reach") + 1, F.lit(True)), F.col("_last"))).over(earlier))
    names = [*_KEY, "_span"]
    ends = ends.select(*[F.col(k).alias(f"_of_{k}") for k in names], "_reach", "_from")
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in names]
    runs = runs.join(ends, same).withColumn("_at", F.when(F.col("lo") <= F.col("_reach") + 1, F.col("_from")).otherwise(F.col("lo")))
    return runs.groupBy(*_KEY, "_at").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select(*LEDGER.names)


def not_stored(records: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row of each (source, topic, partition, offset) that the ledger does not hold; rows without an offset all stay.

    A span's records and the intervals within it go through one window: a
    record is stored if an interval that began at or before it reaches it. Of records of one offset an
    arbitrary one stays (a redelivered record is the same record).
    """
    columns = records.columns
    rows = records.withColumns({"_span": _spans(F.col("offset")), "_lo": F.col("offset"), "_hi": F.lit(None).cast("long")})
    touched = rows.where("offset is not null").select(*_KEY, "_span").distinct()
    # intervals of the batch's spans only, cut to them
    held = ledger.join(touched, _KEY).where((F.col("lo") < (F.col("_span") + 1) * SPAN) & (F.col("hi") >= F.col("_span") * SPAN))
    held = held.select(*_KEY, "_span", F.greatest("lo", F.col("_span") * SPAN).alias("_lo"), F.col("hi").alias("_hi"))
    both = rows.unionByName(held, allowMissingColumns=True)
    by = Window.partitionBy(*_KEY, "_span").orderBy("_lo", F.col("_hi").desc_nulls_last())
    reach = F.max("_hi").over(by.rowsBetween(Window.unboundedPreceding, 0))
    first = F.row_number().over(Window.partitionBy(*_KEY, "_span", "_lo").orderBy(F.col("_hi").desc_nulls_last()))
    fresh = (both.where("_lo is not null").withColumns({"_reach": reach, "_nth": first})
             .where("_hi is null and _nth = 1 and coalesce(_reach < _lo, true)"))
    return fresh.select(*columns).unionByName(records.where("offset is null"))
