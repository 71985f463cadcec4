"""Small relational operators: guards, counts, limits, schema completion
(F6, F7, G3, G7, G8, O4, C15, C16)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T



def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows with any NULL (or NaN) removed."""
    return df.na.drop(subset=list(subset) if subset else None)


def distinct_symbols(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Distinct keys (partial distinct on every task)."""
    return df.select(symbol).distinct()


def symbol_counts(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    return df.groupBy(symbol).agg(F.count(F.lit(1)).alias("n_rows"))


def eligible_symbols(df: DataFrame, min_rows: int, symbol: str = "symbol") -> DataFrame:
    """Keys with at least ``min_rows`` rows."""
    return symbol_counts(df, symbol).where(F.col("n_rows") >= min_rows)


def symbol_slice(df: DataFrame, symbol_value: str, min_rows: int,
                 symbol: str = "symbol") -> DataFrame:
    """the rows of one symbol, returned only if there are at least
    ``min_rows`` of them. The guard is a scalar subquery (one partial count),
    so no driver round trip and no window over the symbol. ``require_slice``
    raises the reference's errors instead."""
    rows = df.where(F.col(symbol) == symbol_value)
    n = rows.agg(F.count(F.lit(1))).scalar()
    return rows.where(n >= F.lit(min_rows))


def require_slice(df: DataFrame, symbol_value: str, min_rows: int,
                  symbol: str = "symbol") -> DataFrame:
    """F6 with the reference's errors: empty data, unknown symbol, too few rows."""
    stats = df.agg(F.count(F.lit(1)).alias("total"),
                   F.count(F.when(F.col(symbol) == symbol_value, 1)).alias("n")).first()
    if stats["total"] == 0:
        raise ValueError("No data found")
    if stats["n"] == 0:
        raise ValueError(f"Symbol {symbol_value} not found in the data")
    if stats["n"] < min_rows:
        raise ValueError(f"Insufficient data points for {symbol_value}. "
                         f"Found {stats['n']}, need {min_rows}")
    return df.where(F.col(symbol) == symbol_value)


def limit_per_key(df: DataFrame, key: str, order: Sequence[str], n: int) -> DataFrame:
    """At most ``n`` rows per key, first by ``order``. ``row_number() <= n``
    gets a partial group limit before the shuffle, so a hot key costs ``n``
    rows per map task, not its whole size."""
    w = Window.partitionBy(key).orderBy(*[F.col(c) for c in order])
    return (df.withColumn("rank_in_key", F.row_number().over(w).cast("bigint"))
              .where(F.col("rank_in_key") <= n))


def row_counts(df: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Total rows, or rows per group."""
    return df.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n_rows"))


TRAINING_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()), T.StructField("symbol", T.StringType()),
    T.StructField("open", T.DoubleType()), T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()), T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()), T.StructField("avg_sentiment", T.DoubleType())])


def complete_schema(df: DataFrame, schema: T.StructType = TRAINING_SCHEMA,
                    keep_extra: bool = False) -> DataFrame:
    """Add every missing column as a typed NULL, cast present ones,
    and select in the schema's order (an empty input stays a typed empty frame)."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    if keep_extra:
        cols += [F.col(c) for c in df.columns if c not in schema.fieldNames()]
    return df.select(*cols)
