"""Train-fitted min/max scaling.

The fit is one aggregate row (``agg(min, max)`` is partial on every task).
Like Spark ML's own ``MinMaxScaler``, fitting yields a handful of parameters
(2 numbers per column) that are then applied as literals: one aggregate job,
no join, and no per-column subquery re-scanning the training split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def minmax_fit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: ``min_<c>``, ``max_<c>`` for every column (fit on the train split only)."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggs)


def _fit_row(fit):
    """Fit parameters as a dict of literals (``fit`` is the 1-row DataFrame of
    ``minmax_fit`` or an already collected dict)."""
    params = fit if isinstance(fit, dict) else fit.first().asDict()
    return {k: F.lit(v).cast("double") for k, v in params.items()}


def minmax_scale(df: DataFrame, fit: DataFrame, cols: Sequence[str], lo: float = -1.0,
                 hi: float = 1.0, suffix: str = "") -> DataFrame:
    """``(x - min) / (max - min) * (hi - lo) + lo``; a constant column maps to
    ``lo`` (the first scaler's rule, D12)."""
    t, row = df, _fit_row(fit)
    for c in cols:
        mn, mx = row[f"min_{c}"], row[f"max_{c}"]
        rng = mx - mn
        scaled = F.when(rng == 0, F.lit(lo)).otherwise(
            (F.col(c) - mn) / rng * F.lit(hi - lo) + F.lit(lo))
        t = t.withColumn(c + suffix, scaled)
    return t


def minmax_inverse(df: DataFrame, fit: DataFrame, cols: Sequence[str], lo: float = -1.0,
                   hi: float = 1.0, suffix: str = "") -> DataFrame:
    """Inverse of ``minmax_scale`` (a constant column maps back to its value)."""
    t, row = df, _fit_row(fit)
    for c in cols:
        mn, mx = row[f"min_{c}"], row[f"max_{c}"]
        t = t.withColumn(c + suffix, (F.col(c) - F.lit(lo)) / F.lit(hi - lo) * (mx - mn) + mn)
    return t
