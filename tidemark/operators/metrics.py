"""Regression metrics as one distributed aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import safe_div


def regression_metrics(df: DataFrame, actual: str = "actual", prediction: str = "prediction",
                       by: list[str] | None = None) -> DataFrame:
    """MSE, MAE and MAPE (%) per group (or overall). Nothing is collected;
    a zero actual is left out of MAPE instead of producing inf (D16)."""
    err = F.col(actual) - F.col(prediction)
    aggs = [F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"),
            (F.avg(F.abs(safe_div(err, F.col(actual)))) * F.lit(100.0)).alias("mape"),
            F.count(F.lit(1)).alias("n")]
    return df.groupBy(*(by or [])).agg(*aggs)
