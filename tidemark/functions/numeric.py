"""Null-safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (pandas would give inf; ANSI would raise)."""
    return num / F.nullif(den, F.lit(0.0))
