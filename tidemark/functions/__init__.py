"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from tidemark.functions.dates import (day_string, iso_string, event_instant, event_day,
                                      month_bucket, lookback_cutoff, date_part)
from tidemark.functions.numeric import safe_div
from tidemark.functions.text import falsy_to_null, hashed_label, keyword_label

__all__ = ["day_string", "iso_string", "event_instant", "event_day", "month_bucket",
           "lookback_cutoff", "date_part", "safe_div", "keyword_label", "hashed_label",
           "falsy_to_null"]
