"""Time helpers. Times travel as strings (as in the reference); these turn
them into instants / day strings without ever raising on bad input."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def day_string(ts) -> Column:
    """Timestamp column -> 'yyyy-MM-dd'."""
    return F.date_format(_c(ts), "yyyy-MM-dd")


def iso_string(ts) -> Column:
    """Timestamp column -> ISO text with microseconds."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def event_instant(text) -> Column:
    """ISO date / datetime text (optional 'T', fraction, trailing 'Z') -> timestamp.

    Unparseable text such as 'unknown' or '' gives NULL instead of failing the
    whole job (the reference's aggregation would abort on it).
    """
    return F.try_to_timestamp(_c(text))


def event_day(text) -> Column:
    """Event-time text -> 'yyyy-MM-dd' (NULL when unparseable)."""
    return F.date_format(event_instant(text), "yyyy-MM-dd")


def date_part(text) -> Column:
    """Everything before the first 'T' (the reference's ``str(ts).split('T')[0]``)."""
    return F.substring_index(_c(text), "T", 1)


def month_bucket(day) -> Column:
    """'yyyy-MM-dd' -> 'yyyy-MM'; monotone in the day, used to split long series."""
    return F.substring(_c(day), 1, 7)


def lookback_cutoff(as_of: str, days: int) -> str:
    """ISO text of ``as_of - days`` (Python ``isoformat`` spelling).

    The comparison with event time is a *string* comparison, like the
    reference's; ``as_of`` is a parameter instead of the wall clock.
    """
    t = datetime.fromisoformat(as_of) - timedelta(days=days)
    return t.isoformat()
