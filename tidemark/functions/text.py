"""Text predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.constants import NEGATIVE_WORDS, POSITIVE_WORDS


def falsy_to_null(c: Column) -> Column:
    """'' -> NULL, so that ``coalesce`` behaves like Python's ``x or default``."""
    return F.nullif(c, F.lit(""))


def hashed_label(key: Column) -> Column:
    """A stable stand-in for the reference's random fallback label: one of
    POSITIVE / NEGATIVE / NEUTRAL picked by ``pmod(xxhash64(key), 3)``."""
    from tidemark.constants import LABELS
    return F.element_at(F.array(*[F.lit(x) for x in LABELS]),
                        (F.pmod(F.xxhash64(key), F.lit(3)) + 1).cast("int"))


def keyword_label(text: Column, negative: Sequence[str] = NEGATIVE_WORDS,
                  positive: Sequence[str] = POSITIVE_WORDS,
                  default: "str | Column | None" = "NEUTRAL") -> Column:
    """Lexicon label: negative words win over positive ones; otherwise ``default``
    (a label, or a column such as ``hashed_label(id)``).

    Substring tests on the lower-cased *whole* text. NULL text gives NULL.
    """
    low = F.lower(text)
    neg = None
    for w in negative:
        t = low.contains(w)
        neg = t if neg is None else (neg | t)
    pos = None
    for w in positive:
        t = low.contains(w)
        pos = t if pos is None else (pos | t)
    expr = F.when(text.isNull(), F.lit(None).cast("string"))
    if neg is not None:
        expr = expr.when(neg, F.lit("NEGATIVE"))
    if pos is not None:
        expr = expr.when(pos, F.lit("POSITIVE"))
    fallback = default if isinstance(default, Column) else F.lit(default).cast("string")
    return expr.otherwise(fallback)
