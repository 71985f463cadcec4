"""``prepare_training_data`` - the feature frame of the reference.

F4 -> G1 -> J3 -> J1(A4, C14) -> W1 -> W2 -> C15 -> C16, as one lineage.
Shuffles: the daily aggregate (partial, per company/day), the left join on
(date, symbol) and the per-symbol scans (two-pass over range-partition buckets,
so a hot symbol is split into balanced contiguous pieces).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.dates import month_bucket
from tidemark.operators import daily as D
from tidemark.operators import relational as R
from tidemark.operators import series as S

PRICE_ORDER = ("date", "kafka_timestamp_ms", "kafka_partition", "kafka_offset")
FILL_COLUMNS = ("open", "high", "low", "close", "volume", "avg_sentiment",
                "sentiment_count", "positive_ratio")


def _bucket(split_skew):
    """True / "month": month buckets; "range": range-partition buckets
    (balanced under any skew, one more shuffle); False: plain windows."""
    if split_skew == "range":
        return "range"
    return month_bucket("date") if split_skew else None


def prepare_training_data(env: DataFrame, dim: DataFrame, as_of: str = K.AS_OF,
                          lookback_days: int = 30, split_skew: "bool | str" = "range",
                          with_extras: bool = False, by_date: bool = False,
                          dedupe_ids: bool = False, merge_companies: bool = False) -> DataFrame:
    """Envelope documents -> 8-column training frame (date, symbol, OHLCV, avg_sentiment).

    Options (all off = the reference's behaviour): ``with_extras`` keeps
    ``daily_return``, ``sentiment_count`` and ``positive_ratio`` (computed but
    dropped by the reference, D22); ``by_date`` compares the lookback on parsed
    times (D17); ``dedupe_ids`` keeps one document per id (D4);
    ``merge_companies`` merges companies sharing a ticker before the join (D18).
    """
    # lookback on the envelope itself, so it can prune event-day partitions
    docs = D.sentiment_docs(D.lookback_filter(env, as_of, lookback_days, by_date=by_date))
    if dedupe_ids:
        docs = D.dedupe_sentiment(docs)
    if merge_companies:
        daily = D.daily_sentiment_by_symbol(docs, dim)
    else:
        daily = D.company_to_symbol(D.daily_sentiment(docs), dim)
    prices = D.price_rows(env)
    order = [c for c in PRICE_ORDER if c in prices.columns]
    merged = D.price_sentiment_join(prices, daily)
    bucket = _bucket(split_skew)
    # W1 and W2 in one scan: the return reads the unfilled close
    merged = S.fused_scan(merged, ["symbol"], order, bucket,
                          pct=[("close", "daily_return")],
                          ffill=[c for c in FILL_COLUMNS if c in merged.columns])
    out = R.complete_schema(merged, keep_extra=with_extras)
    if with_extras:
        return out.drop(*[c for c in out.columns if c.startswith("kafka_") or c == "company"])
    return out


def prepare_from_bars(bars: DataFrame, daily_mapped: DataFrame, split_skew: "bool | str" = "range",
                      order=("date",)) -> DataFrame:
    """The same feature frame when prices already are daily bars."""
    merged = D.price_sentiment_join(bars, daily_mapped)
    bucket = _bucket(split_skew)
    merged = S.fused_scan(merged, ["symbol"], list(order), bucket,
                          pct=[("close", "daily_return")],
                          ffill=[c for c in FILL_COLUMNS if c in merged.columns])
    return R.complete_schema(merged, keep_extra=True)
