"""Daily sentiment, lookback filter, dimension mapping and the price joins
(F1, F4, G1, G2, C12-C14, J1-J3, J6, A4, A5, A8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import date_part, event_day, event_instant, lookback_cutoff
from tidemark.functions.text import falsy_to_null


# scans (A4, A5, A8)
def type_is(env: DataFrame, *types: str) -> Column:
    """Document-type predicate. On the stored envelope (partitioned by
    ``doc_type``) this prunes whole partitions; otherwise it tests ``data.type``."""
    c = F.col("doc_type") if "doc_type" in env.columns else F.col("data.type")
    return c == types[0] if len(types) == 1 else c.isin(*types)


def price_scan(env: DataFrame) -> DataFrame:
    """Price documents, projected to the 7 fields the feature job needs (A4/F1).

    The nested-field filter and projection reach the Parquet scan (nested
    schema pruning + pushed filter on ``data.type``) when ``env`` is a table.
    """
    return (env.where(type_is(env, "price"))
               .select("symbol", "timestamp",
                       F.col("data.closing_price").alias("closing_price"),
                       F.col("data.opening_price").alias("opening_price"),
                       F.col("data.high").alias("high"), F.col("data.low").alias("low"),
                       F.col("data.volume").alias("volume"),
                       *[c for c in ("kafka_timestamp_ms", "kafka_partition", "kafka_offset") if c in env.columns]))


def price_rows(env: DataFrame) -> DataFrame:
    """Price documents as the bar table of the feature job (date from C14)."""
    p = price_scan(env)
    return p.select(date_part(F.col("timestamp").cast("string")).alias("date"), "symbol",
                    F.col("closing_price").alias("close"), F.col("opening_price").alias("open"),
                    "high", "low", "volume",
                    *[c for c in ("kafka_timestamp_ms", "kafka_partition", "kafka_offset") if c in p.columns])


def unscored_texts(env: DataFrame, types=None) -> DataFrame:
    """Raw social documents that have no score yet (A5: ``$in`` + ``$exists: false``)."""
    from tidemark.constants import RAW_TEXT_TYPES
    types = list(types or RAW_TEXT_TYPES)
    return env.where(type_is(env, *types) & F.col("data.sentiment_score").isNull())


def sample_by_type(env: DataFrame, order=("kafka_timestamp_ms", "kafka_offset")) -> DataFrame:
    """First document of every ``data.type`` (A8), deterministic by ``order``.

    A grouped ``min_by`` (partial aggregation, no sort of the whole table)
    instead of ``orderBy().limit(1)`` per type.
    """
    key = F.struct(*[F.col(c) for c in order if c in env.columns])
    cols = [c for c in env.columns]
    return (env.groupBy(F.col("data.type").alias("doc_type"))
               .agg(F.min_by(F.struct(*cols), key).alias("doc"))
               .select("doc_type", "doc.*"))


# F4 / G1 / G2
def lookback_filter(docs: DataFrame, as_of: str, days: int, ts: str = "timestamp",
                    by_date: bool = False) -> DataFrame:
    """Keep documents at or after ``as_of - days``.

    Default is the reference's *string* comparison on the ISO text (D17: a
    date-only stamp on the cutoff day is excluded). ``by_date`` compares parsed
    instants instead.
    """
    cutoff = lookback_cutoff(as_of, days)
    if by_date:
        out = docs.where(event_instant(F.col(ts)) >= F.lit(cutoff).cast("timestamp"))
    else:
        out = docs.where(F.col(ts) >= F.lit(cutoff))
    if "event_date" in docs.columns and not by_date:
        # implied by the string comparison (a >= b => a[:10] >= b[:10]); on the
        # stored envelope it prunes whole event-day partitions
        out = out.where(F.col("event_date") >= F.lit(cutoff[:10]))
    return out


def sentiment_docs(env: DataFrame) -> DataFrame:
    """Envelope sentiment documents flattened to (company, timestamp, label, score, id)."""
    return env.where(type_is(env, "sentiment")).select(
        F.col("symbol").alias("company"), "timestamp",
        F.col("data.sentiment_label").alias("label"),
        F.col("data.sentiment_score").alias("score"), F.col("data.id").alias("id"))


def daily_sentiment(docs: DataFrame, company: str = "company", ts: str = "timestamp",
                    label: str = "label", score: str = "score",
                    strict_case: bool = False, sort_output: bool = False) -> DataFrame:
    """Per (company, day): mean score (NULLs ignored), document count and
    share of POSITIVE labels (G1).

    Rows whose time does not parse (e.g. ``'unknown'``) have no day and are
    left out (D5; see ``undated``). A hot company is no problem: the
    aggregation is partial on the map side, so each task ships one row per
    (company, day) it saw.
    """
    lab = F.col(label) if strict_case else F.upper(F.col(label))
    day = event_day(F.col(ts))
    out = (docs.where(day.isNotNull())
                .groupBy(F.col(company).alias("company"), day.alias("date"))
                .agg(F.avg(score).alias("avg_sentiment"),
                     F.count(F.lit(1)).alias("sentiment_count"),
                     F.avg(F.when(lab == "POSITIVE", F.lit(1.0)).otherwise(F.lit(0.0)))
                      .alias("positive_ratio")))
    # O1: the reference sorts by day; only worth a global sort at an output edge
    return out.orderBy("date", "company") if sort_output else out


def undated(docs: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Dead-letter side of ``daily_sentiment``: documents without a usable time."""
    return docs.where(event_day(F.col(ts)).isNull())


def avg_sentiment_by_company(docs: DataFrame, date: str = "date", company: str = "company",
                             score: str = "score") -> DataFrame:
    """Mean score per (date, company)."""
    return docs.groupBy(date, company).agg(F.avg(score).alias("avg_sentiment"))


# C12 / C13 / J3
def company_to_symbol(df: DataFrame, dim: DataFrame, company: str = "company",
                      keep_unmapped: bool = False) -> DataFrame:
    """Map ``lower(company)`` to a ticker through a dimension table.

    Inner join drops unmapped companies (C13). The dimension is *not* forced
    to broadcast: AQE turns the join into a broadcast at runtime when the
    measured size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
    and keeps a shuffle join otherwise.
    """
    d = dim.select(F.lower(F.col("company")).alias("_company_key"), F.col("symbol"))
    left = df.withColumn("_company_key", F.lower(F.col(company)))
    out = left.join(d, "_company_key", "left" if keep_unmapped else "inner")
    return out.drop("_company_key")


def dimension_from_map(spark, mapping: dict) -> DataFrame:
    """A literal company -> symbol map as a (tiny, fixed) dimension DataFrame."""
    return spark.createDataFrame(sorted(mapping.items()), "company string, symbol string")


# J1 / J2 / J6
def price_sentiment_join(prices: DataFrame, daily: DataFrame) -> DataFrame:
    """prices LEFT JOIN daily sentiment ON (date, symbol).

    Every price row is kept; several companies on one ticker fan out (D18).
    """
    d = daily.select("date", "symbol", *[c for c in ("company", "avg_sentiment",
                                                    "sentiment_count", "positive_ratio")
                                         if c in daily.columns])
    return prices.join(d, ["date", "symbol"], "left")


def tweet_price_join(tweets: DataFrame, prices: DataFrame, dim: DataFrame,
                     date: str = "date", ticker: str = "ticker") -> DataFrame:
    """Scored tweets mapped to tickers, joined to the bar of the same day.

    The bar side is first reduced to one row per (date, ticker) (the
    reference takes the first match); unmatched tweets are dropped.
    """
    t = company_to_symbol(tweets, dim).withColumnRenamed("symbol", ticker)
    key = [date, ticker]
    others = [c for c in prices.columns if c not in key]
    first = (prices.groupBy(*key)
                   .agg(F.min_by(F.struct(*others), F.struct(*others)).alias("_bar"))
                   .select(*key, "_bar.*"))
    return t.join(first, key, "inner")


def recent_sentiment(docs: DataFrame, as_of: str, hours: int, ts: str = "timestamp",
                     company: str = "company", score: str = "score") -> DataFrame:
    """Per company over the last ``hours`` before ``as_of``: score sum, scored
    count and document count (mergeable partials for J6)."""
    t = event_instant(F.col(ts))
    hi = F.lit(as_of).cast("timestamp")
    lo = hi - F.make_dt_interval(F.lit(0), F.lit(hours))
    return (docs.where((t >= lo) & (t < hi))
                .groupBy(F.col(company).alias("company"))
                .agg(F.sum(score).alias("_s"), F.count(score).alias("_ns"),
                     F.count(F.lit(1)).alias("_n")))


def recent_sentiment_join(bars: DataFrame, docs: DataFrame, dim: DataFrame, as_of: str,
                          hours: int) -> DataFrame:
    """Latest bar per symbol before ``as_of`` LEFT JOIN the mean sentiment of
    the last ``hours`` (J6: the reference's declared "last N hours" job).

    Companies are aggregated first, mapped, then merged per symbol, so the
    join only ever sees one row per company / symbol.
    """
    day = F.substring(F.lit(as_of), 1, 10)
    latest = (bars.where(F.col("date") < day)
                  .groupBy("symbol")
                  .agg(F.max_by(F.struct(*[c for c in bars.columns if c != "symbol"]),
                                F.col("date")).alias("_b"))
                  .select("symbol", "_b.*"))
    rs = company_to_symbol(recent_sentiment(docs, as_of, hours), dim)
    rs = rs.groupBy("symbol").agg(
        (F.sum("_s") / F.nullif(F.sum("_ns"), F.lit(0))).alias("recent_sentiment"),
        F.sum("_n").alias("recent_count"))
    return latest.join(rs, "symbol", "left")


# options (D4, D8, D18)
def dedupe_sentiment(docs: DataFrame, id_col: str = "id", score: str = "score",
                     order=("timestamp",)) -> DataFrame:
    """One document per id, preferring a copy that has a score (then the
    latest). Rows without an id pass unchanged. A partial ``max_by`` per id,
    so a repeated id costs one row per task."""
    keyed = docs.where(F.col(id_col).isNotNull())
    rank = F.struct(F.col(score).isNotNull(), *[F.col(c) for c in order])
    best = (keyed.groupBy(id_col)
                 .agg(F.max_by(F.struct(*[F.col(c) for c in docs.columns if c != id_col]), rank)
                      .alias("_tm_doc"))
                 .select(id_col, "_tm_doc.*"))
    return best.select(*docs.columns).unionByName(docs.where(F.col(id_col).isNull()))


def daily_sentiment_by_symbol(docs: DataFrame, dim: DataFrame, company: str = "company",
                              ts: str = "timestamp", label: str = "label",
                              score: str = "score") -> DataFrame:
    """Daily sentiment merged per *ticker* before the price join, so two
    companies mapped to one ticker do not fan the bars out. Exact: companies
    are aggregated to mergeable partials (sum, counts) first, mapped, then
    merged per (symbol, date)."""
    day = event_day(F.col(ts))
    pos = F.when(F.upper(F.col(label)) == "POSITIVE", F.lit(1)).otherwise(F.lit(0))
    part = (docs.where(day.isNotNull())
                .groupBy(F.col(company).alias("company"), day.alias("date"))
                .agg(F.sum(score).alias("_s"), F.count(score).alias("_ns"),
                     F.count(F.lit(1)).alias("_n"), F.sum(pos).alias("_np")))
    mapped = company_to_symbol(part, dim)
    return (mapped.groupBy("date", "symbol")
                  .agg((F.sum("_s") / F.nullif(F.sum("_ns"), F.lit(0))).alias("avg_sentiment"),
                       F.sum("_n").alias("sentiment_count"),
                       (F.sum("_np") / F.sum("_n")).alias("positive_ratio")))


def roll_up_bars(ticks: DataFrame, symbol: str = "symbol", date: str = "date",
                 price: str = "close", volume: str = "volume", tie: str = "event_id",
                 volume_digits: int | None = 2) -> DataFrame:
    """Several bars per (symbol, date) -> one daily OHLCV bar: open / close
    at the first / last tick by ``tie``, high / low, summed volume. Partial
    aggregation, so a hot symbol-day costs one row per task."""
    vol = F.sum(volume)
    if volume_digits is not None:
        vol = F.round(vol, volume_digits)
    return (ticks.groupBy(F.col(symbol).alias("symbol"), F.col(date).alias("date"))
                 .agg(F.min_by(price, tie).alias("open"), F.max(price).alias("high"),
                      F.min(price).alias("low"), F.max_by(price, tie).alias("close"),
                      vol.alias("volume")))
