"""Query registry: one entry per operator of SURVEY §2.

Every query reads the driver tables (or frames Spark derives from them) in
full. Results pass through ``report``: doubles rounded to 6 dp and integers
widened to bigint, the parity rules shared with the SQL oracles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import constants as K
from tidemark.sources import bindings as B

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


NUDGE = 1.0 + 1e-12


def report(df: DataFrame, digits: int = 6) -> DataFrame:
    """Parity edge: doubles rounded to ``digits`` after a 1e-12 relative nudge
    (so exact decimal ties, e.g. means of 5-decimal scores, cannot fall on
    different sides in engines that sum in a different order); small ints
    widened to bigint."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c * F.lit(NUDGE), digits)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return report(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn
    return deco


# flagship (P1)
@query("training_frame")
def q_training_frame(spark, d):
    """P1 over the envelope derived from ``events``: 8-column feature frame."""
    from tidemark.plans.training import prepare_training_data
    env = B.envelope(spark, d)
    return prepare_training_data(env, B.dim(spark, d), K.AS_OF, K.LOOKBACK_DAYS)


# helpers
def _flat_env(spark, d):
    from tidemark.operators.envelope import flatten_envelope
    return flatten_envelope(B.envelope(spark, d))


def _mapped_daily(spark, d):
    """G1 over the ``scored`` binding, mapped to symbols."""
    from tidemark.operators import daily as D
    return D.company_to_symbol(D.daily_sentiment(B.scored(spark, d)), B.dim(spark, d))


def _bucket():
    """Buckets of the two-pass per-key scans: range-partition pieces of
    (symbol, order), balanced whatever the skew (``series.range_buckets``)."""
    return "range"


# 2.1 sources
@query("json_decode")
def q_json_decode(spark, d):
    """Price topic values decoded with the price schema."""
    from tidemark import schemas
    from tidemark.operators.envelope import decode_json
    recs = B.topic_log(spark, d).where(F.col("topic") == K.TOPIC_PRICES)
    return decode_json(recs, schemas.PRICE, keep=("partition", "offset"))


@query("multi_topic_union")
def q_multi_topic_union(spark, d):
    """One reader over the text topics, one union schema."""
    from tidemark import schemas
    from tidemark.operators.envelope import read_topics
    topics = [K.TOPIC_TWITTER, K.TOPIC_REDDIT, K.TOPIC_NEWS, K.TOPIC_SCORED]
    t = read_topics(B.topic_log(spark, d), topics, schemas.ANY_MESSAGE,
                    keep=("topic", "offset", "timestamp_ms"))
    return t.select("topic", "offset", "timestamp_ms", "id", "company", "timestamp", "text",
                    "sentiment_label", "sentiment_score")


@query("headline_union")
def q_headline_union(spark, d):
    """Forum and news headlines, decoded with the union schema; their epoch seconds as event time."""
    from tidemark import schemas
    from tidemark.operators.envelope import epoch_string, read_topics
    t = read_topics(B.headlines(spark, d), [K.TOPIC_REDDIT, K.TOPIC_NEWS], schemas.ANY_MESSAGE, keep=("topic", "offset"))
    return t.select("topic", "offset", "id", "text", F.col("ts").cast("long").alias("ts"), epoch_string(F.col("ts")).alias("event_time"))


@query("headline_envelope")
def q_headline_envelope(spark, d):
    """Headlines in the envelope, timed by their epoch seconds."""
    from tidemark.operators.envelope import flatten_envelope, to_envelope
    env = flatten_envelope(to_envelope(B.headlines(spark, d), ingest_ts=K.AS_OF, epoch_times=True))
    return env.select("source_topic", "kafka_offset", "symbol", "timestamp", "text", "id")


@query("price_scan")
def q_price_scan(spark, d):
    """A4/F1: price documents, 7 projected fields."""
    from tidemark.operators.daily import price_scan
    return price_scan(B.envelope(spark, d)).drop("kafka_timestamp_ms", "kafka_partition", "kafka_offset")


@query("unscored_texts")
def q_unscored_texts(spark, d):
    """Raw social documents without a score."""
    from tidemark.operators.daily import unscored_texts
    u = unscored_texts(B.envelope(spark, d))
    return u.select("source_topic", "kafka_offset", "symbol", "timestamp",
                    F.col("data.text").alias("text"), F.col("data.id").alias("id"))


@query("bars_load")
def q_bars_load(spark, d):
    """A bar table with capitalised columns and a timestamp index -> loader shape."""
    from tidemark.operators.envelope import load_bars
    b = B.bars(spark, d)
    raw = b.select(F.col("date").cast("timestamp").alias("Date"), F.col("symbol").alias("Symbol"),
                   F.col("open").alias("Open"), F.col("high").alias("High"),
                   F.col("low").alias("Low"), F.col("close").alias("Close"),
                   F.col("volume").alias("Volume"))
    return load_bars(raw)


@query("sample_by_type")
def q_sample_by_type(spark, d):
    """The first document of each type."""
    from tidemark.operators.daily import sample_by_type
    s = sample_by_type(B.envelope(spark, d).drop("doc_type", "event_date"))
    return s.select("doc_type", "source_topic", "kafka_offset", "symbol", "timestamp")


# 2.3 envelope
def _env_type(kind):
    def fn(spark, d):
        return _flat_env(spark, d).where(F.col("doc_type") == kind)
    return fn


for _name, _kind in [("envelope_price", "price"), ("envelope_sentiment", "sentiment"),
                     ("envelope_social", K.TOPIC_TWITTER),
                     ("envelope_unknown_topic", "unknown_topic"),
                     ("envelope_non_object", "unknown")]:
    query(_name)(_env_type(_kind))


@query("timestamp_default")
def q_timestamp_default(spark, d):
    """Documents whose time fell back to the ingest time."""
    e = _flat_env(spark, d)
    return e.where(F.col("timestamp") == K.AS_OF).select(
        "source_topic", "kafka_offset", "doc_type", "symbol", "timestamp")


@query("envelope_all")
def q_envelope_all(spark, d):
    """The whole router over every topic record."""
    return _flat_env(spark, d)


@query("flatten_posts")
def q_flatten_posts(spark, d):
    """Nested posts -> 8-column messages."""
    from tidemark.operators.envelope import flatten_posts
    return flatten_posts(B.posts(spark, d))


@query("normalize_bars")
def q_normalize_bars(spark, d):
    """Prices rounded to 2 dp, day-formatted time."""
    from tidemark.operators.envelope import normalize_bars
    ev = B.table(spark, d, "events").where(F.col("event_type").isin("click", "view"))
    v = F.col("value")
    raw = ev.select(B.tag("U").alias("symbol"), F.col("ts"), (v / 3).alias("close"),
                    (v / 7).alias("open"), (v / 3 + 1).alias("high"), (v / 7 - 1).alias("low"),
                    (v / 9).alias("volume"), F.col("event_id"))
    return normalize_bars(raw)


@query("company_to_symbol")
def q_company_to_symbol(spark, d):
    """Daily sentiment mapped to tickers; unmapped companies dropped."""
    return _mapped_daily(spark, d)


@query("date_part")
def q_date_part(spark, d):
    """Day part of the document time."""
    from tidemark.functions.dates import date_part
    e = B.envelope(spark, d)
    return e.select("source_topic", "kafka_offset", "timestamp",
                    date_part(F.col("timestamp")).alias("date"))


@query("schema_completion")
def q_schema_completion(spark, d):
    """Price rows completed to the 8-column training schema."""
    from tidemark.operators.daily import price_rows
    from tidemark.operators.relational import complete_schema
    return complete_schema(price_rows(B.envelope(spark, d)))


# 2.4 filters
@query("lookback_filter")
def q_lookback_filter(spark, d):
    """Documents at or after as_of - 15 days (string comparison)."""
    from tidemark.operators.daily import lookback_filter
    e = B.envelope(spark, d).where(F.col("doc_type").isin("sentiment", K.TOPIC_TWITTER))
    return lookback_filter(e, K.AS_OF, K.LOOKBACK_DAYS).select(
        "source_topic", "kafka_offset", "symbol", "timestamp")


@query("temporal_split")
def q_temporal_split(spark, d):
    """Global row number over (date, symbol) and the 70/15/15 split."""
    from tidemark.operators.splits import temporal_split
    t = temporal_split(B.bars(spark, d), ["date", "symbol"])
    return t.select("symbol", "date", "row_id", "split")


@query("temporal_split_additive")
def q_temporal_split_additive(spark, d):
    """W6 with the additive cut formula."""
    from tidemark.operators.splits import temporal_split
    t = temporal_split(B.bars(spark, d), ["date", "symbol"], additive=True)
    return t.select("symbol", "date", "row_id", "split")


@query("symbol_slice")
def q_symbol_slice(spark, d):
    """one symbol's bars, returned only when it has at least L rows."""
    from tidemark.operators.relational import symbol_slice
    return symbol_slice(B.bars(spark, d), "U0001", K.SEQUENCE_LENGTH)


@query("drop_incomplete")
def q_drop_incomplete(spark, d):
    """training frame rows without any NULL."""
    from tidemark.operators.relational import drop_incomplete
    from tidemark.plans.training import prepare_training_data
    tf = prepare_training_data(B.envelope(spark, d), B.dim(spark, d), K.AS_OF, K.LOOKBACK_DAYS)
    return drop_incomplete(tf)


@query("next_target")
def q_next_target(spark, d):
    """Next bar's open per symbol; last row of a symbol dropped."""
    from tidemark.operators.series import next_value
    t = next_value(B.bars(spark, d), "open", "target_price", ["symbol"], ["date"], _bucket())
    return t.where(F.col("target_price").isNotNull())


@query("next_target_close")
def q_next_target_close(spark, d):
    """Next bar's close per symbol (D9: never across symbols)."""
    from tidemark.operators.series import next_value
    t = next_value(B.bars(spark, d), "close", "target_price", ["symbol"], ["date"], _bucket())
    return t.where(F.col("target_price").isNotNull())


@query("keyword_score")
def q_keyword_score(spark, d):
    """Keyword scorer as a native expression."""
    from tidemark.operators.scoring import keyword_score
    return keyword_score(B.texts(spark, d)).select("id", "company", "text", "sentiment")


# 2.5 joins
@query("price_sentiment_join")
def q_price_sentiment_join(spark, d):
    """Bars LEFT JOIN mapped daily sentiment on (date, symbol)."""
    from tidemark.operators.daily import price_sentiment_join
    return price_sentiment_join(B.bars(spark, d), _mapped_daily(spark, d))


@query("tweet_price_join")
def q_tweet_price_join(spark, d):
    """Scored texts -> tickers -> bar of the same day (inner)."""
    from tidemark.operators.daily import tweet_price_join
    from tidemark.operators.scoring import batch_score
    tw = batch_score(B.texts(spark, d)).select("id", "company", "date", "text",
                                               "sentiment_label", "sentiment_score")
    bars = B.bars(spark, d).withColumnRenamed("symbol", "ticker")
    return tweet_price_join(tw, bars, B.dim(spark, d))


@query("unscored_antijoin")
def q_unscored_antijoin(spark, d):
    """Documents with no label row yet."""
    from tidemark.operators.scoring import unscored_antijoin
    docs = B.table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return unscored_antijoin(docs, B.table(spark, d, "labels"), "doc_id")


@query("recent_sentiment_join")
def q_recent_sentiment_join(spark, d):
    """Latest bar per symbol with the mean sentiment of the last 72 hours."""
    from tidemark.operators.daily import recent_sentiment_join
    return recent_sentiment_join(B.bars(spark, d), B.scored(spark, d), B.dim(spark, d),
                                 K.AS_OF, 72)


@query("apply_scores")
def q_apply_scores(spark, d):
    """Scores for unscored raw documents applied by document key."""
    from tidemark.operators.envelope import flatten_envelope
    from tidemark.operators.scoring import apply_scores, score_updates
    env = B.envelope(spark, d).drop("doc_type", "event_date")
    upd = score_updates(env, K.AS_OF)
    return flatten_envelope(apply_scores(env, upd))


@query("score_store")
def q_score_store(spark, d):
    """The store's unscored documents scored, and the scores written into
    the store in one commit that replaces the folders they lie in."""
    from tidemark.operators.envelope import flatten_envelope
    from tidemark.operators.scoring import score_updates, update_store
    from tidemark.session import scratch_dir
    from tidemark.sources.versioned import envelope_table
    store = envelope_table(spark, scratch_dir(spark, "score_store") + "/store")
    store.append(B.envelope(spark, d))
    update_store(store, score_updates(store.read(), K.AS_OF))
    return flatten_envelope(store.read())


# 2.6 aggregations
@query("daily_sentiment")
def q_daily_sentiment(spark, d):
    """Per (company, day) mean score, count, positive share."""
    from tidemark.operators.daily import daily_sentiment, sentiment_docs
    return daily_sentiment(sentiment_docs(B.envelope(spark, d)))


@query("avg_sentiment_by_company")
def q_avg_sentiment_by_company(spark, d):
    """Mean score per (date, company)."""
    from tidemark.operators.daily import avg_sentiment_by_company
    return avg_sentiment_by_company(B.scored(spark, d))


@query("row_counts")
def q_row_counts(spark, d):
    """Records per topic."""
    from tidemark.operators.relational import row_counts
    return row_counts(B.topic_log(spark, d), ["topic"])


@query("regression_metrics")
def q_regression_metrics(spark, d):
    """MSE, MAE, MAPE of (close, open) as (actual, prediction)."""
    from tidemark.operators.metrics import regression_metrics
    return regression_metrics(B.predictions(spark, d))


def _train_bars(spark, d):
    from tidemark.operators.splits import temporal_split
    return temporal_split(B.bars(spark, d), ["date", "symbol"])


BAR_FEATURES = ["open", "high", "low", "close", "volume"]


@query("minmax_fit")
def q_minmax_fit(spark, d):
    """Min / max of the bar features on the train split only."""
    from tidemark.operators.scaling import minmax_fit
    return minmax_fit(_train_bars(spark, d).where(F.col("split") == "train"), BAR_FEATURES)


@query("distinct_symbols")
def q_distinct_symbols(spark, d):
    """G7."""
    from tidemark.operators.relational import distinct_symbols
    return distinct_symbols(B.bars(spark, d))


@query("eligible_symbols")
def q_eligible_symbols(spark, d):
    """Symbols with at least 15 bars."""
    from tidemark.operators.relational import eligible_symbols
    return eligible_symbols(B.bars(spark, d), 3 * K.SEQUENCE_LENGTH)


# 2.7 windows
@query("daily_return")
def q_daily_return(spark, d):
    """Padded percent change of close per symbol (two-pass, range buckets)."""
    from tidemark.operators.series import pct_change
    b = B.bars(spark, d)
    return pct_change(b, "close", "daily_return", ["symbol"], ["date"], _bucket()).select(
        "symbol", "date", "close", "daily_return")


@query("forward_fill")
def q_forward_fill(spark, d):
    """Sentiment columns of J1 carried forward per symbol."""
    from tidemark.operators.daily import price_sentiment_join
    from tidemark.operators.series import forward_fill
    j = price_sentiment_join(B.bars(spark, d), _mapped_daily(spark, d)).drop("company")
    return forward_fill(j, ["avg_sentiment", "sentiment_count", "positive_ratio"],
                        ["symbol"], ["date"], _bucket())


@query("row_id")
def q_row_id(spark, d):
    """W5 per symbol: row number and row count (two-pass)."""
    from tidemark.operators.series import positions
    return positions(B.bars(spark, d), ["symbol"], ["date"], _bucket()).select(
        "symbol", "date", "rn", "n")


def _sequences(spark, d):
    from tidemark.operators.series import fused_scan, sequence_windows
    b = fused_scan(B.bars(spark, d), ["symbol"], ["date"], _bucket(),
                   nxt=[("open", "target_price")], pos=("_rn", "_n"))
    return sequence_windows(b, K.SEQUENCE_LENGTH, BAR_FEATURES, "target_price",
                            ["symbol"], ["date"], bucket=_bucket(), pos=("_rn", "_n"))


@query("sequence_windows")
def q_sequence_windows(spark, d):
    """Sliding windows of L = 5 bars per symbol, target = next open."""
    s = _sequences(spark, d)
    return s.select("symbol", "idx", F.size("x").cast("bigint").alias("n_x"),
                    F.aggregate("x", F.lit(0.0), lambda acc, e: acc + e["close"]).alias("sum_close"),
                    F.col("x")[0]["open"].alias("first_open"), "y")


@query("sequence_dates")
def q_sequence_dates(spark, d):
    """Date span and label date of every window."""
    return _sequences(spark, d).select("symbol", "idx", "first_date", "last_date", "label_date")


@query("latest_sequence")
def q_latest_sequence(spark, d):
    """Newest L bars of every symbol."""
    from tidemark.operators.series import latest_sequence
    s = latest_sequence(B.bars(spark, d), K.SEQUENCE_LENGTH, BAR_FEATURES)
    return s.select("symbol", "first_date", "last_date", "n_rows",
                    F.aggregate("x", F.lit(0.0), lambda acc, e: acc + e["close"]).alias("sum_close"))


@query("cumulative_return")
def q_cumulative_return(spark, d):
    """cumprod(1 + return) of actual and predicted prices per symbol."""
    from tidemark.operators.series import cumulative_return
    return cumulative_return(B.predictions(spark, d), ["actual", "prediction"], ["symbol"],
                             ["date"], _bucket())


@query("rolling_sentiment")
def q_rolling_sentiment(spark, d):
    """Mean sentiment over the current and 2 previous bars per symbol."""
    from tidemark.operators.daily import price_sentiment_join
    from tidemark.operators.series import rolling_mean
    j = price_sentiment_join(B.bars(spark, d), _mapped_daily(spark, d))
    r = rolling_mean(j, "avg_sentiment", 3, "rolling_sentiment", ["symbol"], ["date"], _bucket())
    return r.select("symbol", "date", "avg_sentiment", "rolling_sentiment")


# 2.8 / 2.9
@query("limit_per_term")
def q_limit_per_term(spark, d):
    """At most 25 posts per company, earliest first."""
    from tidemark.operators.relational import limit_per_key
    return limit_per_key(B.texts(spark, d), "company", ["timestamp", "id"], 25).select(
        "company", "id", "timestamp", "rank_in_key")


@query("minmax_scale")
def q_minmax_scale(spark, d):
    """Bar features scaled to [-1, 1] with the train-split fit."""
    from tidemark.operators.scaling import minmax_fit, minmax_scale
    t = _train_bars(spark, d)
    fit = minmax_fit(t.where(F.col("split") == "train"), BAR_FEATURES)
    return minmax_scale(t, fit, BAR_FEATURES).select("symbol", "date", "split", *BAR_FEATURES)


@query("minmax_inverse")
def q_minmax_inverse(spark, d):
    """X9 inverse: scaled features mapped back (round trip of the fit)."""
    from tidemark.operators.scaling import minmax_fit, minmax_inverse, minmax_scale
    t = _train_bars(spark, d)
    fit = minmax_fit(t.where(F.col("split") == "train"), BAR_FEATURES).first().asDict()
    s = minmax_scale(t, fit, BAR_FEATURES, suffix="_s")
    inv = minmax_inverse(s.select("symbol", "date", *[F.col(c + "_s").alias(c) for c in BAR_FEATURES]),
                         fit, BAR_FEATURES)
    return inv


@query("dead_letter")
def q_dead_letter(spark, d):
    """Records whose value is not JSON, kept in their own partition."""
    return B.dead_letter_docs(spark, d).select("source_topic", "kafka_offset",
                                               F.col("data.payload").alias("payload"))


@query("long_series_features")
def q_long_series_features(spark, d):
    """W1/W5/W11 on 50 long series from ``lineitem`` (several rows per date):
    return, position and 5-row mean. (orderkey, linenumber) repeats in the
    driver's lineitem, so the total order adds the price: (date, orderkey,
    linenumber, extendedprice) is unique."""
    from tidemark.operators.series import fused_scan, rolling_mean
    order = ["date", "l_orderkey", "l_linenumber", "close"]
    ls = B.long_series(spark, d).select("symbol", "date", "close", "l_orderkey", "l_linenumber")
    t = fused_scan(ls, ["symbol"], order, _bucket(), pct=[("close", "ret")], pos=("rn", None))
    t = rolling_mean(t, "close", 5, "close_mean_5", ["symbol"], order, _bucket(), chunk_rows=4096,
                     pos="rn")
    return t.select("symbol", "date", "l_orderkey", "l_linenumber", "close", "ret", "rn",
                    "close_mean_5")
