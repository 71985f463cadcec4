"""Topic record -> common envelope document (C1-C7), post flattening (C8),
bar normalisation (C9).

One chained ``when`` per output field routes every record by its topic, so
the whole router is a single projection inside whole-stage codegen: no UDF,
no per-topic frames, no union. The value is parsed once, into a VARIANT.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.text import falsy_to_null


def _get(v: Column, field: str, typ: str = "string") -> Column:
    return F.try_variant_get(v, f"$.{field}", typ)


def is_object(v: Column, value: Column) -> Column:
    """Whether ``value``, which parsed to ``v``, is a JSON object (behind any of JSON's blanks)."""
    return v.isNotNull() & F.ltrim(value, F.lit(" \t\r\n")).startswith("{")


def parse_value(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``_v`` (VARIANT or NULL when not JSON) and ``_is_object``."""
    v = F.try_parse_json(F.col(value))
    is_obj = is_object(v, F.col(value))
    return df.withColumn("_v", v).withColumn("_is_object", is_obj)


def dead_letters(records: DataFrame, value: str = "value") -> DataFrame:
    """Records whose value is not JSON at all (the reference's consumer would die on them)."""
    return records.where(F.try_parse_json(F.col(value)).isNull())


def to_envelope(records: DataFrame, ingest_ts: str | None = None,
                topic: str = "topic", value: str = "value", timestamp_ms: str = "timestamp_ms",
                keep_dead_letters: bool = False,
                prices_topic: str = K.TOPIC_PRICES, scored_topic: str = K.TOPIC_SCORED,
                raw_topics=K.RAW_TEXT_TYPES, epoch_times: bool = False) -> DataFrame:
    """Route topic records into the envelope of SURVEY §1.2.

    ``ingest_ts`` is the time of messages that carry none; by default the time
    of the (micro-)batch, a fixed one makes results repeatable. With
    ``epoch_times`` a headline's epoch seconds (``ts``) are its time. Records whose value is not JSON are dropped unless
    ``keep_dead_letters`` (then they carry ``type = 'dead_letter'``).
    """
    df = parse_value(records, value)
    v, obj = F.col("_v"), F.col("_is_object")
    t = F.col(topic)
    now = F.lit(ingest_ts) if ingest_ts is not None else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    is_price = obj & (t == prices_topic)
    is_scored = obj & (t == scored_topic)
    is_social = obj & t.isin(*raw_topics)
    is_other = obj & ~(t == prices_topic) & ~(t == scored_topic) & ~t.isin(*raw_topics)
    null_s = F.lit(None).cast("string")
    null_d = F.lit(None).cast("double")

    symbol = (F.when(is_price, _get(v, "symbol"))
               .when(is_scored | is_social, _get(v, "company"))
               .when(is_other, F.coalesce(falsy_to_null(_get(v, "symbol")), _get(v, "company")))
               .otherwise(null_s))
    epoch = epoch_string(_get(v, "ts", "double")) if epoch_times else F.lit(None).cast("string")
    ts = (F.when(~obj, now)
           .when(is_price | is_scored, _get(v, "timestamp"))
           .otherwise(F.coalesce(falsy_to_null(_get(v, "timestamp")), epoch, now)))
    ts = F.coalesce(ts, now)   # C6: still missing -> ingest time
    kind = (F.when(v.isNull(), F.lit("dead_letter")).when(~obj, F.lit("unknown"))
             .when(is_price, F.lit("price")).when(is_scored, F.lit("sentiment"))
             .when(is_social, t).otherwise(F.lit("unknown_topic")))

    def price_field(name):
        return F.when(is_price, _get(v, name, "double")).otherwise(null_d)

    label = F.coalesce(_get(v, "sentiment_label"), _get(v, "sentiment"))
    data = F.struct(
        kind.alias("type"),
        price_field("closing_price").alias("closing_price"),
        price_field("opening_price").alias("opening_price"),
        price_field("high").alias("high"), price_field("low").alias("low"),
        price_field("volume").alias("volume"),
        F.when(is_scored | is_social, _get(v, "text")).otherwise(null_s).alias("text"),
        F.when(is_scored | is_social, _get(v, "id")).otherwise(null_s).alias("id"),
        F.when(is_scored, label).otherwise(null_s).alias("sentiment_label"),
        F.when(is_scored, _get(v, "sentiment_score", "double")).otherwise(null_d)
         .alias("sentiment_score"),
        null_s.alias("original_text"), null_s.alias("processed_at"),
        F.when(~obj | is_other, F.col(value)).otherwise(null_s).alias("payload"))
    out = df.select(
        t.alias("source_topic"),
        F.col(timestamp_ms).cast("bigint").alias("kafka_timestamp_ms"),
        *([F.col("partition").cast("int").alias("kafka_partition")] if "partition" in records.columns else []),
        *([F.col("offset").cast("bigint").alias("kafka_offset")] if "offset" in records.columns else []),
        symbol.alias("symbol"), ts.alias("timestamp"), data.alias("data"))
    if not keep_dead_letters:
        out = out.where(F.col("data.type") != "dead_letter")
    return out


def epoch_string(seconds: Column) -> Column:
    """Epoch seconds as the documents' time strings are written (UTC)."""
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def flatten_envelope(env: DataFrame) -> DataFrame:
    """Envelope -> flat columns (report / oracle shape)."""
    d = [f.name for f in env.schema["data"].dataType.fields]
    top = [c for c in env.columns if c not in ("data", "doc_type", "event_date")]
    return env.select(*top, *[F.col(f"data.{c}").alias(c if c != "type" else "doc_type") for c in d])


def flatten_posts(posts: DataFrame, company: str = "company", post: str = "post") -> DataFrame:
    """Nested social post -> the 8-column text message.

    ``createdAt`` keeps its date part, or ``'unknown'`` when missing; missing
    text -> ''; missing counters -> 0.
    """
    p = F.col(post)
    created = p["record"]["createdAt"]
    return posts.select(
        p["cid"].alias("id"), F.col(company).alias("company"),
        F.when(created.isNull(), F.lit("unknown")).otherwise(
            F.substring_index(created, "T", 1)).alias("timestamp"),
        F.coalesce(p["record"]["text"], F.lit("")).alias("text"),
        F.coalesce(p["replyCount"], F.lit(0)).alias("replyCount"),
        F.coalesce(p["likeCount"], F.lit(0)).alias("likeCount"),
        F.coalesce(p["repostCount"], F.lit(0)).alias("repostCount"),
        F.coalesce(p["quoteCount"], F.lit(0)).alias("quoteCount"))


def normalize_bars(bars: DataFrame, ts: str = "ts", symbol: str = "symbol",
                   half_even: bool = False) -> DataFrame:
    """Price row -> message shape: 5 prices rounded to 2 dp, day-formatted time.

    Python's ``round`` is half-even; ``half_even=True`` uses ``bround`` for that.
    """
    r = F.bround if half_even else F.round
    return bars.select(
        F.col(symbol).alias("symbol"),
        r(F.col("close").cast("double"), 2).alias("closing_price"),
        r(F.col("open").cast("double"), 2).alias("opening_price"),
        r(F.col("high").cast("double"), 2).alias("high"),
        r(F.col("low").cast("double"), 2).alias("low"),
        r(F.col("volume").cast("double"), 2).alias("volume"),
        F.date_format(F.col(ts), "yyyy-MM-dd").alias("timestamp"))


def to_json_value(df: DataFrame, ignore_null_fields: bool = True) -> DataFrame:
    """Each row as one JSON ``value`` (B1 / C11)."""
    opts = {} if ignore_null_fields else {"ignoreNullFields": "false"}
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), opts).alias("value"))


def decode_json(records: DataFrame, schema, value: str = "value", keep=("topic", "partition", "offset", "timestamp_ms"),
                objects_only: bool = True) -> DataFrame:
    """``from_json(value, schema)`` expanded to columns.

    ``from_json`` turns text that is not a JSON object into a row of NULLs
    rather than NULL (D6); with ``objects_only`` such records are dropped here
    (they are the dead-letter / ``unknown`` side of the envelope).
    """
    df = records
    if objects_only:
        df = df.where(is_object(F.try_parse_json(F.col(value)), F.col(value)))
    keep = [c for c in keep if c in records.columns]
    return df.select(*keep, F.from_json(F.col(value), schema).alias("_tm_data")).select(
        *keep, "_tm_data.*")


def read_topics(records: DataFrame, topics, schema, topic: str = "topic", **kw) -> DataFrame:
    """One reader over several topics (A2/O5): a single filter + decode with
    the union schema instead of one scan per topic and a union."""
    return decode_json(records.where(F.col(topic).isin(*list(topics))), schema, **kw)


def load_bars(df: DataFrame, date: str = "date") -> DataFrame:
    """Historical bar table -> lower-case columns, ``date`` as 'yyyy-MM-dd' (A6)."""
    t = df.toDF(*[c.lower() for c in df.columns])
    return t.withColumn(date.lower(), F.date_format(F.col(date.lower()).cast("timestamp"),
                                                    "yyyy-MM-dd"))
