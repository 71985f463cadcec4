"""Message and table schemas (explicit; nothing is inferred at read time)."""

from pyspark.sql import types as T

TEXT = (T.StructType()
        .add("id", T.StringType()).add("company", T.StringType())
        .add("timestamp", T.StringType()).add("text", T.StringType())
        .add("replyCount", T.IntegerType()).add("likeCount", T.IntegerType())
        .add("quoteCount", T.IntegerType()).add("repostCount", T.IntegerType()))

PRICE = (T.StructType()
         .add("symbol", T.StringType()).add("closing_price", T.DoubleType())
         .add("opening_price", T.DoubleType()).add("high", T.DoubleType())
         .add("low", T.DoubleType()).add("volume", T.DoubleType())
         .add("timestamp", T.StringType()))

# Scored messages as the scoring service publishes them.
SCORED = (T.StructType()
          .add("id", T.StringType()).add("company", T.StringType())
          .add("text", T.StringType()).add("sentiment_label", T.StringType())
          .add("sentiment_score", T.DoubleType()).add("sentiment", T.StringType())
          .add("timestamp", T.StringType()))

# Union of every field any topic may carry; used to decode a mixed topic value.
ANY_MESSAGE = (T.StructType()
               .add("id", T.StringType()).add("symbol", T.StringType())
               .add("company", T.StringType()).add("timestamp", T.StringType())
               .add("text", T.StringType())
               .add("closing_price", T.DoubleType()).add("opening_price", T.DoubleType())
               .add("high", T.DoubleType()).add("low", T.DoubleType())
               .add("volume", T.DoubleType())
               .add("sentiment_label", T.StringType()).add("sentiment_score", T.DoubleType())
               .add("sentiment", T.StringType())
               .add("ts", T.DoubleType()))

ENVELOPE_DATA = (T.StructType()
                 .add("type", T.StringType())
                 .add("closing_price", T.DoubleType()).add("opening_price", T.DoubleType())
                 .add("high", T.DoubleType()).add("low", T.DoubleType())
                 .add("volume", T.DoubleType())
                 .add("text", T.StringType()).add("id", T.StringType())
                 .add("sentiment_label", T.StringType()).add("sentiment_score", T.DoubleType())
                 .add("original_text", T.StringType()).add("processed_at", T.StringType())
                 .add("payload", T.StringType()))

ENVELOPE = (T.StructType()
            .add("source_topic", T.StringType()).add("kafka_timestamp_ms", T.LongType())
            .add("symbol", T.StringType()).add("timestamp", T.StringType())
            .add("data", ENVELOPE_DATA))

# A topic record as a broker (or a JSON-lines file standing in for one) gives it.
TOPIC_RECORD = (T.StructType()
                .add("topic", T.StringType()).add("partition", T.IntegerType())
                .add("offset", T.LongType()).add("timestamp_ms", T.LongType())
                .add("value", T.StringType()))

POST = (T.StructType()
        .add("cid", T.StringType())
        .add("record", T.StructType().add("createdAt", T.StringType()).add("text", T.StringType()))
        .add("replyCount", T.IntegerType()).add("likeCount", T.IntegerType())
        .add("repostCount", T.IntegerType()).add("quoteCount", T.IntegerType()))


def extend(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    """A new struct with extra fields (``StructType.add`` mutates in place)."""
    return T.StructType(list(schema.fields) + [T.StructField(n, t) for n, t in fields])


# The envelope store as written: envelope + record key + the type partition column.
ENVELOPE_STORED = extend(ENVELOPE, ("kafka_partition", T.IntegerType()),
                         ("kafka_offset", T.LongType()), ("doc_type", T.StringType()),
                         ("event_date", T.StringType()))
