"""Streaming queries of the registry. Each one runs a real streaming query
(``availableNow``) over the topic log / envelope store derived from the
driver tables, with its own checkpoint under the shared checkpoint folder,
and returns the sink's contents as a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import constants as K
from tidemark import schemas
from tidemark.plans.queries import query
from tidemark.session import scratch_dir
from tidemark.sources import bindings as B
from tidemark.sources.versioned import envelope_table
from tidemark.streaming import jobs as P
from tidemark.streaming.ledger import LEDGER
from tidemark.streaming.sources import file_stream


def _log_path(spark, d):
    B.topic_log(spark, d)
    return B._STORED[(spark.sparkContext.applicationId, "topic_log", d)]


def _env_path(spark, d):
    B.envelope(spark, d)
    return B._STORED[(spark.sparkContext.applicationId, "envelope", d, K.AS_OF)]


@query("stream_json_source")
def q_stream_json_source(spark, d):
    """A1: file stream of the price topic decoded with the price schema."""
    out = scratch_dir(spark, "stream_json_source")
    s = P.parsed_stream(file_stream(spark, _log_path(spark, d)), schemas.PRICE, K.TOPIC_PRICES)
    P.run(s.writeStream.format("parquet").option("path", out + "/data"), out + "/_checkpoint")
    return spark.read.parquet(out + "/data").drop("topic", "timestamp_ms")


@query("stream_scored")
def q_stream_scored(spark, d):
    """Text topic -> parse -> keyword score -> JSON value sink; the sink
    is read back and decoded."""
    out = scratch_dir(spark, "stream_scored")
    P.start_scoring_job(file_stream(spark, _log_path(spark, d), max_files_per_trigger=4),
                        out + "/data", out + "/_checkpoint", counts=out + "/counts")
    sink_schema = schemas.extend(schemas.TEXT, ("sentiment", T.StringType()))
    back = spark.read.schema("key string, value string").json(out + "/data")
    return back.select(F.from_json("value", sink_schema).alias("m")).select("m.*")


@query("topic_counts")
def q_topic_counts(spark, d):
    """Running count per topic in the state store (update mode)."""
    out = scratch_dir(spark, "topic_counts")
    counts = P.topic_counts_stream(file_stream(spark, _log_path(spark, d), max_files_per_trigger=2))
    w = counts.writeStream.outputMode("update").foreachBatch(P.batch_dir_writer(out + "/data"))
    P.run(w, out + "/_checkpoint")
    return P.latest_per_key(out + "/data", spark, ["topic"])


@query("stream_restart")
def q_stream_restart(spark, d):
    """A second run on the same checkpoint reads only the new files."""
    out = scratch_dir(spark, "stream_restart")
    log = B.topic_log(spark, d)
    src = out + "/topic"
    log.where(F.col("offset") % 2 == 0).write.mode("overwrite").parquet(src + "/part=0")
    ck, sink = out + "/_checkpoint", out + "/data"

    def once():
        s = file_stream(spark, src).select("topic", "partition", "offset")
        P.run(s.writeStream.format("parquet").option("path", sink), ck)
    once()
    log.where(F.col("offset") % 2 == 1).write.mode("overwrite").parquet(src + "/part=1")
    once()
    return spark.read.parquet(sink)


@query("envelope_sink")
def q_envelope_sink(spark, d):
    """Topic stream -> envelope -> per-batch idempotent append,
    partitioned by document type, de-duplicated on (topic, partition, offset)."""
    from tidemark.operators.envelope import flatten_envelope
    out = scratch_dir(spark, "envelope_sink")
    P.start_envelope_job(file_stream(spark, _log_path(spark, d), max_files_per_trigger=4),
                         out + "/data", out + "/_checkpoint", K.AS_OF)
    t = envelope_table(spark, out + "/data").read(where=lambda v: v["doc_type"] != "dead_letter")
    return flatten_envelope(t)


@query("offset_ledger")
def q_offset_ledger(spark, d):
    """Intervals of stored offsets after a stream that delivers a third of the log twice, in other files."""
    out = scratch_dir(spark, "offset_ledger")
    log = B.topic_log(spark, d)
    # of each topic partition the even spans of 50 offsets first, the others after, a third again at the end
    again = log.where("offset % 3 = 0")
    for k, part in enumerate((log.where("offset div 50 % 2 = 0"), log.where("offset div 50 % 2 = 1 and offset % 1000 < 900"), again)):
        part.write.parquet(f"{out}/topic/part={k}")
        records = file_stream(spark, f"{out}/topic").drop("part")
        P.start_envelope_job(records, out + "/data", out + "/_checkpoint", K.AS_OF)
    t = envelope_table(spark, out + "/data")
    stored = t.read().groupBy(F.col("source_topic").alias("topic"), F.col("kafka_partition").alias("partition")).agg(
        F.count(F.lit(1)).alias("n_stored"))
    ledger = t.read_side(t.state(), "ledger", LEDGER).drop("source")
    return ledger.join(stored, ["topic", "partition"])


@query("index_sink")
def q_index_sink(spark, d):
    """Scored-topic documents shipped to an index writer; documents the
    index would reject go to a dead-letter table."""
    out = scratch_dir(spark, "index_sink")
    recs = file_stream(spark, _log_path(spark, d)).where(F.col("topic") == K.TOPIC_SCORED)
    docs = P.parsed_stream(recs, schemas.SCORED).drop("topic", "partition", "timestamp_ms")
    P.start_index_job(docs, out + "/index", out + "/dead", out + "/_checkpoint")
    return spark.read.parquet(out + "/index").drop(*P.BATCH_COLUMNS, "sentiment")


@query("incremental_scoring")
def q_incremental_scoring(spark, d):
    """The envelope store read as a stream; unscored raw documents scored
    and written as score rows keyed by document key."""
    out = scratch_dir(spark, "incremental_scoring")
    schema = schemas.ENVELOPE_STORED
    env = (spark.readStream.schema(schema).option("basePath", _env_path(spark, d))
                .parquet(_env_path(spark, d)).where(F.col("doc_type") != "dead_letter"))
    P.start_incremental_scoring(env, out + "/data", out + "/_checkpoint", K.AS_OF)
    return spark.read.parquet(out + "/data")


@query("stream_daily_sentiment")
def q_stream_daily_sentiment(spark, d):
    """G1 as a stream: each batch stores its partial sums per company and day,
    added up on read."""
    out = scratch_dir(spark, "stream_daily_sentiment")
    schema = schemas.ENVELOPE_STORED
    env = (spark.readStream.schema(schema).option("basePath", _env_path(spark, d))
                .option("maxFilesPerTrigger", "8")
                .parquet(_env_path(spark, d)).where(F.col("doc_type") == "sentiment"))
    P.start_daily_sentiment(env, out + "/data", out + "/_checkpoint")
    return P.read_daily_sentiment(spark, out + "/data")


@query("scoring_loop")
def q_scoring_loop(spark, d):
    """The topic log streamed into the envelope table, two polls of the scoring loop; the table afterwards."""
    from tidemark.operators.envelope import flatten_envelope
    return flatten_envelope(_polled(spark, d).read(where=lambda v: v["doc_type"] != "dead_letter"))


@query("scoring_polls")
def q_scoring_polls(spark, d):
    """What each of two polls did: the second scores only what came in between."""
    table = _polled(spark, d, late=True)
    polls = [e["mark"] for e in table.history() if e["mark"] and "scored" in e["mark"]]      # an entry a poll
    return spark.createDataFrame([(p["batch"], p["scored"], p["failed"]) for p in polls], "poll long, n_scored long, n_failed long")


@query("redrive")
def q_redrive(spark, d):
    """Dead letters of the streamed log tried twice by a repair that mends those of twitter and of prices; where each is now."""
    from tidemark.streaming.redrive import TRIES, redrive_dead_letters
    out = scratch_dir(spark, "redrive")
    P.start_envelope_job(file_stream(spark, _log_path(spark, d)), out + "/data", out + "/_checkpoint", K.AS_OF)
    table = envelope_table(spark, out + "/data")
    dead = table.read(where=lambda v: v["doc_type"] == "dead_letter").select("source_topic", "kafka_partition", "kafka_offset")
    dead.write.parquet(out + "/keys")
    mended = F.lit('{"symbol": "U1", "company": "u1", "text": "u1 record", "closing_price": 1.5, "timestamp": "2024-01-09"}')

    def repair(topics):
        # a repair sees the value alone; the topic is told by the column beside it
        return lambda value: F.when(F.col("source_topic").isin(topics), mended).otherwise(value)
    redrive_dead_letters(table, repair([K.TOPIC_TWITTER]), "redrive", 0, now=0.0, ingest_ts=K.AS_OF)
    redrive_dead_letters(table, repair([K.TOPIC_TWITTER, K.TOPIC_PRICES]), "redrive", 1, now=60.0, ingest_ts=K.AS_OF)
    tries = table.read_side(table.state(), "redrive redrive", TRIES).select("source_topic", "kafka_partition", "kafka_offset", "attempts")
    keys = ["source_topic", "kafka_partition", "kafka_offset"]
    now = table.read().select(*keys, F.col("data.type").alias("doc_type"), "symbol", "timestamp")
    return spark.read.parquet(out + "/keys").join(now, keys).join(tries, keys, "left").select(
        "source_topic", "kafka_offset", "doc_type", "symbol", "timestamp", "attempts")


def _polled(spark, d, late: bool = False):
    """The envelope table after two polls; with ``late`` the records of every tenth offset arrive between them."""
    out = scratch_dir(spark, "scoring_loop")
    log = B.topic_log(spark, d)
    for k, part in enumerate((log.where("offset % 10 <> 0"), log.where("offset % 10 = 0")) if late else (log,)):
        part.write.parquet(f"{out}/topic/part={k}")
        P.start_envelope_job(file_stream(spark, f"{out}/topic").drop("part"), out + "/data", out + "/_checkpoint", K.AS_OF)
        P.start_scoring_loop(spark, out + "/data", out + "/_polls", processed_at=K.AS_OF, available_now=True)
    if not late:
        P.start_scoring_loop(spark, out + "/data", out + "/_polls", processed_at=K.AS_OF, available_now=True)
    return envelope_table(spark, out + "/data")
