"""Streaming jobs (T1-T8) built from the batch operators.

Every job is one streaming query with a stable checkpoint directory (the
reference made a new random one per run, so each restart re-read the whole
topic: D20). Sinks are idempotent per micro-batch: a batch writes its own
``query_id=Q/batch_id=N`` directory with overwrite, so a replay after a failure
replaces rather than duplicates its output, and a query started on a new
checkpoint (whose batch ids begin at 0 again) never overwrites an older one's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import constants as K
from tidemark import schemas
from tidemark.operators.envelope import decode_json, to_envelope
from tidemark.operators.scoring import Scorer, batch_score, keyword_score


def run(writer, checkpoint: str, available_now: bool = True, processing_time: str | None = None,
        timeout_s: float | None = None):
    """Start a stream writer with a checkpoint; ``availableNow`` drains what is
    there and stops (tests, catch-up); otherwise a processing-time trigger."""
    w = writer.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(
        processingTime=processing_time or "60 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination(timeout_s)
    return q


def batch_path(path: str, df: DataFrame, batch_id: int) -> str:
    """Where batch N of the running query writes: the query id is part of it."""
    query = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
    return f"{path}/query_id={query}/batch_id={batch_id}"


#: Partition columns of a table of batch directories.
BATCH_COLUMNS = ("query_id", "batch_id")


def batch_dir_writer(path: str, partition_by: list[str] | None = None,
                     fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: batch N -> its own directory (overwrite = idempotent)."""
    def write(df: DataFrame, batch_id: int) -> None:
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.format(fmt).save(batch_path(path, df, batch_id))
    return write


def fan_out(*writers: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """T4: one source read feeding several sinks. The micro-batch is persisted
    once, every writer runs on it, then it is released. (The reference ran
    one streaming query per sink, each re-reading the topic and re-scoring.)"""
    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            for w in writers:
                w(df, batch_id)
        finally:
            df.unpersist()
    return write


def console_writer(df: DataFrame, truncate: bool = False, rows: int = 20):
    """B2: untruncated console output of a stream (debugging)."""
    return (df.writeStream.outputMode("append").format("console")
              .option("truncate", str(truncate).lower()).option("numRows", str(rows)))


def topic_count_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Per-batch record count by topic, one small row set per batch."""
    def write(df: DataFrame, batch_id: int) -> None:
        (df.groupBy("topic").agg(F.count(F.lit(1)).alias("n_rows"))
           .write.mode("overwrite").parquet(batch_path(path, df, batch_id)))
    return write


def json_value_writer(path: str, key: str | None = "id") -> Callable[[DataFrame, int], None]:
    """B1 as a batch writer: rows -> JSON values (a topic sink stand-in)."""
    def write(df: DataFrame, batch_id: int) -> None:
        json_value_stream(df.drop("topic", "partition", "offset"), key).write.mode(
            "overwrite").json(batch_path(path, df, batch_id))
    return write


def topic_writer(options: dict, fmt: str = "kafka", key: str | None = "id") -> Callable[[DataFrame, int], None]:
    """B1: rows as JSON values to a topic (``options``: see ``kafka_sink_options``)
    or any other batch sink ``fmt``; at-least-once, as a broker sink is."""
    def write(df: DataFrame, batch_id: int) -> None:
        json_value_stream(df.drop("topic", "partition", "offset"), key).write.format(
            fmt).options(**options).mode("append").save()
    return write


# A1 / T1 / B1
def parsed_stream(records: DataFrame, schema, topic: str | None = None) -> DataFrame:
    """A1: records of one topic decoded with a fixed schema (non-objects dropped, D6)."""
    if topic:
        records = records.where(F.col("topic") == topic)
    return decode_json(records, schema, keep=("topic", "partition", "offset", "timestamp_ms"))


def scored_stream(records: DataFrame, topics=(K.TOPIC_TWITTER,), scorer: Scorer | None = None,
                  negative=K.NEGATIVE_WORDS, positive=K.POSITIVE_WORDS) -> DataFrame:
    """Text topics -> parse -> score -> ``sentiment`` column.

    The reference read the topics once per sink and scored twice (console and
    topic could disagree); here one query feeds every sink. Per-batch counts
    by topic are attached with ``observe`` (T2) instead of a second query.
    """
    recs = records.where(F.col("topic").isin(*list(topics)))
    recs = recs.observe("per_topic",
                        *[F.count(F.when(F.col("topic") == t, 1)).alias(t) for t in topics],
                        F.count(F.lit(1)).alias("records"))
    parsed = decode_json(recs, schemas.TEXT, keep=("topic", "partition", "offset"))
    if scorer is None:
        return keyword_score(parsed, "text", "sentiment", negative, positive)
    s = batch_score(parsed, "text", scorer)
    return s.withColumnRenamed("sentiment_label", "sentiment").drop("sentiment_score")


def json_value_stream(df: DataFrame, key: str | None = "id") -> DataFrame:
    """B1: each row as a JSON ``value`` (and the message key), ready for a topic sink."""
    cols = [c for c in df.columns]
    out = [F.to_json(F.struct(*[F.col(c) for c in cols])).alias("value")]
    if key:
        out.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*out)


def kafka_sink_options(servers: str, topic: str) -> dict:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


class ObservedCounts:
    """Per-batch counts published by ``observe("per_topic", ...)`` and
    summed per query on the driver, from query progress events. Nothing
    re-reads the source (the reference started an extra counting query per
    topic). Register with ``spark.streams.addListener(obs.listener)``. The
    totals cover all batches; of single batches the last ``keep`` are held."""

    def __init__(self, name: str = "per_topic", keep: int = 100):
        from collections import deque

        from pyspark.sql.streaming import StreamingQueryListener
        self.name = name
        self.batches: deque[dict] = deque(maxlen=keep)
        self.totals: dict[str, int] = {}
        outer = self

        class _L(StreamingQueryListener):
            def onQueryStarted(self, event):
                pass

            def onQueryProgress(self, event):
                row = event.progress.observedMetrics.get(outer.name)
                if row is None:
                    return
                d = row.asDict()
                outer.batches.append({"batch_id": event.progress.batchId, **d})
                for k, v in d.items():
                    outer.totals[k] = outer.totals.get(k, 0) + int(v or 0)

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                pass

        self.listener = _L()


# G4 / T2
def topic_counts_stream(records: DataFrame) -> DataFrame:
    """Running message count per topic, kept in the checkpointed state
    store (the reference's driver-side counter was lost on restart)."""
    return records.groupBy("topic").agg(F.count(F.lit(1)).alias("n_rows"))


def latest_per_key(path: str, spark: SparkSession, keys: list[str]) -> DataFrame:
    """Read an update-mode batch-dir table: the newest version of every key.
    Versions are ordered by batch, so the table must be one query's."""
    t = spark.read.parquet(path)
    if t.select("query_id").distinct().limit(2).count() > 1:
        raise ValueError(f"{path} holds batches of several queries; read one query_id")
    others = [c for c in t.columns if c not in keys and c not in BATCH_COLUMNS]
    return (t.groupBy(*keys)
             .agg(F.max_by(F.struct(*others), F.col("batch_id")).alias("_v"))
             .select(*keys, "_v.*"))


# B3 / T5
ENVELOPE_KEY = ["source_topic", "kafka_partition", "kafka_offset"]


def envelope_stream(records: DataFrame, ingest_ts: str | None = None) -> DataFrame:
    """T5: topic records -> envelope documents with their type and event day.

    Stateless: order and lateness of records do not matter. Redelivered records
    are taken out by the sink (``envelope_writer``), which knows what is stored.
    """
    env = to_envelope(records, ingest_ts=ingest_ts, keep_dead_letters=True)
    return env.withColumns({"doc_type": F.col("data.type"), "event_date": F.substring("timestamp", 1, 10)})


def envelope_writer(table: str, source: str = "") -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of the envelope table (``sources.versioned``), partitioned by type and event day.

    A record is stored once. Which records are stored stands in the table's
    offset ledger, intervals per (source, topic, partition); ``source`` tells
    brokers apart whose topics have the same names. A batch's documents, the ledger grown by them
    and the batch's mark become valid in one commit, so a replay finds itself done, whatever the step at which
    the writer ended before, and a batch costs what it holds, not what the table holds. Records
    without an offset cannot be told apart and are all stored.
    """
    from tidemark.sources.versioned import Conflict, envelope_table
    from tidemark.streaming.ledger import LEDGER, intervals, merged, not_stored
    opened: dict = {}

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        if table not in opened:
            opened[table] = envelope_table(spark, table)
        store = opened[table]
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        if store.done(query, batch_id):
            return
        rows = df.withColumn("source", F.lit(source)).withColumnsRenamed(
            {"source_topic": "topic", "kafka_partition": "partition", "kafka_offset": "offset"}).persist()
        try:
            while True:
                base = store.state()
                ledger = store.read_side(base, "ledger", LEDGER)
                fresh = not_stored(rows, ledger).withColumnsRenamed(
                    {"topic": "source_topic", "partition": "kafka_partition", "offset": "kafka_offset"})
                added = store.write(fresh)
                side = store.write_side(merged(ledger, intervals(rows)))
                try:
                    store.commit(base, added, side={"ledger": side}, writer=query, batch=batch_id)
                    return
                except Conflict:      # another writer's ledger came between: hold the batch against it
                    continue
        finally:
            rows.unpersist()
    return write


# B4 / T6 / T8
def index_writer(index_path: str, dead_path: str, id_col: str = "id"):
    """foreachBatch writer of a table that stands for a search index.

    Documents without an id (which an index would reject) go to the dead-letter
    table instead of failing the batch (T8); the rest are written keyed by id.
    ``client_index_writer`` ships documents to a client instead.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        flagged = df.withColumn("_tm_ok", F.col(id_col).isNotNull()).persist()
        try:   # the batch is read once for both outputs
            flagged.where("_tm_ok").drop("_tm_ok").write.mode("overwrite").parquet(
                batch_path(index_path, df, batch_id))
            flagged.where(~F.col("_tm_ok")).drop("_tm_ok").withColumn(
                "error", F.lit("missing document id")).write.mode("overwrite").parquet(
                batch_path(dead_path, df, batch_id))
        finally:
            flagged.unpersist()
    return write


def client_index_writer(send: Callable[[list[dict]], list[str | None]], dead_path: str, bulk: int = 500):
    """Documents shipped from the executors in bulks through ``send``.

    ``send`` takes documents and returns, in their order, an error or None for
    each; if it raises, the whole bulk carries the error. Rejected documents and
    their errors become the batch's dead-letter rows; the others are done. One
    pass: the errors are what the batch writes.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        names = list(df.columns)
        schema = T.StructType([*df.schema.fields, T.StructField("error", T.StringType())])

        def ship(batches):
            import pandas as pd
            for pdf in batches:
                for k in range(0, len(pdf), bulk):
                    part = pdf.iloc[k:k + bulk]
                    try:
                        errors = send(part.to_dict("records"))
                    except Exception as e:  # the bulk's error is kept per document
                        errors = [f"{type(e).__name__}: {e}"] * len(part)
                    bad = [i for i, x in enumerate(errors) if x is not None]
                    out = {c: part[c].to_numpy(dtype=object)[bad] for c in names}
                    yield pd.DataFrame({**out, "error": [errors[i] for i in bad]}, dtype=object)
        df.mapInPandas(ship, schema).write.mode("overwrite").parquet(batch_path(dead_path, df, batch_id))
    return write


def dead_letter_split(records: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good, bad) records; bad = value that is not JSON. Null-safe, no exceptions."""
    ok = F.try_parse_json(F.col(value)).isNotNull()
    return records.where(ok), records.where(~ok | F.col(value).isNull())


# T7
def incremental_scores(env_stream: DataFrame, processed_at: str | None = None,
                       scorer: Scorer | None = None) -> DataFrame:
    """Unscored raw documents arriving on the envelope stream -> score rows."""
    from tidemark.operators.scoring import score_updates
    return score_updates(env_stream, processed_at, scorer)


# G1 as a stream
def sentiment_partials(env: DataFrame) -> DataFrame:
    """G1, one batch: company, date, and the sums that daily sentiment is made of."""
    from tidemark.functions.dates import event_instant
    at = event_instant(F.col("timestamp"))
    docs = (env.where(F.col("data.type") == "sentiment")
               .select(F.col("symbol").alias("company"), F.date_format(at, "yyyy-MM-dd").alias("date"),
                       F.upper(F.col("data.sentiment_label")).alias("label"),
                       F.col("data.sentiment_score").alias("score"))
               .where(F.col("date").isNotNull()))
    return docs.groupBy("company", "date").agg(
        F.sum("score").alias("score_sum"), F.count("score").alias("score_n"), F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("label") == "POSITIVE", 1).otherwise(0)).alias("positive_n"))


def merge_sentiment_partials(partials: DataFrame) -> DataFrame:
    """Daily sentiment from the partial sums of all batches (any order, any number per day)."""
    t = partials.groupBy("company", "date").agg(*[F.sum(c).alias(c) for c in ("score_sum", "score_n", "n", "positive_n")])
    return t.select("company", "date", F.when(F.col("score_n") > 0, F.col("score_sum") / F.col("score_n")).alias("avg_sentiment"),
                    F.col("n").alias("sentiment_count"), (F.col("positive_n") / F.col("n")).alias("positive_ratio"))


#: Partial sums as stored: level 0 are batches, each level above merges several folders of the one below.
PARTIALS = (T.StructType().add("company", T.StringType()).add("date", T.StringType()).add("score_sum", T.DoubleType())
            .add("score_n", T.LongType()).add("n", T.LongType()).add("positive_n", T.LongType()).add("level", T.StringType()))


def partials_table(spark: SparkSession, path: str):
    """The versioned table of partial sums, by level."""
    from tidemark.sources.versioned import VersionedTable
    return VersionedTable(spark, path, PARTIALS, ["level"])


def compact_partials(table, fan_in: int = 8) -> int:
    """Merge the folders of a level into one of the next wherever ``fan_in`` have come together; how many merges.

    A level then holds fewer than ``fan_in`` folders, each with one row per company and day at most, and a
    partial sum is rewritten once a level: reading n batches costs fan_in x log(n) folders. A
    merge is one commit, so readers add up either the parts or their sum; if another
    compaction comes first this one leaves the level to it.
    """
    from tidemark.sources.versioned import Conflict
    merges = level = 0
    while True:
        base = table.state()
        if not any(f.endswith(f"/level={k}") for k in range(level, level + 64) for f in base.folders):
            return merges
        parts = table.select(base, lambda v, at=str(level): v["level"] == at)
        if len(parts) >= fan_in:
            sums = table.read_folders(parts).groupBy("company", "date").agg(
                *[F.sum(c).alias(c) for c in ("score_sum", "score_n", "n", "positive_n")])
            try:
                table.commit(base, table.write(sums.withColumn("level", F.lit(str(level + 1)))), parts, writer="compaction")
                merges += 1
            except Conflict:
                pass
        level += 1


def read_daily_sentiment(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """Daily sentiment as of a version of the partial sums (by default the newest)."""
    return merge_sentiment_partials(partials_table(spark, table).read(version))


def start_daily_sentiment(env_stream: DataFrame, table: str, checkpoint: str, available_now: bool = True,
                          processing_time: str | None = None, fan_in: int = 8):
    """G1 as a stream without state: each batch stores its partial sums, a reader
    adds them up (``read_daily_sentiment``). No document is too late and
    the result does not depend on how files fall into batches. A batch's sums are one commit under its mark, so
    a replay adds nothing; sums of many batches are merged level by level (``compact_partials``)."""
    opened: dict = {}

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        store = opened.setdefault(table, partials_table(spark, table))
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        store.append(sentiment_partials(df).withColumn("level", F.lit("0")), query, batch_id)
        compact_partials(store, fan_in)
    return run(env_stream.writeStream.foreachBatch(write), checkpoint, available_now, processing_time)


def daily_sentiment_stream(env_stream: DataFrame, lateness: str) -> DataFrame:
    """G1 on a live stream: 1-day event-time windows per company with a watermark,
    so finished days leave the state store.

    ``lateness`` is the bound that the caller vouches for: Spark drops documents
    that are later than it behind the newest one seen. For a backlog (files in
    any order) or without such a bound use ``start_daily_sentiment``.
    """
    from tidemark.functions.dates import event_instant
    docs = (env_stream.where(F.col("data.type") == "sentiment")
                      .select(F.col("symbol").alias("company"),
                              event_instant(F.col("timestamp")).alias("event_time"),
                              F.upper(F.col("data.sentiment_label")).alias("label"),
                              F.col("data.sentiment_score").alias("score"))
                      .where(F.col("event_time").isNotNull()))
    agg = (docs.withWatermark("event_time", lateness)
               .groupBy(F.window("event_time", "1 day"), "company")
               .agg(F.avg("score").alias("avg_sentiment"),
                    F.count(F.lit(1)).alias("sentiment_count"),
                    F.avg(F.when(F.col("label") == "POSITIVE", F.lit(1.0)).otherwise(F.lit(0.0)))
                     .alias("positive_ratio")))
    return agg.select("company", F.date_format("window.start", "yyyy-MM-dd").alias("date"),
                      "avg_sentiment", "sentiment_count", "positive_ratio")


# job starters
def start_scoring_job(records: DataFrame, out: str, checkpoint: str, counts: str | None = None,
                      console: bool = False, console_rows: int = 20, available_now: bool = True,
                      processing_time: str | None = None, scorer: Scorer | None = None,
                      sink: Callable[[DataFrame, int], None] | None = None):
    """Text topics -> score -> JSON values at ``out`` (per-batch,
    idempotent) or through ``sink`` (such as ``topic_writer``), optional per-batch
    topic counts and an echo of ``console_rows`` rows, all from one read of the source."""
    scored = scored_stream(records, scorer=scorer)
    writers = [sink or json_value_writer(out)]
    if counts:
        writers.append(topic_count_writer(counts))
    if console:
        writers.append(lambda df, bid: df.show(console_rows, truncate=False))
    return run(scored.writeStream.foreachBatch(fan_out(*writers)), checkpoint, available_now,
               processing_time)


def start_topic_scoring(spark: SparkSession, servers: str, topics, scored_topic: str, checkpoint: str,
                        source: Callable[..., DataFrame] | None = None, fmt: str = "kafka", sink_options: dict | None = None,
                        available_now: bool = False, processing_time: str | None = None, scorer: Scorer | None = None, **kw):
    """T1/B1 from broker to broker: text topics -> score -> JSON values keyed by id on ``scored_topic``.

    ``source(spark, servers, topics, **kw)`` is ``kafka_stream`` by default and ``fmt`` the broker's sink; both can stand
    in by others of the same shape. Delivery is at least once, as a broker sink is: readers drop repeats by key and offset.
    """
    from tidemark.streaming.sources import kafka_stream
    topics = [topics] if isinstance(topics, str) else list(topics)
    scored = scored_stream((source or kafka_stream)(spark, servers, topics, **kw), topics, scorer)
    sink = topic_writer(sink_options or kafka_sink_options(servers, scored_topic), fmt)
    return run(scored.writeStream.foreachBatch(sink), checkpoint, available_now, processing_time)


def start_envelope_job(records: DataFrame, table: str, checkpoint: str, ingest_ts: str | None = None,
                       available_now: bool = True, processing_time: str | None = None, source: str = ""):
    """Topic records -> envelope documents appended per batch to
    ``table`` (partitioned by document type and event day, dead letters
    included), redelivered records dropped on (source, topic, partition, offset)."""
    env = envelope_stream(records, ingest_ts)
    return run(env.writeStream.foreachBatch(envelope_writer(table, source)), checkpoint, available_now, processing_time)


def start_index_job(docs: DataFrame, index: str, dead: str, checkpoint: str,
                    available_now: bool = True, processing_time: str | None = None,
                    writer: Callable[[DataFrame, int], None] | None = None):
    """Documents shipped to an index writer (``writer`` if given, such as
    ``client_index_writer``); rejected ones to ``dead``."""
    w = docs.writeStream.foreachBatch(writer or index_writer(index, dead))
    return run(w, checkpoint, available_now, processing_time)


def start_incremental_scoring(env_stream: DataFrame, out: str, checkpoint: str,
                              processed_at: str | None = None, scorer: Scorer | None = None,
                              available_now: bool = True,
                              processing_time: str | None = "60 seconds"):
    """Score what arrives unscored, every ``processing_time`` (the
    reference's 60 s loop) or once with ``availableNow``."""
    s = incremental_scores(env_stream, processed_at, scorer)
    return run(s.writeStream.format("parquet").option("path", out), checkpoint, available_now,
               processing_time)


def patiently(work: Callable[[], object], tries: int = 3, wait_s: float = 60.0, sleep: Callable[[float], None] | None = None):
    """``work()``, after an error again when ``wait_s`` has gone by; the last try's error is raised."""
    import time
    for left in range(tries - 1, -1, -1):
        try:
            return work()
        except Exception:
            if not left:
                raise
            (sleep or time.sleep)(wait_s)


def start_scoring_loop(spark: SparkSession, table: str, checkpoint: str, scorer: Scorer | None = None,
                       interval: str = "60 seconds", available_now: bool = False, processed_at: str | None = None,
                       tries: int = 3, wait_s: float = 60.0, **poll):
    """Every ``interval`` the envelope table's unscored documents are scored and updated in place
    (``scoring_poll``), as a streaming query whose source is a clock: its batches mark the polls, so
    a restart neither repeats nor skips one. A poll that fails is tried again after
    ``wait_s``. ``available_now`` makes one poll."""
    from tidemark.operators.scoring import scoring_poll
    from tidemark.sources.versioned import envelope_table
    clock = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()
    opened: dict = {}

    def write(df: DataFrame, batch_id: int) -> None:
        session = df.sparkSession
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        store = opened.setdefault(table, envelope_table(session, table))
        patiently(lambda: scoring_poll(store, query, batch_id, scorer, processed_at, **poll), tries, wait_s)
    return run(clock.writeStream.foreachBatch(write), checkpoint, available_now, interval)
