"""Streaming topic sources.

Production reads Kafka; the container has no Kafka connector, so the same
record shape (topic, partition, offset, timestamp_ms, value) is read from a
file stream. Everything downstream is identical for both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import TOPIC_RECORD


def kafka_options(servers: str, topics, starting: str = "earliest",
                  fail_on_data_loss: bool = False, max_offsets_per_trigger: int | None = None) -> dict:
    """Options of the reference's reader (A1/A2): subscribe, from earliest,
    tolerate data loss. ``topics`` may be one name or several."""
    t = topics if isinstance(topics, str) else ",".join(topics)
    o = {"kafka.bootstrap.servers": servers, "subscribe": t, "startingOffsets": starting,
         "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets_per_trigger:
        o["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return o


def kafka_stream(spark: SparkSession, servers: str, topics, **kw) -> DataFrame:
    """Kafka records in the engine's record shape (needs the Kafka connector)."""
    raw = spark.readStream.format("kafka").options(**kafka_options(servers, topics, **kw)).load()
    return raw.select("topic", "partition", "offset",
                      F.unix_millis("timestamp").alias("timestamp_ms"),
                      F.col("value").cast("string").alias("value"))


def index_source(spark: SparkSession, servers: str, topic: str, starting: str = "latest", **kw) -> DataFrame:
    """Records for the index job (T6): a consumer without a stated offset begins at the topic's end. The offset
    counts for a query's first start only; then its checkpoint does."""
    return kafka_stream(spark, servers, topic, starting=starting, **kw)


def file_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Topic records from a directory of files (parquet or JSON lines)."""
    r = spark.readStream.schema(TOPIC_RECORD).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)
