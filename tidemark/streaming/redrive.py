"""Dead letters tried again (B4, T8): repaired records of the envelope table, rejected documents of an index.

A dead letter is tried when it is due: at once, then after ``backoff_s``, twice as long each
time, and given up after ``max_attempts`` tries. What a try did is one commit with the batch's
mark: a record that is repaired leaves the dead letters and arrives in the same version, once.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.envelope import to_envelope
from tidemark.operators.scoring import DOC_KEY
from tidemark.sources.versioned import Conflict, VersionedTable, partition_values

#: Tries of the envelope table's dead letters.
TRIES = (T.StructType().add("source_topic", T.StringType()).add("kafka_partition", T.IntegerType()).add("kafka_offset", T.LongType())
         .add("attempts", T.IntegerType()).add("due_at", T.DoubleType()).add("given_up", T.BooleanType()))


def _next(attempts: Column, now: float, backoff_s: float, max_attempts: int) -> tuple[Column, Column]:
    """When a letter that failed for the ``attempts``-th time is due again, and whether it is given up."""
    return F.lit(float(now)) + F.lit(float(backoff_s)) * F.pow(F.lit(2.0), attempts - 1), attempts >= max_attempts


def _written(rows: DataFrame, name: str) -> DataFrame:
    from tidemark.session import scratch_dir
    path = scratch_dir(rows.sparkSession, name) + "/data"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def redrive_dead_letters(table: VersionedTable, repair: Callable[[Column], Column], writer: str, batch: int,
                         now: float | None = None, max_attempts: int = 5, backoff_s: float = 60.0,
                         ingest_ts: str | None = None) -> dict | None:
    """Try the envelope table's due dead letters again: ``repair`` makes a new value of the old one.

    A value that is JSON now is routed as if it had arrived so, under the record's own topic, partition and
    offset. Only folders that hold a repaired letter are rewritten. Letters without an offset cannot be told
    apart and stay as they are. Returns the notes
    (tried, repaired, waiting, given_up), or None if the batch was done.
    """
    now = time.time() if now is None else now
    keys = list(DOC_KEY)
    while True:
        if table.done(writer, batch):
            return None
        base = table.state()
        folders = table.select(base, lambda v: v["doc_type"] == "dead_letter")
        letters = table.read_folders(folders, with_commit=True)
        state = table.read_side(base, f"redrive {writer}", TRIES)
        due = letters.join(state, keys, "left").where(F.col("attempts").isNull() | (~F.col("given_up") & (F.col("due_at") <= now)))
        records = due.select(F.col("source_topic").alias("topic"), F.col("kafka_partition").alias("partition"),
                             F.col("kafka_offset").alias("offset"), F.col("kafka_timestamp_ms").alias("timestamp_ms"),
                             repair(F.col("data.payload")).alias("value"))
        docs = to_envelope(records, ingest_ts, keep_dead_letters=True)
        docs = docs.withColumns({"doc_type": F.col("data.type"), "event_date": F.substring("timestamp", 1, 10)})
        places = due.select(*keys, "commit", F.col("event_date").alias("_day"), F.coalesce("attempts", F.lit(0)).alias("_tries"))
        tried = _written(docs.join(places, keys), "redrive")
        good = tried.where("doc_type <> 'dead_letter'")
        bad = tried.where("doc_type = 'dead_letter'")
        attempts = (F.col("_tries") + 1).cast("int")
        due_at, over = _next(attempts, now, backoff_s, max_attempts)
        bad = bad.select(*keys, attempts.alias("attempts"), due_at.alias("due_at"), over.alias("given_up"))
        after = state.join(tried.select(*keys), keys, "left_anti").unionByName(bad)
        side = {f"redrive {writer}": table.write_side(after.select(*TRIES.names))}
        hits = {tuple(r) for r in good.select("commit", "_day").distinct().collect()}       # a folder each
        old = [f for f in folders if (partition_values(f)["commit"], partition_values(f)["event_date"]) in hits]
        added = []
        if old:
            rest = table.read_folders(old).join(good.select(*keys), keys, "left_anti")
            added = table.write(rest.select(*table.schema.names).unionByName(good.select(*table.schema.names)))
        counts = table.read_side(type(base)(side=side), f"redrive {writer}", TRIES).agg(
            F.count_if(~F.col("given_up")), F.count_if("given_up")).first()
        notes = {"tried": tried.count(), "repaired": good.count(), "waiting": counts[0], "given_up": counts[1]}
        try:
            return None if table.commit(base, added, old, side, writer, batch, **notes) is None else notes
        except Conflict:
            continue


# documents that an index rejected
def dead_documents(spark: SparkSession, path: str, schema: T.StructType) -> VersionedTable:
    """The table of rejected documents: their columns, the error, tries, when due; by whether they are given up."""
    extra = [T.StructField("error", T.StringType()), T.StructField("attempts", T.IntegerType()),
             T.StructField("due_at", T.DoubleType()), T.StructField("given_up", T.StringType())]
    return VersionedTable(spark, path, T.StructType([*schema.fields, *extra]), ["given_up"])


def shipped(docs: DataFrame, send: Callable[[list[dict]], list[str | None]], names: list[str], bulk: int = 500) -> DataFrame:
    """``docs`` with ``error``: what ``send`` said of each (null: accepted); a bulk that it raises on carries the error."""
    schema = T.StructType([f for f in docs.schema.fields if f.name != "error"] + [T.StructField("error", T.StringType())])
    columns = [f.name for f in schema.fields[:-1]]

    def ship(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k in range(0, len(pdf), bulk):
                part = pdf.iloc[k:k + bulk]
                try:
                    errors = send(part[names].to_dict("records"))
                except Exception as e:  # kept with each document
                    errors = [f"{type(e).__name__}: {e}"] * len(part)
                yield pd.DataFrame({**{c: part[c].to_numpy(dtype=object) for c in columns}, "error": errors}, dtype=object)
    return docs.select(*columns).mapInPandas(ship, schema)


def index_batch(dead: VersionedTable, docs: DataFrame, send: Callable, writer: str, batch: int, now: float | None = None,
                backoff_s: float = 60.0, max_attempts: int = 5, bulk: int = 500) -> int | None:
    """Ship a batch's documents; rejected ones become dead letters that are due after ``backoff_s``. The version, or None."""
    if dead.done(writer, batch):
        return None
    now = time.time() if now is None else now
    names = [f.name for f in dead.schema.fields[:-4]]
    due_at, over = _next(F.lit(1), now, backoff_s, max_attempts)
    errors = _written(shipped(docs.select(*names), send, names, bulk).where("error is not null"), "index-errors")
    rows = errors.withColumns({"attempts": F.lit(1), "due_at": due_at, "given_up": over.cast("string")})
    return dead.append(rows, writer, batch)


def redrive_index(dead: VersionedTable, send: Callable, writer: str, batch: int, now: float | None = None,
                  backoff_s: float = 60.0, max_attempts: int = 5, bulk: int = 500) -> dict | None:
    """Ship rejected documents that are due again; accepted ones leave the dead letters.

    A document is sent at least once a try: an index that is keyed by the document's id holds it once, also if
    the writer ends between sending and the commit. Returns tried, accepted; None if the batch was done.
    """
    now = time.time() if now is None else now
    names = [f.name for f in dead.schema.fields[:-4]]
    sent = None
    while True:
        if dead.done(writer, batch):
            return None
        base = dead.state()
        folders = dead.select(base, lambda v: v["given_up"] == "false")
        if sent is None:        # a conflict does not send again
            rows = dead.read_folders(folders, with_commit=True).where(F.col("due_at") <= now)
            sent = _written(shipped(rows, send, names, bulk), "redrive-index")
        # folders of what was tried; their other documents go on waiting as they are
        of = {r[0] for r in sent.select("commit").distinct().collect()}
        old = [f for f in folders if partition_values(f)["commit"] in of]
        attempts = (F.col("attempts") + 1).cast("int")
        due_at, over = _next(F.col("attempts"), now, backoff_s, max_attempts)
        again = sent.where("error is not null").withColumn("attempts", attempts).withColumns(
            {"due_at": due_at, "given_up": over.cast("string")})
        rest = dead.read_folders(old).where(F.col("due_at") > now)
        added = dead.write(rest.unionByName(again.select(*dead.schema.names))) if old else []
        notes = {"tried": sent.count(), "accepted": sent.where("error is null").count()}
        try:
            return None if dead.commit(base, added, old, writer=writer, batch=batch, **notes) is None else notes
        except Conflict:
            continue
