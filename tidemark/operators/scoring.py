"""Text scoring (U1, U2), the unscored set (A5, J5) and the score upsert.

Two scorer paths:

* the default lexicon scorer is a native Spark expression (``keyword_label``):
  it stays in whole-stage codegen and never leaves the JVM;
* any other model plugs in as a ``Scorer``: an iterator ``pandas_udf``
  loads the model once per Python worker and scores Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import NEGATIVE_WORDS, POSITIVE_WORDS
from tidemark.functions.text import keyword_label

SCORE_TYPE = T.StructType([T.StructField("label", T.StringType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("error", T.StringType())])


def label_polarity(label: Column) -> Column:
    """POSITIVE -> 1.0, NEGATIVE -> -1.0, NEUTRAL -> 0.0 (the lexicon scorer's score)."""
    return (F.when(label == "POSITIVE", F.lit(1.0)).when(label == "NEGATIVE", F.lit(-1.0))
             .when(label.isNotNull(), F.lit(0.0)))


def keyword_score(df: DataFrame, text: str = "text", out: str = "sentiment",
                  negative: Sequence[str] = NEGATIVE_WORDS,
                  positive: Sequence[str] = POSITIVE_WORDS,
                  fallback_key: str | None = None) -> DataFrame:
    """The stream's keyword scorer (U1) as a native column: negative words are
    tested first, then positive; no match -> NEUTRAL, or with ``fallback_key`` a
    label picked by hash of that column (stable, unlike the reference's random
    pick, D7); NULL text -> NULL."""
    from tidemark.functions.text import hashed_label
    default = hashed_label(F.col(fallback_key)) if fallback_key else "NEUTRAL"
    return df.withColumn(out, keyword_label(F.col(text), negative, positive, default))


class Scorer:
    """A pluggable text model. ``load`` runs once per Python worker process;
    ``score`` maps a batch of texts to (labels, scores). NULL text -> NULL."""

    def load(self) -> None:  # pragma: no cover - trivial default
        pass

    def key(self) -> str:
        """What makes two scorers the same model: the class and its settings
        (as they are before ``load``). Override it where settings are large."""
        return f"{type(self).__module__}.{type(self).__qualname__}:{sorted(vars(self).items())!r}"

    def score(self, texts: pd.Series) -> tuple[pd.Series, pd.Series]:
        raise NotImplementedError


class LexiconScorer(Scorer):
    """Vectorised pandas version of the lexicon scorer (for the pluggable path)."""

    def __init__(self, negative: Sequence[str] = NEGATIVE_WORDS,
                 positive: Sequence[str] = POSITIVE_WORDS):
        self.negative = list(negative)
        self.positive = list(positive)

    def score(self, texts: pd.Series) -> tuple[pd.Series, pd.Series]:
        low = texts.str.lower()
        neg = pd.Series(False, index=texts.index)
        for w in self.negative:
            neg |= low.str.contains(w, regex=False).fillna(False).astype(bool)
        pos = pd.Series(False, index=texts.index)
        for w in self.positive:
            pos |= low.str.contains(w, regex=False).fillna(False).astype(bool)
        label = pd.Series("NEUTRAL", index=texts.index, dtype=object)
        label[pos] = "POSITIVE"
        label[neg] = "NEGATIVE"
        score = pd.Series(0.0, index=texts.index)
        score[pos] = 1.0
        score[neg] = -1.0
        isnull = texts.isna()
        label[isnull] = None
        score[isnull] = None
        return label, score


#: Loaded models of this Python worker by the scorer's key.
_LOADED: dict[str, Scorer] = {}


def loaded(scorer: Scorer) -> Scorer:
    """The worker's loaded copy of ``scorer``: tasks that follow in the same worker find it.

    Lives in this importable module, so it is one per worker and not one per
    task; the key names class and settings, as a task's scorer is a new object.
    """
    key = scorer.key()
    if key not in _LOADED:
        scorer.load()
        _LOADED[key] = scorer
    return _LOADED[key]


def scorer_column(scorer: Scorer, text: Column, isolate: bool = False) -> Column:
    """``struct<label, score, error>`` computed by ``scorer`` on Arrow batches.

    With ``isolate`` a batch that the model fails on is scored text by text; texts that fail again
    have no label and their error. Executors need this package and the scorer's module (a
    scorer defined in a script or function travels by value).
    """

    @F.pandas_udf(SCORE_TYPE)
    def _score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from tidemark.operators.scoring import loaded as worker_copy
        from tidemark.operators.scoring import one_by_one
        model = worker_copy(scorer)
        for texts in batches:
            try:
                label, score = model.score(texts)
            except Exception:
                if not isolate:
                    raise
                yield one_by_one(model, texts)
                continue
            yield pd.DataFrame({"label": label.values, "score": score.values, "error": None})

    return _score(text)


def one_by_one(model: Scorer, texts: pd.Series) -> pd.DataFrame:
    """Each text alone: its label and score, or its error."""
    rows = []
    for t in texts:
        try:
            label, score = model.score(pd.Series([t], dtype=object))
            rows.append((label.iloc[0], score.iloc[0], None))
        except Exception as e:      # kept with the document, which is tried again later
            rows.append((None, None, f"{type(e).__name__}: {e}"))
    return pd.DataFrame(rows, columns=["label", "score", "error"])


def batch_score(df: DataFrame, text: str = "text", scorer: Scorer | None = None,
                negative: Sequence[str] = NEGATIVE_WORDS,
                positive: Sequence[str] = POSITIVE_WORDS, error: str | None = None) -> DataFrame:
    """Add ``sentiment_label`` and ``sentiment_score``.

    ``scorer=None`` -> the native lexicon expression; otherwise ``scorer``
    through an Arrow-batched pandas UDF. Whole texts are scored. With ``error`` a
    column of that name holds what went wrong with a text (it then has no label); without, it ends the job.
    """
    if scorer is None:
        lab = keyword_label(F.col(text), negative, positive)
        return (df.withColumn("sentiment_label", lab)
                  .withColumn("sentiment_score", label_polarity(F.col("sentiment_label")))
                  .withColumns({error: F.lit(None).cast("string")} if error else {}))
    s = scorer_column(scorer, F.col(text), isolate=error is not None)
    return (df.withColumn("_tm_s", s)
              .withColumn("sentiment_label", F.col("_tm_s.label"))
              .withColumn("sentiment_score", F.col("_tm_s.score"))
              .withColumns({error: F.col("_tm_s.error")} if error else {}).drop("_tm_s"))


def unscored_antijoin(items: DataFrame, scored: DataFrame, key: str) -> DataFrame:
    """Items with no row in the scored table (J5). Only the key column of the
    scored side is read and de-duplicated first: the ``distinct`` is a partial
    aggregate, so a key with a huge group of copies ships at most one row per
    map task instead of landing whole in one join task. Sort-merge, or
    broadcast when AQE measures the key set small."""
    return items.join(scored.select(key).distinct(), key, "left_anti")


DOC_KEY = ("source_topic", "kafka_partition", "kafka_offset")


def score_updates(env: DataFrame, processed_at: str | None = None, scorer: Scorer | None = None,
                  types=None) -> DataFrame:
    """Scores for the unscored raw documents: key + new label/score (B5 input)."""
    from tidemark.operators.daily import unscored_texts
    todo = unscored_texts(env, types).select(*DOC_KEY, F.col("data.text").alias("text"))
    s = batch_score(todo, "text", scorer).where(F.col("sentiment_label").isNotNull())
    return s.select(*DOC_KEY, "text", "sentiment_label", "sentiment_score",
                    processing_time(processed_at).alias("processed_at"))


def processing_time(at: str | None = None) -> Column:
    """``at``, or the time of the batch, as the documents' time strings are written."""
    return F.lit(at) if at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def apply_scores(env: DataFrame, updates: DataFrame, key: Sequence[str] = DOC_KEY) -> DataFrame:
    """Key-matched update (B5/J4): matched documents become ``sentiment`` with
    the new label and score, the original text and the processing time; all
    other documents pass unchanged. A left join on the document key; repeated
    updates of a key count once, so no document is multiplied."""
    # a replay or a second scorer run repeats keys: the latest processing time counts
    newest = updates.groupBy(*key).agg(F.max_by(
        F.struct("sentiment_label", "sentiment_score", "text", "processed_at"), F.struct("processed_at", "sentiment_label",
                                                                                         "sentiment_score", "text")).alias("_tm_u"))
    updates = newest.select(*key, "_tm_u.*")
    u = updates.select(*key, F.lit(True).alias("_tm_hit"),
                       F.col("sentiment_label").alias("_tm_label"),
                       F.col("sentiment_score").alias("_tm_score"),
                       F.col("text").alias("_tm_text"),
                       F.col("processed_at").alias("_tm_at"))
    j = env.join(u, list(key), "left")
    hit = F.coalesce(F.col("_tm_hit"), F.lit(False))
    d = F.col("data")
    data = (d.withField("type", F.when(hit, F.lit("sentiment")).otherwise(d["type"]))
             .withField("sentiment_score", F.when(hit, F.col("_tm_score")).otherwise(d["sentiment_score"]))
             .withField("sentiment_label", F.when(hit, F.col("_tm_label")).otherwise(d["sentiment_label"]))
             .withField("original_text", F.when(hit, F.col("_tm_text")).otherwise(d["original_text"]))
             .withField("processed_at", F.when(hit, F.col("_tm_at")).otherwise(d["processed_at"])))
    return j.withColumn("data", data).select(*env.columns)


def update_store(table, updates: DataFrame, key: Sequence[str] = DOC_KEY, writer: str = "", batch: int | None = None,
                 side: dict[str, str] | None = None, **notes) -> int | None:
    """Write ``updates`` into the stored envelope table (B5/T7) in one commit: the next poll skips what is scored.

    ``table`` is a versioned table by ``doc_type`` and ``event_date``. Of the raw text types and
    ``sentiment`` only folders that hold a document to update are rewritten (found by
    key and, if ``updates`` has ``event_date``, in those days only): a scored document moves to
    ``sentiment``, the others stay. Readers see all of it or nothing. If another writer takes one of
    the folders out meanwhile, the update is made anew on its version. ``side``, ``notes`` and the
    batch's mark go with the commit; the version, or None if the batch was committed before.
    """
    from tidemark.constants import RAW_TEXT_TYPES
    from tidemark.session import scratch_dir
    from tidemark.sources.versioned import Conflict, partition_values
    if batch is not None and table.done(writer, batch):
        return None
    spark = table.spark
    path = scratch_dir(spark, "score-updates") + "/data"
    updates.write.parquet(path)     # read several times, scored once
    updates = spark.read.schema(updates.schema).parquet(path)
    days = {r[0] for r in updates.select("event_date").distinct().collect()} if "event_date" in updates.columns else None
    kinds = {*RAW_TEXT_TYPES, "sentiment"}
    keys = updates.select(*key).distinct()
    place = ["commit", *table.partition_by]
    while True:
        base = table.state()
        near = table.select(base, lambda v: v["doc_type"] in kinds and (days is None or v["event_date"] in days))
        hits = table.read_folders(near, with_commit=True).join(keys, list(key), "left_semi").select(*place).distinct()
        hits = {tuple(r) for r in hits.collect()}       # a folder each
        old = [f for f in near if tuple(partition_values(f)[c] for c in place) in hits]
        added = []
        if old:
            new = apply_scores(table.read_folders(old), updates.drop(*table.partition_by), key)
            added = table.write(new.withColumn("doc_type", F.col("data.type")))
        try:
            return table.commit(base, added, old, side, writer, batch, **notes)
        except Conflict:
            continue


#: Documents that a scorer failed on: their key and place, how often, when they are due again (epoch seconds).
RETRY = (T.StructType().add("source_topic", T.StringType()).add("kafka_partition", T.IntegerType()).add("kafka_offset", T.LongType())
         .add("doc_type", T.StringType()).add("event_date", T.StringType()).add("attempts", T.IntegerType())
         .add("due_at", T.DoubleType()).add("given_up", T.BooleanType()).add("error", T.StringType()))


def scoring_poll(table, writer: str, batch: int, scorer: Scorer | None = None, processed_at: str | None = None,
                 now: float | None = None, max_attempts: int = 5, backoff_s: float = 60.0) -> dict | None:
    """One poll of the scoring loop: unscored documents that came since the last poll, and failed ones that are due.

    Only folders that others added after the version of the writer's last poll are read, and those of due
    documents; unscorable ones (no text) are seen once. A document that the
    scorer fails on waits ``backoff_s``, then twice as long each time, and is given up after
    ``max_attempts`` tries. Scores, the failed documents' state, how far the poll has read and the batch's
    mark are one commit. Returns its notes (scored, failed, given_up), or None if the batch was done.
    """
    import time

    from tidemark.constants import RAW_TEXT_TYPES
    from tidemark.operators.daily import unscored_texts
    from tidemark.session import scratch_dir
    from tidemark.sources.versioned import partition_values
    if table.done(writer, batch):
        return None
    spark, base = table.spark, table.state()
    now = time.time() if now is None else now
    cursor = base.marks.get(writer, {}).get("cursor", 0)
    raw = table.select(base, lambda v: v["doc_type"] in RAW_TEXT_TYPES)
    fresh = [f for f in raw if base.folders[f][0] > cursor and base.folders[f][1] != writer]
    retry = table.read_side(base, f"retry {writer}", RETRY)
    is_due = ~F.col("given_up") & (F.col("due_at") <= now)
    due = retry.where(is_due)
    places = {tuple(r) for r in due.select("doc_type", "event_date").distinct().collect()}      # days of failed documents
    again = [f for f in raw if f not in set(fresh) and tuple(partition_values(f)[c] for c in ("doc_type", "event_date")) in places]
    place = [*DOC_KEY, "doc_type", "event_date"]
    todo = unscored_texts(table.read_folders(fresh)).unionByName(
        unscored_texts(table.read_folders(again)).join(due.select(*DOC_KEY), list(DOC_KEY), "left_semi"))
    todo = todo.select(*place, F.col("data.text").alias("text")).where("text is not null")
    path = scratch_dir(spark, "scores") + "/data"
    scored = batch_score(todo, "text", scorer, error="error").withColumn("processed_at", processing_time(processed_at))
    scored.write.parquet(path)
    scored = spark.read.schema(scored.schema).parquet(path)
    tried = F.coalesce(F.col("attempts"), F.lit(0)) + 1
    failed = scored.where("sentiment_label is null").join(retry.select(*DOC_KEY, "attempts"), list(DOC_KEY), "left").select(
        *place, tried.cast("int").alias("attempts"), (F.lit(float(now)) + F.lit(float(backoff_s)) * F.pow(F.lit(2.0), tried - 1)).alias("due_at"),
        (tried >= max_attempts).alias("given_up"), F.coalesce("error", F.lit("no label")).alias("error"))
    # what was due is scored, has failed again, or is not there any more
    state = retry.where(~is_due).join(scored.select(*DOC_KEY), list(DOC_KEY), "left_anti").select(*RETRY.names).unionByName(
        failed.select(*RETRY.names))
    side = {f"retry {writer}": table.write_side(state)}
    kept = table.read_side(type(base)(side=side), f"retry {writer}", RETRY)
    waiting = kept.agg(F.count_if("given_up"), F.count_if(~F.col("given_up"))).first()
    notes = {"cursor": base.version, "scored": scored.where("sentiment_label is not null").count(),
             "failed": scored.where("sentiment_label is null").count(), "waiting": waiting[1], "given_up": waiting[0]}
    updates = scored.where("sentiment_label is not null").select(
        *DOC_KEY, "event_date", "text", "sentiment_label", "sentiment_score", "processed_at")
    done = update_store(table, updates, writer=writer, batch=batch, side=side, **notes)
    return None if done is None else notes
