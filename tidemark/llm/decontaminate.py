"""Benchmark decontamination by spaced-seed hashing (operator 1).

Fixed masks over a window of tokens ignore some positions, so a substituted
word there does not change the window's hash. Hashes of all windows of the
benchmark and of the corpus are joined; each hit names a document, an item and
a diagonal, and the overlap on that diagonal is scored over the whole item
(a match counts one, a substitution costs). All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage

#: Token positions of a window that count (1) and that are ignored (0).
MASKS = ("11011011", "11101011")
#: Rows up to which the benchmark's seeds, or the ids of documents with hits, are broadcast.
BROADCAST_ROWS = 500_000


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null or without any: an empty list."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _seeds(hashes: Column, masks: list[str]) -> Column:
    """(seed, position) of every window of every mask, from a list of token hashes."""
    def of(m: int, mask: str) -> Column:
        at = [k for k, c in enumerate(mask) if c == "1"]
        windows = F.slice(hashes, 1, F.greatest(F.size(hashes) - F.lit(len(mask) - 1), F.lit(0)))
        return F.transform(windows, lambda x, i: F.xxhash64(
            F.lit(m), x, *[F.get(hashes, i + F.lit(k)) for k in at[1:]]))

    return F.array(*[of(m, mask) for m, mask in enumerate(masks)])


def _exploded(df: DataFrame, ids: list[str], masks: list[str]) -> DataFrame:
    """ids, seed, pos for every window (the masks' lists one after the other)."""
    df = df.select(*ids, F.transform(F.col("toks"), lambda x: F.xxhash64(x)).alias("h"))
    df = df.select(*ids, F.explode(_seeds(F.col("h"), masks)).alias("seeds"))
    return df.select(*ids, F.posexplode("seeds").alias("pos", "seed"))


def _score(doc: Column, item: Column, penalty: int) -> Column:
    """The best run on a diagonal: matches less ``penalty`` for each substitution between them."""
    same = F.zip_with(doc, item, lambda x, y: F.coalesce(x == y, F.lit(False)))
    start = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc: Column, hit: Column) -> Column:
        run = F.greatest(F.lit(0), acc["run"] + F.when(hit, 1).otherwise(-penalty))
        return F.struct(run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(same, start, step, lambda acc: acc["best"])


def find_contamination(docs: DataFrame, benchmark: DataFrame, least: int = 10, share: float = 0.6,
                       penalty: int = 2, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """doc_id, item_id, score, n_item, doc_pos: the documents that hold (most of) a benchmark item.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns
    are not read. A pair counts if its best run scores min(``least``, ``share``
    of the item's tokens, rounded up) or more; items of fewer tokens than a
    mask must stand whole, and are looked for by their full sequence (their first place
    counts). Items without a token, null ids and empty texts match nothing. A repeated
    document or item gives its pair once; of places with equal scores the first counts. ``doc_pos``
    is the token of the document where the item begins (below 0: before the text).
    """
    longest = max(map(len, masks))
    items = stage(benchmark.where("item_id is not null").select("item_id", tokens(F.col("text")).alias("toks"))
                  .where(F.size("toks") > 0).distinct(), "items")
    short = [r[0] for r in items.select(F.size("toks").alias("n")).where(F.col("n") < longest)
             .distinct().orderBy("n").collect()]        # at most a mask's length of numbers
    texts = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    cut = texts.select("doc_id", tokens(F.col("text")).alias("toks"))
    seeds = stage(_exploded(items.where(F.size("toks") >= longest), ["item_id"], list(masks)).select(
        "item_id", "seed", F.col("pos").alias("ipos")).distinct(), "item-seeds")
    few = seeds.count() <= BROADCAST_ROWS
    hits = _exploded(cut, ["doc_id"], list(masks)).join(F.broadcast(seeds) if few else seeds, "seed")
    hits = hits.select("doc_id", "item_id", (F.col("pos") - F.col("ipos")).alias("diag")).distinct()
    for n in short:     # one row a document and item, however often its few tokens come
        whole = ["1" * n]
        own = _exploded(items.where(F.size("toks") == n), ["item_id"], whole).select("item_id", "seed")
        found = _exploded(cut, ["doc_id"], whole).join(own, "seed").groupBy("doc_id", "item_id").agg(F.min("pos").alias("diag"))
        hits = hits.unionByName(found)
    hits = stage(hits, "hits")

    ids = hits.select("doc_id").distinct()
    few = ids.count() <= BROADCAST_ROWS
    held = texts.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    held = held.select("doc_id", tokens(F.col("text")).alias("dt"))
    both = hits.join(items.select("item_id", F.col("toks").alias("it")), "item_id").join(held, "doc_id")
    n, d = F.size("it"), F.col("diag")
    # the part of the item that lies on the document, and the document's tokens beside it
    skip = F.greatest(F.lit(0), -d)
    item = F.slice("it", skip + 1, n)
    doc = F.slice("dt", d + skip + 1, F.greatest(n - skip, F.lit(0)))
    need = F.when(n < longest, n).otherwise(F.least(F.lit(least), F.ceil(n * F.lit(share)).cast("int")))
    scored = both.select("doc_id", "item_id", n.alias("n_item"), d.alias("doc_pos"),
                         _score(doc, item, penalty).alias("score"), need.alias("_need")).where("score >= _need")
    best = F.max(F.struct("score", (-F.col("doc_pos")).alias("p"), "n_item"))
    return (scored.groupBy("doc_id", "item_id").agg(best.alias("b"))
            .select("doc_id", "item_id", "b.score", "b.n_item", (-F.col("b.p")).alias("doc_pos")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, identifying: int = 8, **options) -> DataFrame:
    """``docs`` without the documents that ``find_contamination`` names for an item of ``identifying`` tokens or more; all columns pass.

    A shorter item ("yes", "forty two") stands in many clean documents: it is reported, and removes none.
    """
    found = find_contamination(docs, benchmark, **options).where(F.col("n_item") >= identifying)
    ids = stage(found.select(F.col("doc_id").alias("_bad")).distinct(), "leaks")
    few = ids.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(ids) if few else ids, F.col("doc_id") == F.col("_bad"), "left_anti")
