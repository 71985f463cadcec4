"""Ranked lexical search (operator 11) over K2-treaps of impacts.

Documents are cut into shards (whole documents, at most ``SHARD_DOCS`` and about
``SHARD_BYTES`` of text); a shard's grid of terms and documents is one K2-treap, a row
of the index with its terms, their numbers of documents and the document ids. A
query's terms are weighed by their documents over all shards; tasks descend their
shards one after the other, carrying the best scores along, and hand on k documents a
query.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import python_batches, stage
from tidemark.llm.k2_treap import K2Treap, best_first

#: Documents and bytes of text of a shard.
SHARD_DOCS, SHARD_BYTES = 2048, 5_000_000
#: Queries and their terms that a pass over the index answers.
BLOCK_QUERIES, BLOCK_TERMS = 512, 20_000
#: Letters, digits and every byte of a character outside ASCII are a term's (A-Z in lower case); all else parts terms.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text, in order and with repeats."""
    return (text or "").encode().translate(_TABLE).split()


@dataclass
class Corpus:
    """Documents with a term, and terms with repeats, of the indexed corpus."""

    n_docs: int
    n_terms: int

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * df + 1)))

    def length(self, n: int) -> int:
        """A document's m, from its number of terms."""
        return 100 - 90 + 90 * n * self.n_docs // self.n_terms


@dataclass
class Index:
    """``shards``: doc_ids, terms (joined by blanks, in the order of rows), dfs, treap."""

    shards: DataFrame
    corpus: Corpus


def corpus_of(docs: DataFrame, text: str = "text") -> Corpus:
    """Counted over all documents."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = total = 0
        for pdf in batches:
            sizes = [len(terms_of(t)) for t in pdf["text"]]
            n, total = n + sum(s > 0 for s in sizes), total + sum(sizes)
        yield pd.DataFrame({"n": [n], "total": [total]})
    r = docs.select(F.col(text).alias("text")).mapInPandas(count, "n long, total long").agg(F.sum("n"), F.sum("total")).first()
    return Corpus(int(r[0] or 0), int(r[1] or 0))


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_docs: int = SHARD_DOCS,
                shard_bytes: int = SHARD_BYTES) -> Index:
    """Index every document that has a term; staged in the shared folder.

    Ids are integers or null. Every row is a document, rows of equal id or text too; other
    columns are not looked at. Texts are read twice, for the corpus' counts and for the grids.
    """
    python_batches(docs.sparkSession, 200)
    corpus = corpus_of(docs, text)

    def shard(ids: list, lengths: list[int], rows: list[np.ndarray], times: list[np.ndarray], vocab: dict) -> pd.DataFrame:
        term, tf = np.concatenate(rows), np.concatenate(times)
        col = np.repeat(np.arange(len(ids)), [len(r) for r in rows])
        m = np.array([corpus.length(n) for n in lengths], dtype=np.int64)
        impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[col])
        df = np.bincount(term, minlength=len(vocab))
        order = np.argsort(-df, kind="stable")      # frequent terms lie together in the first strip
        place = np.empty(len(vocab), dtype=np.int64)
        place[order] = np.arange(len(vocab))
        words = list(vocab)
        treap = K2Treap.build(place[term], col, impact, len(ids))
        return pd.DataFrame({"doc_ids": [ids], "terms": [b" ".join(words[i] for i in order)],
                             "dfs": [df[order].astype("<u4").tobytes()], "treap": [treap.to_bytes()]})

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, lengths, rows, times, vocab, held = [], [], [], [], {}, 0
        for pdf in batches:
            for i, t in zip(pdf["key"], pdf["text"], strict=True):
                words = terms_of(t)
                if not words:
                    continue
                c = Counter(words)
                ids.append(None if pd.isna(i) else int(i))
                lengths.append(len(words))
                rows.append(np.fromiter((vocab.setdefault(w, len(vocab)) for w in c), np.int64, len(c)))
                times.append(np.fromiter(c.values(), np.int64, len(c)))
                held += len(t)
                if len(ids) >= shard_docs or held >= shard_bytes:
                    yield shard(ids, lengths, rows, times, vocab)
                    ids, lengths, rows, times, vocab, held = [], [], [], [], {}, 0
        if ids:
            yield shard(ids, lengths, rows, times, vocab)
    # an id goes as text: with a null among them pandas would make integers doubles
    parts = docs.select(F.col(key).cast("long").cast("string").alias("key"), F.col(text).alias("text")).mapInPandas(
        work, "doc_ids array<long>, terms binary, dfs binary, treap binary")
    return Index(stage(parts, "search-index"), corpus)


def _blocks(queries: DataFrame, item: str, text: str) -> Iterator[list[tuple]]:
    """(item id, distinct terms) of all queries, a bounded block at a time."""
    block, n = [], 0
    for r in queries.select(F.col(item), F.col(text)).toLocalIterator():
        words = sorted(set(terms_of(r[1])))
        block.append((r[0], words))
        n += len(words)
        if len(block) >= BLOCK_QUERIES or n >= BLOCK_TERMS:
            yield block
            block, n = [], 0
    if block:
        yield block


def document_frequencies(index: Index, terms: list[bytes]) -> dict[bytes, int]:
    """Documents of each of ``terms`` over all shards; reads the shards' terms, not their treaps."""
    place = {t: i for i, t in enumerate(terms)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(place), dtype=np.int64)
        for pdf in batches:
            for words, dfs in zip(pdf["terms"], pdf["dfs"], strict=True):
                df = np.frombuffer(dfs, dtype="<u4")
                for k, w in enumerate(words.split(b" ")):
                    if w in place:
                        total[place[w]] += df[k]
        at = np.flatnonzero(total)
        yield pd.DataFrame({"term": at, "df": total[at]})
    python_batches(index.shards.sparkSession, 4)
    rows = index.shards.select("terms", "dfs").mapInPandas(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {terms[r["term"]]: r["df"] for r in rows.collect()}      # at most a block's terms


def _descend(block: list[tuple], weights: dict[bytes, int], k: int):
    """Over a task's shards: the k best documents of each query of the block."""
    query = np.repeat(np.arange(len(block)), [len(w) for _, w in block])
    words = [w for _, ws in block for w in ws]
    weight = np.array([weights.get(w, 0) for w in words], dtype=np.int64)
    wanted = {w for w, x in weights.items() if x > 0}

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top = np.zeros((len(block), k), dtype=np.int64)
        best = pd.DataFrame({"query": [], "doc_id": [], "score": []}, dtype="int64").astype({"doc_id": "Int64"})
        for pdf in batches:
            for ids, terms, data in zip(pdf["doc_ids"], pdf["terms"], pdf["treap"], strict=True):
                rows = {w: r for r, w in enumerate(terms.split(b" ")) if w in wanted}
                row = np.array([rows.get(w, -1) for w in words], dtype=np.int64)
                here = row >= 0
                if not here.any():
                    continue
                q, col, score = best_first(K2Treap.from_bytes(data), query[here], row[here], weight[here], top)
                ids = pd.array([None if pd.isna(x) else int(x) for x in ids], dtype="Int64")
                best = pd.concat([best, pd.DataFrame({"query": q, "doc_id": ids[col], "score": score})])
                # equal scores by id, as the ranking does (null ids first)
                best = best.sort_values(["query", "score", "doc_id"], ascending=[True, False, True], na_position="first")
                best = best.groupby("query").head(k)
        if len(best):
            yield best.assign(doc_id=best["doc_id"].astype(object).where(best["doc_id"].notna(), None))
    return work


def search(index: Index, queries: DataFrame, k: int = 10, item: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, rank (int, from 1), doc_id, score: the k best documents with a score above 0 of every query row.

    A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))); a document scores the sum over the query's
    distinct terms of weight x ((10^9 tf) div (1000 tf + 8 m)), m = 10 + (90 n N) div L. Equal
    scores by ascending id, nulls first; rows of equal id are ranked each. Query rows of equal id are
    answered each; a query without a known term has no rows. Queries go in blocks of bounded
    size, each one pass over the index.
    """
    spark = index.shards.sparkSession
    kind = queries.schema[item].dataType.simpleString()
    answers = []
    for block in _blocks(queries, item, text):
        terms = sorted(set().union(*[w for _, w in block]))
        weights = {t: index.corpus.weight(n) for t, n in document_frequencies(index, terms).items()} if terms else {}
        python_batches(spark, 1)        # a shard at a time
        rows = index.shards.select("doc_ids", "terms", "treap").mapInPandas(
            _descend(block, weights, k), "query long, doc_id long, score long")
        by = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
        rows = rows.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], f"query long, item {kind}")
        rows = rows.join(names, "query").select(F.col("item").alias("item_id"), "rank", "doc_id", "score")
        answers.append(stage(rows, "search-answers"))
    if not answers:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = answers[0]
    for a in answers[1:]:
        out = out.unionByName(a)
    return out


def rank_documents(spark: SparkSession, docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``build_index`` over ``docs`` (doc_id, text) and ``search`` for ``queries`` (item_id, text)."""
    return search(build_index(docs), queries, k)
