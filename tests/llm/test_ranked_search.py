"""K2-treap and ranked search against plain lists, ties, long texts and odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import ranked_search as R
from tidemark.llm.k2_treap import K2Treap, best_first

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _brute(docs, items, k=10):
    of = [(i, TERM.findall(_lower(t or ""))) for i, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in of), sum(len(t) for _, t in of)
    df = Counter(w for _, t in of for w in set(t))
    out = []
    for item, text in items:
        words = set(TERM.findall(_lower(text or "")))
        scored = []
        for i, t in of:
            c, score = Counter(t), 0
            for w in words & c.keys():
                m = 100 - 90 + 90 * len(t) * n_docs // n_terms
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m))
            if score > 0:
                scored.append((-score, i is not None, i))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(scored[:k], 1)]
    return out


def _grid(rng, n_rows, n_cols, share):
    points = {(r, c): rng.randrange(1, 1_000_000) for r in range(n_rows) for c in range(n_cols) if rng.random() < share}
    for r in range(n_rows):
        points.setdefault((r, rng.randrange(n_cols)), 7)
    rows, cols = np.array(list(points)).T
    return points, K2Treap.build(rows, cols, np.array(list(points.values())), n_cols)


@pytest.mark.parametrize("n_rows,n_cols,share", [(1, 1, 1), (5, 2, 0.5), (300, 16, 0.2), (40, 100, 0.1), (1000, 33, 0.01)])
def test_postings_come_back(n_rows, n_cols, share):
    points, grid = _grid(random.Random(n_rows), n_rows, n_cols, share)
    again = K2Treap.from_bytes(grid.to_bytes())
    for r in range(n_rows):
        want = {c: v for (x, c), v in points.items() if x == r}
        assert grid.values(r) == want == again.values(r)


@pytest.mark.parametrize("seed", range(6))
def test_best_first_equals_all_scores(seed):
    rng = random.Random(seed)
    n_rows, n_cols, k = 200, rng.choice([3, 50, 129]), rng.choice([1, 3, 10])
    points, grid = _grid(rng, n_rows, n_cols, rng.choice([0.02, 0.3]))
    queries = [sorted(rng.sample(range(n_rows), rng.randrange(1, 12))) for _ in range(7)]
    query = np.repeat(np.arange(7), [len(q) for q in queries])
    row = np.array([r for q in queries for r in q])
    weight = np.array([rng.randrange(1, 9000) for _ in row])
    top = np.zeros((7, k), dtype=np.int64)
    got = list(zip(*best_first(grid, query, row, weight, top, first=1), strict=True))
    for q in range(7):
        scores = Counter()
        for r, w in zip(row[query == q], weight[query == q], strict=True):
            for c, v in grid.values(int(r)).items():
                scores[c] += int(w) * v
        best = sorted(scores.values(), reverse=True)[:k]
        assert top[q].tolist() == best + [0] * (k - len(best))
        assert {c: int(s) for x, c, s in got if x == q} == {c: s for c, s in scores.items() if s >= best[-1]}


def test_terms():
    assert R.terms_of("The\tKITE-kite's 9é漢字 _ İ\x00a\xa0b") == [
        x.encode() for x in ["the", "kite", "kite", "s", "9é漢字", "İ", "a\xa0b"]]
    rng = random.Random(1)
    for _ in range(500):
        t = "".join(rng.choice("aZ09 _-'\n\x00\x7f\x80éİß漢🙂") for _ in range(20))
        assert R.terms_of(t) == [w.encode() for w in TERM.findall(_lower(t))]


def _rows(rng, n):
    words = [f"w{i}" for i in range(60)]
    docs = [(rng.randrange(40), " ".join(rng.choice(words[:rng.randrange(2, 60)]) for _ in range(rng.randrange(30)))) for _ in range(n)]
    docs += [(None, "w1 w2 w3"), (7, None), (8, ""), (9, "..."), (5, "w1 " * 20_000 + "w2"), (3, "w4 w5"), (3, "w4 w5"), (2, "x" * 50_000)]
    docs += [(1000 + i, "copy w9 w10 w11") for i in range(60)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 20)))) for i in range(30)]
    items += [(77, None), (78, ""), (79, "unknown"), (3, "w9 w9 W10"), (None, "w1"), (3, "w9 w9 W10")]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_search_equals_brute_force(spark, small, monkeypatch):
    docs, items = _rows(random.Random(4), 300)
    if small:
        monkeypatch.setattr(R, "BLOCK_QUERIES", 7)
    frame = spark.createDataFrame([(i, t, "s", 1) for i, t in docs], "doc_id long, text string, score string, `rank` int").repartition(5)
    queries = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int")
    index = R.build_index(frame, shard_docs=16 if small else R.SHARD_DOCS, shard_bytes=400 if small else R.SHARD_BYTES)
    got = R.search(index, queries, 5)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(_brute(docs, items, 5), key=repr)


def test_every_document_with_a_term_is_in_the_index(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    index = R.build_index(docs, shard_docs=50)
    rows = docs.collect()
    assert index.corpus == R.Corpus(sum(bool(R.terms_of(r["text"])) for r in rows), sum(len(R.terms_of(r["text"])) for r in rows))
    ids = [i for r in index.shards.collect() for i in r["doc_ids"]]
    assert sorted(ids) == sorted(r["doc_id"] for r in rows if R.terms_of(r["text"]))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert R.rank_documents(spark, docs, items).count() == 0
    full = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    assert R.rank_documents(spark, full, items.limit(0)).count() == 0
    assert [tuple(r)[:3] for r in R.rank_documents(spark, full, items).collect()] == [(1, 1, 1)]
