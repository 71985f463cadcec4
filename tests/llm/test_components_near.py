"""Components, MinHash near-dedup (7) and the vector join (6) against brute force."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.shingles import shingle_sets
from tidemark.llm.vector_dedup import link_vectors


def _union(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(i, i + 1) for i in range(300, 340)] + [(5, 5)]
    df = spark.createDataFrame(links + [(None, 3)], "a long, b long").withColumn("u", F.lit(1))
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    real = [x for x in links if x[0] != x[1]]
    nodes = {n for x in real for n in x}
    assert got == _union(nodes, real)
    assert connected_components(df.limit(0)).collect() == []


def _shingles(t):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def _near_rows():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(4))
    rows, i = [], 0
    for _ in range(25):
        base = [word() for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 12)):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = word()
            rows.append((i, rng.choice([" ", "\n", "\t  "]).join(w).upper() if i % 3 else " ".join(w)))
            i += 1
    chain = [word() for _ in range(60)]        # each near the next only
    for _ in range(8):
        chain = chain[3:] + [word() for _ in range(3)]
        rows.append((i, " ".join(chain)))
        i += 1
    return rows + [(i, None), (i + 1, ""), (i + 2, " \n "), (i + 3, "one two"), (i + 4, "ONE  two"), (i + 5, "two one"),
                   (i + 6, "w " * 4000)]


def test_near_duplicates_against_brute_force(spark):
    rows = _near_rows()
    rows += [rows[0], rows[3]]          # repeated rows
    sets = {d: _shingles(t) for d, t in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = _union(ids, links)
    df = spark.createDataFrame(rows + [(None, rows[0][1])], "doc_id long, text string").withColumns(
        {"kept": F.lit("clash"), "Component_id": F.lit(1)})
    out = near_duplicates(df, block=7).collect()
    assert len(out) == len(rows) + 1
    for r in out:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]])
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_documents_of_several_texts(spark):
    """Rows of one doc_id are one document, linked with what any of its texts links with."""
    rng = random.Random(3)
    rows = [(rng.randrange(60), t) for _, t in _near_rows()]
    word = lambda: "".join(rng.choice("abcdef") for _ in range(5))
    a, b = [word() for _ in range(80)], [word() for _ in range(90)]

    def near(t):
        t = list(t)
        t[rng.randrange(len(t))] = word()
        return " ".join(t)
    rows += [(101, " ".join(a)), (101, " ".join(b)), (102, near(a)), (103, near(b)), (104, near(a)), (105, near(b)), (105, None), (106, near(b))]
    sets = [(d, _shingles(t)) for d, t in rows]
    links = [(x, y) for i, (x, s) in enumerate(sets) for y, t in sets[i + 1:] if s and t and 100 * len(s & t) >= 75 * len(s | t)]
    want = _union({d for d, _ in rows}, links)
    assert want[103] == want[105] == want[102] == 101
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=5).collect()
    assert sorted((r["doc_id"], r["n_shingles"]) for r in out) == sorted((d, len(s)) for d, s in sets)
    assert all(r["component_id"] == want[r["doc_id"]] and r["kept"] == (want[r["doc_id"]] == r["doc_id"]) for r in out)


def test_blocks_are_bounded_by_weight(spark):
    from tidemark.llm.common import in_blocks
    df = spark.range(400).selectExpr("id", "id % 2 AS key", "id AS n")
    out = in_blocks(df, ["key"], 1000, "id", "n", 5000).collect()
    of = {}
    for r in out:
        of.setdefault((r["key"], r["_b"]), set()).add((r["id"], r["n"]))
    assert max(sum(n for _, n in rows) for rows in of.values()) < 12_000 and len(of) > 10
    met = {}
    for r in out:
        met.setdefault((r["key"], r["_bi"], r["_bj"]), []).append((r["id"], r["_b"]))
    pairs = [frozenset((x, y)) for (_, i, j), rows in met.items() for x, bx in rows for y, by in rows
             if x < y and ((i == j) or bx != by)]
    assert len(pairs) == len(set(pairs)) == 2 * (200 * 199 // 2)


def test_near_duplicates_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_shingle_sets_match_words():
    texts = ["a b c d e f", "A b\tc\nd  e F", "x", "", "a b c d e a b c d e a b c d e"] + ["q r s t u v w"] * 2
    got = list(shingle_sets([t.encode() for t in texts], piece=30))
    assert [len(s) for s in got] == [len(_shingles(t)) for t in texts]
    assert (got[0] == got[1]).all() and (got[5] == got[6]).all()


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows, i = [], 0
    for label in (0, 1, 2, None):
        for _ in range(12):
            base = rng.normal(size=16)
            for _ in range(int(rng.integers(1, 25))):
                v = base + rng.normal(size=16) * rng.choice([0, 0.02, 0.1, 0.2])
                rows.append((i, [float(np.float32(x)) for x in v * rng.uniform(0.1, 50)], label))
                i += 1
    same = rows[0][1]
    rows += [(i + k, same, 0) for k in range(5)]
    i += 5
    bad = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    rows += [(i + k, v, 0) for k, v in enumerate(bad)] + [(i + 6, [1.0, 2.0], 0), (i + 7, [2.0, 4.0], 0)]
    fit = [(d, np.array(v), lab) for d, v, lab in rows if lab is not None and v and None not in v
           and np.isfinite(v).all() and any(v)]
    links = []
    for k, (a, x, l1) in enumerate(fit):
        for b, y, l2 in fit[k + 1:]:
            if l1 == l2 and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                links.append((a, b))
    ids = [r[0] for r in rows]
    comp, n = _union(ids, links), {d: 0 for d in ids}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<double>, label int, n_links double")
    for kw in ({}, {"block_rows": 9, "cell": 0.1}, {"blocks": 4, "grid_dims": 3}):
        out = link_vectors(df, **kw).collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out} == {d: (n[d], comp[d]) for d in ids}
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out) and len(out) == len(rows)
    assert link_vectors(df.limit(0)).collect() == []


def test_vectors_in_rounds(spark, monkeypatch):
    """Single precision, many vectors of a label, cells by parts: the same as in one round, and no copies are staged."""
    import tidemark.llm.vector_dedup as V
    rng = np.random.default_rng(7)
    base = rng.normal(size=(40, 24))
    v = (base[rng.integers(0, 40, 400)] + rng.normal(size=(400, 24)) * rng.choice([0.02, 0.1, 0.2], size=(400, 1))).astype(np.float32)
    v[50:60] = v[40]
    x = v.astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = [int(k) for k in rng.integers(0, 2, 400)]
    links = [(a, b) for a in range(400) for b in range(a + 1, 400) if label[a] == label[b] and x[a] @ x[b] >= 0.98]
    comp = _union(list(range(400)), links)
    n = np.bincount(np.array(links).ravel(), minlength=400)
    df = spark.createDataFrame([(k, [float(f) for f in v[k]], label[k]) for k in range(400)], "vec_id long, embedding array<float>, label int")
    staged, stage = [], V.stage
    monkeypatch.setattr(V, "stage", lambda d, name: staged.append((name, d.columns)) or stage(d, name))
    monkeypatch.setattr(V, "WIDE", 1, raising=False)
    for kw in ({"block_rows": 20, "round_rows": 30}, {"block_rows": 7, "round_rows": 200, "blocks": 3}):
        out = link_vectors(df, **kw).collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out} == {k: (n[k], comp[k]) for k in range(400)}
    assert len(links) > 500 and sum(name == "vec-links" for name, _ in staged) == 16 + 3      # 400 vectors by 30: 8 blocks in 2 parts
    assert not any("x" in columns for _, columns in staged)


def test_near_points_meet_in_one_cell():
    from tidemark.llm.vector_dedup import _cells
    rng = np.random.default_rng(2)
    g = np.concatenate([rng.normal(size=(150, 4)) * 0.1, [[0.25, 0, -0.25, 0.5], [0.25, 0, -0.25, 0.5]]])
    row, key, home = _cells(g, 0.25, 0.07, 3)
    assert sorted(row[home]) == list(range(len(g)))
    for i in range(len(g)):
        for j in range(i):
            met = sum(len(set(key[(row == a) & home]) & set(key[row == b])) for a, b in ((i, j), (j, i)))
            same = set(key[(row == i) & home]) == set(key[(row == j) & home])
            if ((g[i] - g[j]) ** 2).sum() <= 0.07 ** 2:
                assert met == (2 if same else 1)
