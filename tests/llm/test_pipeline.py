"""The pipeline against its stages' rules on a small folder of tables."""

import random
import re

import corpus_pipeline as P
import pytest

from tidemark.llm.decontaminate import find_contamination

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _tables(spark, path):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    prose = lambda n: " ".join(word() for _ in range(n))
    item = prose(25)
    docs, labels, kind = [], [], {}
    for i in range(160):
        t = prose(30) + "\n" + prose(40)
        if i % 8 == 1:
            t = " ".join([t, "grumf snarlig", prose(5), "snarlig vexor grumf"])
            labels.append((i, 1))
            kind[i] = "toxic"
        else:
            labels.append((i, 0))
            kind[i] = "clean"
        if i % 20 == 4:
            t += "\n" + item.upper() + "\n" + prose(4)
            kind[i] = "leak"
        docs.append((i, t))
    for i in range(160, 175):           # near copies of document 0: a word of each line is another
        lines = [x.split() for x in docs[0][1].split("\n")]
        for x in lines:
            for _ in range(2):
                x[rng.randrange(len(x))] = word()
        docs.append((i, "\n".join(" ".join(x) for x in lines)))
        kind[i] = "near"
    common = "this very line stands in several documents of the corpus"
    for i in range(175, 185):
        docs.append((i, prose(25) + "\n" + common))
        kind[i] = "line"
    docs += [(200, None), (201, ""), (202, docs[0][1])]
    rows = [(i, t, "en" if i % 2 else None, "s", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return dict(docs), kind, common


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    texts, kind, common = _tables(spark, path)
    stages, docs = [], spark.read.parquet(f"{path}/documents.parquet")
    for k, (_, fn) in enumerate(P.STAGES):
        fn(spark, docs, path).write.parquet(f"{path}/stage{k}")
        docs = spark.read.parquet(f"{path}/stage{k}")
        stages.append(docs)
    return path, texts, kind, common, stages


def test_columns_and_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "encoding"]


def test_stages(spark, result):
    path, texts, kind, common, stages = result
    kept = [{r["doc_id"]: r["text"] for r in s.collect()} for s in stages]
    assert all(s.columns == COLUMNS for s in stages[:-1])
    assert set(texts) - set(kept[0]) == {i for i, k in kind.items() if k == "toxic"}
    # lines: the first occurrence stays
    assert common in kept[1][175] and all(common not in kept[1][i] for i in range(176, 185))
    assert 202 not in kept[1] and kept[1][200] is None and kept[1][201] == ""
    assert {r["doc_id"]: r["n_chars"] for r in stages[1].collect()}[176] == len(kept[1][176])
    clean = {i for i, k in kind.items() if k in ("clean", "line", "leak")}
    assert clean <= set(kept[1])
    # near duplicates: documents of equal sets of five-word shingles or near ones, brute force
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    sets = {i: shingles(t) for i, t in kept[1].items()}
    gone = {j for j in sets for i in sets if i < j and sets[i] and sets[j]
            and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    assert set(kept[1]) - set(kept[2]) == gone
    bad = {r["doc_id"] for r in find_contamination(stages[2], spark.read.parquet(f"{path}/benchmark.parquet")).collect()}
    leaks = {i for i, k in kind.items() if k == "leak" and i in kept[2]}
    # the passage is a line of its own: line dedup leaves its first occurrence only
    assert bad == {min(leaks)} and set(kept[2]) - set(kept[3]) == bad
    last = stages[4].collect()
    assert {r["doc_id"] for r in last} == set(kept[3]) and all(r["decodes"] for r in last)
    assert all(r["n_pieces"] == len(r["ids"]) for r in last)


def test_run_equals_the_stages_and_takes_no_documents(spark, result, tmp_path):
    path, _, _, _, stages = result
    got = P.run(spark, path)
    assert got.count() == stages[-1].count() and got.exceptAll(stages[-1]).count() == 0


def _small(spark, path, docs, labels, schema="doc_id long, text string, lang string, source string, n_chars long, score string, `Kept` int"):
    spark.createDataFrame(docs, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, "an item of nine words that no document here holds")], "item_id long, text string").write.parquet(
        f"{path}/benchmark.parquet")


def test_empty_tables(spark, tmp_path):
    _small(spark, str(tmp_path), [], [])
    out = P.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns == [*COLUMNS, "ids", "n_pieces", "decodes"]


def test_repeated_rows_nulls_and_clashing_names(spark, tmp_path):
    """Repeated rows are copies of one document: their lines stand in the first one only; other columns do not pass."""
    rows = [(1, "one clean line of its own\nand a second one", "en", "s", 5, "x", 7)] * 2
    rows += [(2, None, None, None, None, None, None), (None, "a text without an id, all alone", "en", "s", 1, "x", 7), (3, "", "en", "s", 0, "x", 7)]
    _small(spark, str(tmp_path), rows, [(1, 1, 0), (1, 1, None), (9, 0, 1)])
    out = P.run(spark, str(tmp_path))
    assert out.columns == [*COLUMNS, "ids", "n_pieces", "decodes"]
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in out.select("doc_id", "text").collect())
    assert (False, 1, rows[0][1]) in got and (True, 0, rows[3][1]) in got and (False, 2, None) in got and (False, 3, "") in got
    assert all(r["decodes"] for r in out.collect())
