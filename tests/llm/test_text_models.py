"""Toxicity (3) and language identification (10): held-out accuracy and edge cases."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import lang_id as L
from tidemark.llm import toxicity as X

SYLLABLES = {"aa": "ba be bo ka ke ko".split(), "bb": "strü gnö ßen tzen lich ung".split(),
             "cc": "ción lla mente ñar ado ría".split()}


def _prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def _documents(n=360):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        rows.append((i, _prose(rng, lang, rng.randint(5, 80)), lang))
    return rows


def test_language_held_out_accuracy_and_edges(spark):
    rows = _documents()
    docs = spark.createDataFrame(rows + [(9000, None, "aa"), (9001, "", "bb"), (9002, "12 34 ...", "cc"), (9003, "keko", None)],
                                 "doc_id long, text string, lang string")
    model = L.fit_language_model(docs.where(~L.held_out("doc_id", 5, 0)), per_lang=60)
    assert model.langs == ["aa", "bb", "cc"] and 0 < model.temperature < 30
    out = L.identify_language(docs.withColumns({"Score": F.lit("clash"), "extra": F.lit(1)}), model)
    got = {r["doc_id"]: r for r in out.collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    kept_back = {r["doc_id"] for r in docs.where(L.held_out("doc_id", 5, 0)).select("doc_id").collect()}
    assert len(held) > 40 and {r[0] for r in held} == {i for i in kept_back if i < 9000}
    right = np.mean([got[i]["lang_pred"] == lang for i, _, lang in held])
    assert right > 0.98 and len(got) == len(rows) + 4
    for i in (9000, 9001, 9002):
        assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
    assert got[9003]["lang_pred"] == "aa" and 0 <= got[9003]["score"] <= 1


def test_language_of_long_repeated_and_tied_texts(spark):
    """Very long texts are read whole, repeated rows are answered each, a text of two languages has one answer that stays."""
    rows = _documents(200)
    docs = spark.createDataFrame(rows + rows[:20], "doc_id long, text string, lang string")
    model = L.fit_language_model(docs, per_lang=60)
    rng = random.Random(9)
    # the first tenth is of one language, the rest of another
    long = _prose(rng, "aa", 2_000) + " " + _prose(rng, "bb", 18_000)
    half = _prose(rng, "bb", 300) + " " + _prose(rng, "cc", 300)
    asked = spark.createDataFrame([(1, long), (2, half), (2, half), (3, half)], "doc_id long, text string")
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in L.identify_language(asked, model).collect()]
    assert [x[1] for x in got if x[0] == 1] == ["bb"]
    assert len(got) == 4 and len({x[1:] for x in got if x[0] != 1}) == 1 and got[1][1] in ("bb", "cc")


def test_language_without_labels_or_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert L.fit_language_model(empty) is None
    assert L.identify_language(empty, None).collect() == []
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert L.fit_language_model(docs) is None
    assert L.identify_language(docs, None).select("lang_pred", "score").first() == ("und", 0.0)


def test_ftrl_weights_are_sparse_and_separate():
    rng = np.random.default_rng(1)
    rows, y = [], []
    for _ in range(200):
        c = rng.integers(0, 2)
        idx = np.unique(np.concatenate([[c], rng.integers(2, 500, 10)]))
        rows.append((idx, np.full(len(idx), 1 / np.sqrt(len(idx)))))
        y.append(c)
    w = L.train_ftrl(rows, np.array(y), 2, 500, l1=0.3)
    assert (w[2:-1] == 0).mean() > 0.5 and w[0, 0] > w[0, 1] and w[1, 1] > w[1, 0]


def test_temperature_is_one_for_calibrated_logits():
    rng = np.random.default_rng(2)
    z = rng.normal(size=(20000, 3)) * 2
    p = L.softmax(z)
    y = (p.cumsum(axis=1) > rng.random((len(z), 1))).argmax(axis=1)
    assert abs(L.fit_temperature(z, y) - 1) < 0.1 and abs(L.fit_temperature(3 * z, y) - 3) < 0.3


def _toxic_rows(n=600):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        words = _prose(rng, "aa", rng.randint(20, 120)).split()
        toxic = int(rng.random() < 0.15)
        if toxic:
            for _ in range(max(2, len(words) // 20)):
                words.insert(rng.randrange(len(words)), rng.choice(["grumf", "Snarlig", "snarlo"]))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return rows, labels


def test_toxicity_held_out_accuracy_and_edges(spark):
    rows, labels = _toxic_rows()
    docs = spark.createDataFrame(rows + [(7000, None), (7001, ""), (7001, "")], "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(0, None), (None, 1)], "doc_id long, toxic int")
    model = X.fit_toxicity(docs, lab, X.learnable_label(), n_positive=200, n_unlabelled=300)
    out = X.score_toxicity(docs.withColumn("PREDICTED", F.lit("x")), model)
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in out.collect()}
    truth = dict(labels)
    held = [r["doc_id"] for r in docs.where(~X.learnable_label()).collect() if r["doc_id"] in truth]
    hit = [got[i][1] == truth[i] for i in held]
    assert np.mean(hit) > 0.97
    assert all(0 <= s <= 1 and p == int(s >= 0.7) for s, p in got.values())
    assert got[7000] == got[7001] and got[7000][1] == 0 and out.count() == len(rows) + 3


def test_toxicity_without_examples(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert X.fit_toxicity(docs, none) is None
    assert X.score_toxicity(docs, None).select("score", "predicted").first() == (0.0, 0)
    assert X.score_toxicity(docs.limit(0), None).count() == 0


def test_non_negative_risk_separates_from_unlabelled():
    rng = np.random.default_rng(3)
    xp = (rng.random((300, 6)) < [.9, .1, .1, .1, .1, .1]).astype(float)
    n = 200
    xu = np.vstack([(rng.random((n, 6)) < [.9, .1, .1, .1, .1, .1]), rng.random((1800, 6)) < [.02, .1, .1, .1, .1, .1]]).astype(float)
    w, b = X.train_nnpu(xp, xu, 0.1)
    assert w[0] > 2 and b < 0 and w[0] + b > 0


def test_present_features_equal_distinct_features():
    texts = ["idiot idiot idiotic x", "", "a b", "Ünder über under"]
    feats = sorted(set().union(*map(X.distinct_features, texts)))
    m = X.ToxicityModel(feats, np.zeros(len(feats)), 0.0)
    a = m.automaton()
    for t in texts:
        assert {feats[i] for i in m.present(a, t)} == X.distinct_features(t)
