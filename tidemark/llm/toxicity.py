"""Toxicity by non-negative positive-unlabelled learning (operator 3).

A logistic model over the presence of words and character n-grams, trained in
numpy from confirmed toxic examples and unlabelled text. The risk of the
unlabelled part, corrected by the class prior, estimates the risk of clean text
and is kept from going below zero (the non-negative estimator), so no clean
label is needed.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import python_batches, stage
from tidemark.llm.lang_id import held_out

_WORD = re.compile(r"[^\W\d_]+")
#: Lengths of the character n-grams, word boundaries (blanks) counted.
NGRAMS = (4, 5, 6)


#: A feature is a word or n-gram at a level: it occurs, or at least so often and in this share of the words.
LEVELS = ((1, 0.0), (2, 0.006), (3, 0.01))


def plain_words(text: str) -> str:
    """The lower-cased words with one blank before, between and after."""
    return " " + " ".join(_WORD.findall(text.lower())) + " "


def _levels(count: int, words: int) -> range:
    return range(sum(count >= n and count >= share * words for n, share in LEVELS))


def distinct_features(text: str) -> set[str]:
    """``gram#level`` of whole words (with their blanks) and of n-grams within a word and its blanks."""
    words = Counter(plain_words(text).split())
    n_words, grams = sum(words.values()), Counter()
    for w, times in words.items():
        w = f" {w} "
        for g in {w, *(w[i:i + n] for n in NGRAMS for i in range(len(w) - n + 1))}:
            grams[g] += times
    return {f"{g}#{k}" for g, times in grams.items() for k in _levels(times, n_words)}


@dataclass
class ToxicityModel:
    features: list[str]
    weights: np.ndarray
    bias: float

    def automaton(self) -> ahocorasick.Automaton:
        """Finds the grams of the features in one pass over a text."""
        out, by_gram = ahocorasick.Automaton(), {}
        for i, f in enumerate(self.features):
            gram, level = f.split("#")
            by_gram.setdefault(gram, []).append((int(level), i))
        for gram, found in by_gram.items():
            out.add_word(gram, (gram, tuple(found)))
        if by_gram:
            out.make_automaton()
        return out

    def present(self, automaton: ahocorasick.Automaton, text: str) -> list[int]:
        """Numbers of the features that the text has."""
        if not self.features:
            return []
        plain, last, out = plain_words(text), {}, []
        grams: Counter = Counter()
        for end, hit in automaton.iter(plain):
            word = plain.rfind(" ", 0, end)          # where the word of the hit begins (or, with its blank, has begun)
            if last.get(hit) != word:                # once in a word
                last[hit] = word
                grams[hit] += 1
        n_words = len(plain.split())
        for (_, found), times in grams.items():
            reached = len(_levels(times, n_words))
            out += [i for level, i in found if level < reached]
        return sorted(out)

    def score(self, automaton: ahocorasick.Automaton, text: str) -> float:
        z = self.bias + float(self.weights[self.present(automaton, text)].sum())
        return 1.0 / (1.0 + np.exp(-min(max(z, -500.0), 500.0)))


def train_nnpu(xp: np.ndarray, xu: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05,
               l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of least non-negative PU risk under the logistic loss, by Adam.

    risk = prior E_p[l(g)] + max(0, E_u[l(-g)] - prior E_p[l(-g)]). Where the
    second part is below zero its gradient is taken the other way, which lets
    the model unlearn what it has fitted to the unlabelled sample.
    """
    d = xp.shape[1]
    w, b = np.zeros(d), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(d + 1), np.zeros(d + 1)

    def sig(z):
        return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))

    for t in range(1, steps + 1):
        gp, gu = xp @ w + b, xu @ w + b
        clean = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        # derivatives by g of the three means
        dp, dn_p, dn_u = -sig(-gp) / len(gp) * prior, -prior * sig(gp) / len(gp), sig(gu) / len(gu)
        if clean >= 0:
            cp, cu = dp + dn_p, dn_u
        else:
            cp, cu = -dn_p, -dn_u
        g = np.append(xp.T @ cp + xu.T @ cu + l2 * w, cp.sum() + cu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def fit_toxicity(docs: DataFrame, labels: DataFrame, learnable: Column | None = None,
                 n_positive: int = 1500, n_unlabelled: int = 4500, n_features: int = 1000,
                 min_docs: int = 5, z_least: float = 5.0) -> ToxicityModel | None:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); None without a toxic example.

    ``learnable`` (a condition on doc_id) says which rows may be learned from.
    The class prior is the toxic share of all learnable labels. The weights come
    from at most ``n_positive`` toxic documents and ``n_unlabelled`` documents
    of any kind, those of the smallest hash of the id. Features are the
    ``n_features`` words and n-grams whose share of documents differs most
    between the two samples (at least ``z_least`` standard errors).
    """
    ok = F.lit(True) if learnable is None else learnable
    known = labels.where(ok & F.col("toxic").isNotNull()).select("doc_id", "toxic")
    prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    pos_ids = {r[0] for r in known.where("toxic = 1").select("doc_id").distinct()
               .orderBy(*order).limit(n_positive).collect()}
    if not pos_ids:
        return None
    docs = docs.where(ok).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    unl_ids = {r[0] for r in docs.select("doc_id").orderBy(*order).limit(n_unlabelled).collect()}
    sample = docs.where(F.col("doc_id").isin(list(pos_ids | unl_ids)))
    sample = stage(sample.withColumns({"pos": F.col("doc_id").isin(list(pos_ids)),
                                       "unl": F.col("doc_id").isin(list(unl_ids))}).repartition(12, "doc_id"), "toxic")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p, u = Counter(), Counter()
            for text, a, b in zip(batch["text"], batch["pos"], batch["unl"]):
                found = distinct_features(text)
                if a:
                    p.update(found)
                if b:
                    u.update(found)
            keys = list(p.keys() | u.keys())
            yield pd.DataFrame({"feature": keys, "p": [p[k] for k in keys], "u": [u[k] for k in keys]})

    n, m = sample.agg(F.sum(F.col("pos").cast("long")), F.sum(F.col("unl").cast("long"))).first()
    if not n or not m:
        return None
    # share of documents in the two samples, apart by z standard errors
    both = (F.col("p") + F.col("u")) / F.lit(float(n + m))
    z = F.abs(F.col("p") / F.lit(float(n)) - F.col("u") / F.lit(float(m))) / F.sqrt(
        F.greatest(both * (1 - both), F.lit(1e-9)) * (1.0 / n + 1.0 / m))
    python_batches(docs.sparkSession, 200)
    features = [r[0] for r in (
        sample.select("text", "pos", "unl").mapInPandas(count, "feature string, p long, u long")
        .groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
        .where(F.col("p") + F.col("u") >= min_docs).withColumn("z", z).where(F.col("z") >= z_least)
        .orderBy(F.desc("z"), "feature").limit(n_features).select("feature").collect())]
    blank = ToxicityModel(features, np.zeros(len(features)), 0.0)

    def presence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = blank.automaton()
        for batch in batches:
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "pos": batch["pos"], "unl": batch["unl"],
                "at": [np.array(blank.present(found, t), dtype=np.int32).tobytes() for t in batch["text"]]})

    rows = sample.mapInPandas(presence, "doc_id long, pos boolean, unl boolean, at binary").collect()
    python_batches(docs.sparkSession)
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["at"])))

    def matrix(part: str) -> np.ndarray:
        chosen = [r for r in rows if r[part]]
        x = np.zeros((len(chosen), len(features)), dtype=np.float32)
        for i, r in enumerate(chosen):
            x[i, np.frombuffer(r["at"], dtype=np.int32)] = 1
        return x

    w, b = train_nnpu(matrix("pos"), matrix("unl"), min(max(prior, 1e-4), 0.9))
    return ToxicityModel(features, w, b)


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, threshold: float = 0.7,
                   text_col: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``threshold`` on); columns of those names are replaced.

    Scores every whole text; a null or empty text has the score of no words,
    and without a model every score is 0. Extra columns pass, repeated rows are
    scored each.
    """
    python_batches(docs.sparkSession)
    if model is None:
        return docs.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)})

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        found = model.automaton()
        for batch in texts:
            yield pd.Series([model.score(found, t) for t in batch.fillna("")], dtype="float64")

    return (docs.withColumn("score", score(F.col(text_col)))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def learnable_label(id_col: str = "doc_id") -> Column:
    """Rows whose crc32 of the id leaves 0 or 2 by three."""
    return ~held_out(id_col, 3, 1)
