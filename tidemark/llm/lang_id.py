"""Language identification (operator 10).

Sparse multinomial logistic regression on TF-IDF character n-grams: hashed
1- to 3-grams, document frequencies over all training documents, weights by
follow-the-regularised-leader (per coordinate, with L1 and L2 penalties) on a
bounded sample, then one temperature fitted on a held-back part of the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import python_batches

#: log2 of the number of n-gram buckets.
BUCKET_BITS = 14


def held_out(id_col: str, mod: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves ``rest``; rows without an id are held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % mod == rest, F.lit(True))


def ngram_counts(text: str, bits: int = BUCKET_BITS) -> np.ndarray:
    """Counts of the lower-cased text's character 1-, 2- and 3-grams by hash bucket."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    shift = np.uint32(32 - bits)
    a = c * np.uint32(0x9E3779B1)
    grams = [a]
    if len(c) > 1:
        b = (a[:-1] ^ (a[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + a[1:]
        grams.append(b * np.uint32(0xC2B2AE35))
        if len(c) > 2:
            t = (grams[1][:-1] ^ (grams[1][:-1] >> np.uint32(13))) * np.uint32(0x27D4EB2F) + a[2:]
            grams.append(t * np.uint32(0x165667B1))
    return np.bincount(np.concatenate(grams) >> shift, minlength=1 << bits)


@dataclass
class LanguageModel:
    langs: list[str]
    idf: np.ndarray            # by bucket
    weights: np.ndarray        # bucket (and bias) x language
    temperature: float

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        """Of each row of n-gram counts."""
        x = np.log1p(counts) * self.idf
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        return softmax((x @ self.weights[:-1] + self.weights[-1]) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_classes: int, dim: int,
               alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02,
               epochs: int = 4, seed: int = 7) -> np.ndarray:
    """FTRL-proximal for softmax regression; ``rows`` are (indices, values). The last row is the bias."""
    z, n = np.zeros((dim + 1, n_classes)), np.zeros((dim + 1, n_classes))

    def weights(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(ni)) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            idx, val = rows[i]
            idx, val = np.append(idx, dim), np.append(val, 1.0)
            zi, ni = z[idx], n[idx]
            w = weights(zi, ni)
            p = softmax(val @ w)
            p[y[i]] -= 1.0
            g = val[:, None] * p[None, :]
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[idx] = zi + g - sigma * w
            n[idx] = ni + g * g
    return weights(z, n)


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, by golden-section search on its log."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)).mean()

    lo, hi, r = -3.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def fit_language_model(train: DataFrame, per_lang: int = 400, max_langs: int = 1000,
                       bits: int = BUCKET_BITS) -> LanguageModel | None:
    """Learn from ``train`` (doc_id, text, lang); None if it has no labelled text.

    Document frequencies count every row. The weights come from at most
    ``per_lang`` rows of each language, those of the smallest hash of the id;
    every fifth of them only fits the temperature.
    """
    spark = train.sparkSession
    ids = train.where("lang is not null")
    train = ids.where("text is not null")
    picked = [r[0] for r in ids.select(
        "doc_id", F.row_number().over(
            _by_hash("lang")).alias("k")).where(F.col("k") <= per_lang).limit(per_lang * max_langs + 1)
        .select("doc_id").collect()]
    if not picked:
        return None
    if len(picked) > per_lang * max_langs:
        raise ValueError(f"more than {max_langs} languages")

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(1 << bits, dtype=np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                total += ngram_counts(text, bits) > 0
                n += 1
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": np.append(at, -1), "n": np.append(total[at], n)})

    # one row per bucket: its number does not depend on the corpus
    counted = (train.select("text").mapInPandas(frequencies, "bucket long, n long")
               .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    df, n_docs = np.zeros(1 << bits), 0
    for bucket, n in counted:
        if bucket < 0:
            n_docs = n
        else:
            df[bucket] = n
    idf = np.log((1 + n_docs) / (1 + df)) + 1

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for d, text, lang in zip(batch["doc_id"], batch["text"], batch["lang"]):
                c = ngram_counts(text, bits)
                at = np.flatnonzero(c)
                out.append((d, lang, at.astype(np.uint16 if bits <= 16 else np.uint32).tobytes(),
                            c[at].astype(np.uint32).tobytes()))
            yield pd.DataFrame(out, columns=["doc_id", "lang", "at", "n"])

    sample = (train.where(F.col("doc_id").isin(picked)).select("doc_id", "text", "lang")
              .mapInPandas(features, "doc_id long, lang string, at binary, n binary").collect())
    sample.sort(key=lambda r: (r["doc_id"], r["lang"], bytes(r["at"])))
    langs = sorted({r["lang"] for r in sample})
    rows, y = [], np.array([langs.index(r["lang"]) for r in sample])
    for r in sample:
        at = np.frombuffer(r["at"], dtype=np.uint16 if bits <= 16 else np.uint32).astype(np.int64)
        val = np.log1p(np.frombuffer(r["n"], dtype=np.uint32)) * idf[at]
        rows.append((at, val / max(np.linalg.norm(val), 1e-12)))
    back = np.arange(len(rows)) % 5 == 4
    if len(rows) < 20:
        back[:] = False
    keep = np.flatnonzero(~back)
    w = train_ftrl([rows[i] for i in keep], y[keep], len(langs), 1 << bits)
    logits = np.array([v @ w[i] + w[-1] for i, v in (rows[k] for k in np.flatnonzero(back))])
    return LanguageModel(langs, idf, w, fit_temperature(logits, y[back]))


def _by_hash(group: str):
    from pyspark.sql import Window
    return Window.partitionBy(group).orderBy(F.xxhash64("doc_id"), "doc_id")


def identify_language(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (columns of those names are replaced).

    Scores every whole text. A null text, or one without a letter, is ``und``
    with score 0; so is every row if there is no model. Extra columns pass.
    """
    spark = docs.sparkSession
    python_batches(spark)
    letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})

    @F.pandas_udf("struct<lang: string, score: double>")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bits = int(np.log2(len(model.idf)))
        for batch in texts:
            lang, score = [], []
            values = batch.fillna("").tolist()
            for k in range(0, len(values), 128):
                p = model.probabilities(np.stack([ngram_counts(t, bits) for t in values[k:k + 128]]))
                best = p.argmax(axis=1)
                lang += [model.langs[i] for i in best]
                score += p[np.arange(len(best)), best].tolist()
            yield pd.DataFrame({"lang": lang, "score": score})

    said = docs.withColumn("_said", predict(F.col(text_col)))
    return said.withColumns({
        "lang_pred": F.when(letter, F.col("_said.lang")).otherwise("und"),
        "score": F.when(letter, F.col("_said.score")).otherwise(0.0)}).drop("_said")
