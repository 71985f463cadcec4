"""Prediction from the newest sequence of every key (M6 on W9).

A saved artefact holds all that a prediction needs: the features in order, the
sequence length, the train-fitted scaling with its inverse for the target, and the
model. All keys are predicted in one job: their newest rows are brought together
(``latest_sequence``: at most the sequence length of rows per key and task are shuffled), checked,
and predicted in batches by a model that each Python worker builds once.
"""

from __future__ import annotations

import hashlib
import importlib
import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Why a key has, or has no prediction.
OK, UNKNOWN, TOO_SHORT, INCOMPLETE = "ok", "unknown", "too_short", "incomplete"


class LinearSequenceModel:
    """The sum of ``weights`` (rows x features) times the scaled sequence, plus ``bias``."""

    def __init__(self, weights: list[list[float]], bias: float = 0.0):
        self.weights, self.bias = np.array(weights, dtype=np.float64), float(bias)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Scaled targets of scaled sequences (n x rows x features)."""
        return (x * self.weights).sum(axis=(1, 2)) + self.bias


@dataclass
class SequenceArtefact:
    """``fit``: min_<column> and max_<column> of the features and the target on the training rows; ``model``: the import
    path of a class with ``predict`` and the settings that it is made with (JSON values)."""

    features: list[str]
    target: str
    length: int
    fit: dict[str, float]
    model: str
    settings: dict
    lo: float = -1.0
    hi: float = 1.0

    def save(self, spark: SparkSession, path: str) -> None:
        """One JSON text at ``path`` (a folder, replaced)."""
        spark.createDataFrame([(json.dumps(asdict(self)),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SequenceArtefact:
        """A missing folder raises."""
        return cls(**json.loads(spark.read.text(path, wholetext=True).where("length(value) > 0").first()[0]))

    def build(self):
        module, name = self.model.rsplit(".", 1)
        return getattr(importlib.import_module(module), name)(**self.settings)

    def key(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """Features (last axis) to the fitted range; a constant one is its lower end."""
        low, high = (np.array([self.fit[f"{m}_{c}"] for c in self.features]) for m in ("min", "max"))
        wide = np.where(high > low, high - low, 1.0)
        return np.where(high > low, (x - low) / wide * (self.hi - self.lo) + self.lo, self.lo)

    def unscaled(self, y: np.ndarray) -> np.ndarray:
        """Predicted targets in their own unit."""
        low, high = self.fit[f"min_{self.target}"], self.fit[f"max_{self.target}"]
        return (y - self.lo) / (self.hi - self.lo) * (high - low) + low


_BUILT: dict[str, object] = {}


def built(artefact: SequenceArtefact):
    """The worker's model of an artefact; it outlives a task."""
    key = artefact.key()
    if key not in _BUILT:
        _BUILT[key] = artefact.build()
    return _BUILT[key]


def fit_artefact(train: DataFrame, features: Sequence[str], target: str, length: int, model: str, settings: dict) -> SequenceArtefact:
    """An artefact whose scaling is fitted on ``train`` (one aggregate row)."""
    from tidemark.operators.scaling import minmax_fit
    fit = minmax_fit(train, [*dict.fromkeys([*features, target])]).first().asDict()
    return SequenceArtefact(list(features), target, length, {k: float(v) for k, v in fit.items()}, model, settings)


def predict_sequences(frame: DataFrame, artefact: SequenceArtefact, wanted: DataFrame | None = None,
                      key: str = "symbol", order: Sequence[str] = ("date",), date: str = "date") -> DataFrame:
    """key, last_date, n_rows, status, prediction: the next target of every key of ``frame``, or of every one of ``wanted``.

    Status ``unknown``: the key has no row; ``too_short``: fewer rows than the sequence length;
    ``incomplete``: a feature of the sequence is null; these have no prediction. Keys of
    ``wanted`` count once, null ones are left out.
    """
    from tidemark.operators.series import latest_sequence
    values = F.flatten(F.transform("x", lambda r: F.array(*[r[c].cast("double") for c in artefact.features])))
    newest = latest_sequence(frame.where(F.col(key).isNotNull()), artefact.length, artefact.features, (key,), order, date)
    newest = newest.select(key, "last_date", "n_rows", values.alias("values"))
    if wanted is not None:
        newest = wanted.select(key).where(F.col(key).isNotNull()).distinct().join(newest, key, "left")
    status = (F.when(F.col("n_rows").isNull(), F.lit(UNKNOWN)).when(F.col("n_rows") < artefact.length, F.lit(TOO_SHORT))
              .when(F.exists("values", lambda v: v.isNull() | F.isnan(v)), F.lit(INCOMPLETE)).otherwise(F.lit(OK)))
    newest = newest.select(key, "last_date", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), status.alias("status"), "values")
    schema = T.StructType([f for f in newest.schema.fields if f.name != "values"] + [T.StructField("prediction", T.DoubleType())])

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from tidemark.operators.sequence_model import built as worker_copy
        for pdf in batches:
            good = (pdf["status"] == OK).to_numpy()
            out = np.full(len(pdf), np.nan)
            if good.any():
                x = np.stack(pdf.loc[good, "values"]).astype(np.float64).reshape(-1, artefact.length, len(artefact.features))
                out[good] = artefact.unscaled(np.asarray(worker_copy(artefact).predict(artefact.scaled(x)), dtype=np.float64))
            pdf = pdf.drop(columns="values")
            pdf["prediction"] = pd.Series([float(v) if g else None for v, g in zip(out, good, strict=True)], dtype=object, index=pdf.index)
            yield pdf
    return newest.mapInPandas(predict, schema)
