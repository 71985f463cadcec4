"""Spark ML training, evaluation and prediction.

The reference trained on one series with an unpartitioned window, pulled
predictions to the driver for metrics, and re-read its three splits three
times. Here: per-symbol targets, a distributed global split (checkpointed),
metrics as one aggregate, prediction for every symbol in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import GBT_PARAMS


def simulated_sentiment(df: DataFrame, out: str = "avg_sentiment", seed: int = 42,
                        key: Sequence[str] | None = None) -> DataFrame:
    """C17: uniform stand-in feature in [-1, 1). With ``key`` it is a hash of
    the key columns (stable across recomputation, D13); else seeded ``rand``."""
    if key:
        h = F.xxhash64(*[F.col(k) for k in key], F.lit(seed))
        u = (F.pmod(h, F.lit(1 << 30)).cast("double") / float(1 << 30))
    else:
        u = F.rand(seed)
    return df.withColumn(out, u * 2.0 - 1.0)


def gbt_estimator(features: Sequence[str], label: str = "target_price", params: dict | None = None,
                 scaled: bool = True) -> Pipeline:
    """M1-M4: VectorAssembler -> MinMaxScaler -> GBTRegressor."""
    p = dict(GBT_PARAMS)
    p.update(params or {})
    stages = [VectorAssembler(inputCols=list(features), outputCol="features")]
    feats = "features"
    if scaled:
        stages.append(MinMaxScaler(inputCol="features", outputCol="scaled_features"))
        feats = "scaled_features"
    stages.append(GBTRegressor(featuresCol=feats, labelCol=label, **p))
    return Pipeline(stages=stages)


def fit_and_predict(frame: DataFrame, features: Sequence[str], label: str = "target_price",
                    split: str = "split", params: dict | None = None):
    """Fit on ``split == 'train'``, predict every row. Returns (model, predictions)."""
    model = gbt_estimator(features, label, params).fit(frame.where(F.col(split) == "train"))
    pred = model.transform(frame).drop("features", "scaled_features")
    return model, pred


def fit_with_validation(frame: DataFrame, features: Sequence[str], label: str = "target_price", split: str = "split",
                        params: dict | None = None, tolerance: float = 0.01, checkpoint_every: int = 10):
    """M3 with a stop: trees are added until the error on ``split == 'val'`` falls by less than ``tolerance`` of itself.

    The scaling is fitted on the training rows alone. Every ``checkpoint_every`` trees Spark ML writes its
    working rows to the shared checkpoint folder, which cuts their lineage. Returns (pipeline model,
    number of trees, errors): errors is a table (iteration, split, mse) of the ensemble after each tree.
    """
    from pyspark.ml.regression import GBTRegressionModel

    from tidemark.session import ensure_checkpoint_dir
    spark = frame.sparkSession
    ensure_checkpoint_dir(spark)
    rows = frame.where(F.col(split).isin("train", "val"))
    prepare = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"),
                               MinMaxScaler(inputCol="features", outputCol="scaled_features")])
    prepared = prepare.fit(rows.where(F.col(split) == "train"))
    ready = prepared.transform(rows).withColumn("_tm_val", F.col(split) == "val")
    p = {**GBT_PARAMS, **(params or {})}
    ready = ready.select("scaled_features", label, "_tm_val", F.col(split).alias("_tm_split"))
    trees: GBTRegressionModel = GBTRegressor(featuresCol="scaled_features", labelCol=label, validationIndicatorCol="_tm_val",
                                             validationTol=tolerance, checkpointInterval=checkpoint_every, cacheNodeIds=True, **p).fit(ready)
    errors = []
    for part in ("train", "val"):
        mse = trees.evaluateEachIteration(ready.where(F.col("_tm_split") == part), "squared")
        errors += [(i, part, float(e)) for i, e in enumerate(mse, 1)]
    model = PipelineModel(stages=[*prepared.stages, trees])
    return model, trees.getNumTrees, spark.createDataFrame(errors, "iteration long, split string, mse double")


def stored_errors(spark, path: str, label: str = "target_price", by: str = "split") -> DataFrame:
    """M5 from stored predictions: MSE, MAE, MAPE by split."""
    from tidemark.operators.metrics import regression_metrics
    return regression_metrics(spark.read.parquet(path), label, "prediction", by=[by])


def save_model(model: PipelineModel, path: str) -> str:
    """The fitted pipeline (scaler included) to a directory."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """Load; a missing directory raises (as the reference's loader does)."""
    return PipelineModel.load(path)


def predict_latest(model: PipelineModel, frame: DataFrame, keys=("symbol",),
                   order: str = "date") -> DataFrame:
    """M6: prediction from the newest row of every key, all keys in one job.

    ``max_by`` per key is a partial aggregate: a hot key costs one row per
    map task, never a sort of its whole history.
    """
    keys = list(keys)
    others = [c for c in frame.columns if c not in keys]
    newest = (frame.groupBy(*keys)
                   .agg(F.max_by(F.struct(*others), F.col(order)).alias("_tm_row"))
                   .select(*keys, "_tm_row.*"))
    return model.transform(newest).drop("features", "scaled_features")


def add_split_features(frame: DataFrame, label_source: str = "open", order=("date", "symbol"),
                       keys=("symbol",), bucket: Column | None = None) -> DataFrame:
    """P3 preparation: next-row target per key (W3), rows with NULLs dropped
    (F7), global row number and 70/15/15 split (W5/W6)."""
    from tidemark.operators.series import next_value
    from tidemark.operators.splits import temporal_split
    t = next_value(frame, label_source, "target_price", list(keys), ["date"], bucket)
    t = t.na.drop()
    return temporal_split(t, list(order))


def sequence_dataset(frame: DataFrame, length: int, features: Sequence[str], target: str,
                     path: str, keys=("symbol",), split: str = "split", order=("date",),
                     bucket: Column | None = None) -> DataFrame:
    """M7: features and target scaled to [-1, 1] with the *train* fit, cut into
    sliding sequences inside every (split, key), written to ``path`` as the
    distributed hand-off to any trainer, and read back."""
    from tidemark.operators.scaling import minmax_fit, minmax_scale
    from tidemark.operators.series import sequence_windows
    cols = list(features) + [target]
    fit = minmax_fit(frame.where(F.col(split) == "train"), cols).first().asDict()
    scaled = minmax_scale(frame, fit, cols)
    seq = sequence_windows(scaled, length, features, target, [split, *keys], list(order),
                           bucket=bucket)
    seq.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.parquet(path)
