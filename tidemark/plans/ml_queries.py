"""ML, scoring-model and sink queries of the registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.plans.queries import BAR_FEATURES, _mapped_daily, _bucket, query
from tidemark.session import scratch_dir
from tidemark.sources import bindings as B

ML_FEATURES = list(K.FEATURES)


def _features(spark, d):
    """Bars with forward-filled daily sentiment (P1 over bars), the newest row of a symbol included; stored once a session."""
    from tidemark.plans.training import prepare_from_bars

    def build():
        f = prepare_from_bars(B.bars(spark, d), _mapped_daily(spark, d))
        return f.select("date", "symbol", *ML_FEATURES)
    return B._stored(spark, ("features", d), build)


def _feature_frame(spark, d):
    """The features with the next row's target, split (P3); stored once a session, as training reads it several times
    and its passes over the trees then have as many tasks as the stored files' splits, not as the shuffles before."""
    from tidemark.operators.ml import add_split_features
    return B._stored(spark, ("feature_frame", d), lambda: add_split_features(
        _features(spark, d), "open", ("date", "symbol"), ("symbol",), _bucket()))


_FITTED: dict = {}


def _fitted(spark, d):
    key = (spark.sparkContext.applicationId, d)
    if key not in _FITTED:
        from tidemark.operators.ml import fit_and_predict
        frame = _feature_frame(spark, d)
        model, pred = fit_and_predict(frame, ML_FEATURES)
        _FITTED[key] = (frame, model, pred)
    return _FITTED[key]


@query("gbt_predict")
def q_gbt_predict(spark, d):
    """GBT (100 trees, depth 5, step 0.05) fit on train, test predictions."""
    _, _, pred = _fitted(spark, d)
    return pred.where(F.col("split") == "test").select(
        "symbol", "date", "open", "target_price", "prediction")


@query("eval_by_split")
def q_eval_by_split(spark, d):
    """MSE, MAE, MAPE on validation and test, one aggregate."""
    from tidemark.operators.metrics import regression_metrics
    _, _, pred = _fitted(spark, d)
    return regression_metrics(pred.where(F.col("split") != "train"), "target_price",
                              "prediction", by=["split"])


@query("validated_training")
def q_validated_training(spark, d):
    """M3/M5: training that the validation rows stop: rows behind each split's errors, and whether there is
    one for every tree and the error that predictions of the saved rows give is the last."""
    from tidemark.operators.ml import fit_with_validation, stored_errors
    path = scratch_dir(spark, "validated") + "/predictions"
    frame = _feature_frame(spark, d)
    model, trees, errors = fit_with_validation(frame, ML_FEATURES, params={"maxIter": 20})
    rows = model.transform(frame.where(F.col("split") != "test"))
    rows.select("symbol", "date", "split", "target_price", "prediction").write.parquet(path)
    last = errors.groupBy("split").agg(F.max_by("mse", "iteration").alias("last"), F.count("mse").alias("n"))
    stored = stored_errors(spark, path).select("split", F.col("mse").alias("stored"))
    counts = spark.read.parquet(path).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
    same = (F.col("n") == trees) & (F.abs(F.col("last") - F.col("stored")) <= 1e-6 * F.greatest(F.lit(1.0), F.col("stored")))
    return counts.join(last, "split").join(stored, "split").select("split", "n_rows", same.alias("same"))


@query("bucketed_return")
def q_bucketed_return(spark, d):
    """B6 with W1: returns over a catalog table bucketed by symbol and month and sorted, without a shuffle of its rows."""
    from tidemark.operators.series import pct_change
    from tidemark.sources.bucketed import month_of, write_bucketed
    bars = B.bars(spark, d).withColumn("month", month_of())
    path = scratch_dir(spark, "bucketed") + "/bars"
    t = write_bucketed(bars, "tidemark_bars", ["symbol", "month"], ["date"], 8, path)
    return pct_change(t, "close", "daily_return", ["symbol"], ["date"], F.col("month")).select("symbol", "date", "close", "daily_return")


@query("predict_next_day")
def q_predict_next_day(spark, d):
    """M6: next-day prediction from the newest complete row of every symbol."""
    from tidemark.operators.ml import predict_latest
    _, model, _ = _fitted(spark, d)
    newest = _features(spark, d).na.drop(subset=ML_FEATURES)      # no target is needed to predict
    return predict_latest(model, newest).select("symbol", "date", "prediction")


@query("predict_next_day_keys")
def q_predict_next_day_keys(spark, d):
    """M6: the symbols and the newest days that are predicted from."""
    return q_predict_next_day(spark, d).select("symbol", "date")


@query("ml_split_rows")
def q_ml_split_rows(spark, d):
    """The rows that training sees, with target and split."""
    return _feature_frame(spark, d).select("symbol", "date", "open", "target_price", "split")


@query("gbt_test_keys")
def q_gbt_test_keys(spark, d):
    """The rows that the test predictions are for, each predicted."""
    return q_gbt_predict(spark, d).select("symbol", "date", F.col("prediction").isNotNull().alias("predicted"))


@query("model_roundtrip_same")
def q_model_roundtrip_same(spark, d):
    """How many test rows a saved and loaded model predicts as before."""
    return q_model_roundtrip(spark, d).groupBy("same").agg(F.count(F.lit(1)).alias("n"))


@query("model_roundtrip")
def q_model_roundtrip(spark, d):
    """Saved and re-loaded pipeline gives the same test predictions."""
    from tidemark.operators.ml import load_model, save_model
    frame, model, pred = _fitted(spark, d)
    path = save_model(model, scratch_dir(spark, "model") + "/pipeline")
    again = load_model(path).transform(frame.where(F.col("split") == "test")).select(
        "symbol", "date", F.col("prediction").alias("reloaded"))
    first = pred.where(F.col("split") == "test").select("symbol", "date", "prediction")
    return first.join(again, ["symbol", "date"]).withColumn(
        "same", F.abs(F.col("prediction") - F.col("reloaded")) < 1e-9)


@query("sequence_dataset")
def q_sequence_dataset(spark, d):
    """M7: train-scaled sliding sequences per (split, symbol) written as parquet."""
    from tidemark.operators.ml import sequence_dataset
    from tidemark.operators.series import next_value
    from tidemark.operators.splits import temporal_split
    b = next_value(B.bars(spark, d), "open", "target_price", ["symbol"], ["date"], _bucket())
    b = temporal_split(b.where(F.col("target_price").isNotNull()), ["date", "symbol"])
    s = sequence_dataset(b, K.SEQUENCE_LENGTH, BAR_FEATURES, "target_price",
                         scratch_dir(spark, "sequences"), bucket=_bucket())
    return s.select("split", "symbol", "idx",
                    F.aggregate("x", F.lit(0.0), lambda a, e: a + e["close"]).alias("sum_close"),
                    F.col("x")[0]["volume"].alias("first_volume"), "y")


@query("batch_score")
def q_batch_score(spark, d):
    """Documents scored by a pluggable model (lexicon 'hate' / 'great') on
    Arrow batches, model loaded once per Python worker; whole texts."""
    from tidemark.operators.scoring import LexiconScorer, batch_score
    docs = B.table(spark, d, "documents").select("doc_id", "text")
    s = batch_score(docs, "text", LexiconScorer(["hate"], ["great"]))
    return s.select("doc_id", "sentiment_label", "sentiment_score")


@query("per_symbol_apply")
def q_per_symbol_apply(spark, d):
    """A user pandas function per (symbol, month) group via applyInPandas."""
    from tidemark.operators.grouped import per_key_apply

    def summary(pdf):
        import pandas as pd
        pdf = pdf.sort_values("date")
        return pd.DataFrame({"symbol": [pdf["symbol"].iloc[0]], "month": [pdf["month"].iloc[0]],
                             "n_rows": [len(pdf)], "mean_close": [pdf["close"].mean()],
                             "last_close": [pdf["close"].iloc[-1]]})
    b = B.bars(spark, d).withColumn("month", F.substring("date", 1, 7))
    return per_key_apply(b, ["symbol", "month"], summary,
                         "symbol string, month string, n_rows long, mean_close double, "
                         "last_close double")


@query("per_symbol_stream")
def q_per_symbol_stream(spark, d):
    """A function that goes through each symbol's whole history piece by piece (largest fall from a peak)."""
    from tidemark.operators.grouped import per_key_stream

    def drawdown(key, pieces):
        import pandas as pd
        peak, worst, n = None, 0.0, 0
        for p in pieces:
            for close in p["close"]:
                peak = close if peak is None else max(peak, close)
                worst, n = max(worst, peak - close), n + 1
        yield pd.DataFrame({"symbol": [key[0]], "n_rows": [n], "largest_fall": [worst]})
    return per_key_stream(B.bars(spark, d), ["symbol"], drawdown, "symbol string, n_rows long, largest_fall double", ["date"])


#: Rows of a sequence and weights of the linear model that ``predict_sequence`` saves and loads.
PREDICT_LENGTH = 28
PREDICT_WEIGHTS = [[((7 * i + 3 * j) % 11 - 5) / 100 for j in range(len(BAR_FEATURES))] for i in range(PREDICT_LENGTH)]


@query("predict_sequence")
def q_predict_sequence(spark, d):
    """M6: next opening price from every symbol's newest sequence, by a saved artefact; symbols without enough rows, and one
    that is not there, say why they have none."""
    from tidemark.operators.sequence_model import SequenceArtefact, fit_artefact, predict_sequences
    bars = B.bars(spark, d)
    path = scratch_dir(spark, "sequence_model") + "/artefact"
    fit_artefact(bars.where("date < '2024-01-25'"), BAR_FEATURES, "open", PREDICT_LENGTH, "tidemark.operators.sequence_model.LinearSequenceModel",
                 {"weights": PREDICT_WEIGHTS, "bias": 0.01}).save(spark, path)
    # the closing price is missing on a few newest days
    gaps = bars.withColumn("close", F.when((F.col("date") >= "2024-01-28") & F.col("symbol").endswith("7"), F.lit(None)).otherwise(F.col("close")))
    wanted = bars.select("symbol").distinct().unionByName(spark.createDataFrame([("NONE",)], "symbol string"))
    return predict_sequences(gaps, SequenceArtefact.load(spark, path), wanted)


@query("to_json_value")
def q_to_json_value(spark, d):
    """B1/C11: scored texts as one JSON value per row (NULL fields omitted)."""
    from tidemark.operators.envelope import to_json_value
    from tidemark.operators.scoring import keyword_score
    t = keyword_score(B.texts(spark, d)).select("id", "company", "timestamp", "text", "sentiment")
    return to_json_value(t)


@query("rebuild_table")
def q_rebuild_table(spark, d):
    """B7 then B6: a table filled by two bulk appends, then dropped and rebuilt
    (overwrite) from the full input; the rebuilt table equals the input."""
    path = scratch_dir(spark, "rebuild") + "/bars"
    bars = B.bars(spark, d)
    bars.where(F.col("date") < "2024-01-15").write.mode("append").parquet(path)
    bars.where(F.col("date") >= "2024-01-15").write.mode("append").parquet(path)
    appended = spark.read.parquet(path).count()
    bars.write.mode("overwrite").parquet(path)
    rebuilt = spark.read.parquet(path)
    return rebuilt.where(F.lit(appended) > 0)
