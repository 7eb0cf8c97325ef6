"""CORE and MARTS over the RAW run tables, as functions from tables to tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmill.functions.targets import bucket_label, bucket_order
from tabmill.functions.times import load_timestamp, run_timestamp
from tabmill.operators.metrics import error_by_bucket
from tabmill.operators.windows import dedup_latest, first_row, top_per_group

# the number first: sorts compare it before the long strings
PREDICTION_KEYS = ["kaggle_id", "model_id", "model_version"]

MODEL_COLUMNS = ["id", "name", "version", "is_champion", "cv_rmse_mean", "cv_rmse_std", "rmse_test", "r2_test"]
CV_COLUMNS = [
    "kaggle_id", "y_true", "y_pred_oof", "abs_error", "rel_error", "model_id", "model_name", "model_version",
]
SCORE_COLUMNS = ["kaggle_id", "predicted_price", "model_id", "model_name", "model_version"]


def _with_run(df: DataFrame, version: str) -> DataFrame:
    ts = run_timestamp(F.col(version))
    return df.withColumns({"run_ts": ts, "run_date": F.to_date(ts)})


def _latest(raw: DataFrame, columns: Sequence[str], keys: Sequence[str], tie_break: Sequence[Column | str]) -> DataFrame:
    loaded = raw.select(*columns, load_timestamp(raw, "created_at_utc").alias("created_at_utc"))
    return dedup_latest(loaded, keys, "created_at_utc", tie_break)


def core_models(models: DataFrame, tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """The latest row of each model, with the start of its run."""
    latest = _latest(models, [*MODEL_COLUMNS, "file_path"], ["id"], tie_break)
    out = _with_run(latest, "version")
    return out.select(*MODEL_COLUMNS, "created_at_utc", "file_path", "run_ts", "run_date")


def core_cv_predictions(cv: DataFrame, tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """The latest out-of-fold prediction per model, run and id, with its value bucket."""
    latest = _latest(cv, CV_COLUMNS, PREDICTION_KEYS, tie_break)
    return _with_run(latest, "model_version").withColumns(
        {"price_bucket": bucket_label(F.col("y_true")), "price_bucket_order": bucket_order(F.col("y_true"))}
    )


def core_predictions(predictions: DataFrame, tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """The latest prediction per model, run and id."""
    return _with_run(_latest(predictions, SCORE_COLUMNS, PREDICTION_KEYS, tie_break), "model_version")


def model_leaderboard(models_core: DataFrame) -> DataFrame:
    return models_core.select("run_ts", "run_date", *MODEL_COLUMNS, "created_at_utc", "file_path")


def champion_by_run(models_core: DataFrame) -> DataFrame:
    """One model per run: the flagged champion, else the one with the smallest error."""
    best = top_per_group(
        models_core,
        ["version"],
        [F.col("is_champion").desc_nulls_last(), F.col("cv_rmse_mean").asc_nulls_first(), F.col("id").asc()],
        1,
    )
    return best.select(
        "run_ts", "run_date", "version", F.col("id").alias("model_id"), F.col("name").alias("model_name"),
        *MODEL_COLUMNS[3:], "created_at_utc", "file_path",
    )


def cv_error_by_bucket(cv_core: DataFrame) -> DataFrame:
    keys = ["run_ts", "run_date", "model_version", "model_id", "model_name", "price_bucket", "price_bucket_order"]
    return error_by_bucket(cv_core, keys, "y_true", "y_pred_oof")


def top_outliers(cv_core: DataFrame, n: int = 100) -> DataFrame:
    """The rows with the largest errors of each model and run."""
    order = [F.col("abs_error").desc_nulls_last(), F.col("kaggle_id").asc()]
    return top_per_group(cv_core, ["model_version", "model_id"], order, n).select(
        "run_ts", "run_date", "model_version", "model_id", "model_name", "kaggle_id", "y_true", "y_pred_oof",
        "abs_error", "rel_error", "price_bucket", "price_bucket_order", "created_at_utc",
    )


def latest_champion(champions: DataFrame) -> DataFrame:
    """model_id, model_version of the newest run; one row."""
    sort_ts = F.coalesce(F.col("run_ts"), F.col("created_at_utc"))
    newest = first_row(champions, sort_ts.desc_nulls_last(), F.col("version").asc(), F.col("model_id").asc())
    return newest.select("model_id", F.col("version").alias("model_version"))


def predictions_latest_champion(
    predictions: DataFrame, champions: DataFrame, tie_break: Sequence[Column | str] = ()
) -> DataFrame:
    """The predictions of the latest champion.

    Takes RAW predictions: the join keys are part of the de-duplication key, so joining the one
    champion row first gives the same result and only its rows are shuffled.
    """
    one_row = F.broadcast(latest_champion(champions))
    return core_predictions(predictions.join(one_row, ["model_id", "model_version"], "left_semi"), tie_break).select(
        "kaggle_id", "predicted_price", "model_id", "model_name", "model_version", "created_at_utc", "run_ts", "run_date"
    )


def dim_run(models_core: DataFrame) -> DataFrame:
    return models_core.select("version", "run_ts", "run_date").distinct()


def dim_model(models_core: DataFrame) -> DataFrame:
    return models_core.select("id", "name").distinct()
