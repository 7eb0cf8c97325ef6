"""CORE and MARTS as catalog views, for those who query the run tables with SQL.

The statements are put together from the same column lists and cuts as the table functions in
``marts``; a test holds both to the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tabmill.defaults import PRICE_CUTS, PRICE_REST, RUN_VERSION_FORMAT
from tabmill.functions.checks import quoted
from tabmill.plans.marts import CV_COLUMNS, MODEL_COLUMNS, PREDICTION_KEYS, SCORE_COLUMNS
from tabmill.sources.sinks import ensure_namespace

# --- fixed values: smallest magnitude of an epoch integer in each unit, and how to read it ---
_EPOCH_UNITS = [
    (10**18, "timestamp_micros({x} div 1000)"),
    (10**15, "timestamp_micros({x})"),
    (10**12, "timestamp_millis({x})"),
    (10**9, "timestamp_seconds({x})"),
]


def _list(columns: Sequence[str]) -> str:
    return ", ".join(columns)


def _load_time(spark: SparkSession, table: str) -> str:
    """Expression for the load time, by the type the stored table has."""
    if not isinstance(spark.table(table).schema["created_at_utc"].dataType, T.IntegralType):
        return "cast(created_at_utc AS timestamp)"
    units = " ".join(f"WHEN created_at_utc >= {low} THEN {read.format(x='created_at_utc')}" for low, read in _EPOCH_UNITS)
    return f"CASE {units} END"


def _core(
    spark: SparkSession, table: str, columns: Sequence[str], keys: Sequence[str], version: str, extra: str = "", only: str = ""
) -> str:
    """The latest row per key with the start of its run; remaining columns settle ties. ``only``
    joins before rows are sorted out, which needs to keep or drop keys as a whole."""
    ties = _list([c for c in columns if c not in keys])
    run = f"try_to_timestamp({version}, '{RUN_VERSION_FORMAT}')"
    return (
        f"SELECT {_list(columns)}, loaded AS created_at_utc, {run} AS run_ts, to_date({run}) AS run_date{extra}"
        f" FROM (SELECT *, row_number() OVER (PARTITION BY {_list(keys)} ORDER BY loaded DESC NULLS LAST, {ties}) AS pick"
        f" FROM (SELECT {_list(columns)}, {_load_time(spark, table)} AS loaded FROM {table}{only})) WHERE pick = 1"
    )


def _bucket_columns() -> str:
    labels = " ".join(f"WHEN y_true < {cut} THEN '{label}'" for cut, label in PRICE_CUTS)
    ranks = " ".join(f"WHEN y_true < {cut} THEN {i}" for i, (cut, _) in enumerate(PRICE_CUTS))
    return (
        f", CASE {labels} ELSE '{PRICE_REST}' END AS price_bucket, CASE {ranks} ELSE {len(PRICE_CUTS)} END AS price_bucket_order"
    )


def view_queries(spark: SparkSession, raw: str, core: str, marts: str, outliers: int = 100) -> dict[str, str]:
    """View name -> query, in the order they build on each other."""
    models, cv, scores = (f"{quoted(raw)}.{t}" for t in ("models", "train_cv_predictions", "predictions"))
    core_, marts_ = quoted(core), quoted(marts)
    run = "run_ts, run_date"
    bucket = "price_bucket, price_bucket_order"
    measures = _list(MODEL_COLUMNS[4:])
    return {
        f"{core_}.v_models": _core(spark, models, [*MODEL_COLUMNS, "file_path"], ["id"], "version"),
        f"{core_}.v_train_cv_predictions": _core(spark, cv, CV_COLUMNS, PREDICTION_KEYS, "model_version", _bucket_columns()),
        f"{core_}.v_predictions": _core(spark, scores, SCORE_COLUMNS, PREDICTION_KEYS, "model_version"),
        f"{marts_}.model_leaderboard": f"SELECT {run}, {_list(MODEL_COLUMNS)}, created_at_utc, file_path FROM {core_}.v_models",
        f"{marts_}.champion_by_run": (
            f"SELECT {run}, version, id AS model_id, name AS model_name, is_champion, {measures}, created_at_utc, file_path"
            " FROM (SELECT *, row_number() OVER (PARTITION BY version ORDER BY is_champion DESC NULLS LAST,"
            f" cv_rmse_mean ASC NULLS FIRST, id) AS pick FROM {core_}.v_models) WHERE pick = 1"
        ),
        f"{marts_}.cv_error_by_bucket": (
            f"SELECT {run}, model_version, model_id, model_name, {bucket}, count(*) AS n,"
            " sqrt(avg(pow(y_true - y_pred_oof, 2))) AS rmse, avg(abs_error) AS mean_abs_error,"
            f" avg(rel_error) AS mean_rel_error, max(abs_error) AS max_abs_error FROM {core_}.v_train_cv_predictions"
            f" GROUP BY {run}, model_version, model_id, model_name, {bucket}"
        ),
        f"{marts_}.top_outliers": (
            f"SELECT {run}, model_version, model_id, model_name, kaggle_id, y_true, y_pred_oof, abs_error, rel_error, {bucket},"
            " created_at_utc FROM (SELECT *, row_number() OVER (PARTITION BY model_version, model_id"
            f" ORDER BY abs_error DESC NULLS LAST, kaggle_id) AS pick FROM {core_}.v_train_cv_predictions) WHERE pick <= {outliers}"
        ),
        f"{marts_}.predictions_latest_champion": _core(
            spark, scores, SCORE_COLUMNS, PREDICTION_KEYS, "model_version",
            only=" LEFT SEMI JOIN (SELECT model_id AS best_id, version AS best_version"
            f" FROM {marts_}.champion_by_run ORDER BY coalesce(run_ts, created_at_utc) DESC NULLS LAST, version, model_id LIMIT 1)"
            " ON model_id = best_id AND model_version = best_version",
        ),
        f"{marts_}.dim_run": f"SELECT DISTINCT version, {run} FROM {core_}.v_models",
        f"{marts_}.dim_model": f"SELECT DISTINCT id, name FROM {core_}.v_models",
    }


def apply_views(spark: SparkSession, raw: str, core: str, marts: str) -> list[str]:
    """Create or replace all views over the RAW tables of a namespace; returns their names."""
    for namespace in (core, marts):
        ensure_namespace(spark, namespace)
    queries = view_queries(spark, raw, core, marts)
    for name, text in queries.items():
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text}")
    return list(queries)
