"""Quality of predictions, per group and over folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rmse(actual: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg(F.pow(actual - predicted, F.lit(2))))


def r2(actual: Column, predicted: Column) -> Column:
    """1 - SSE / SST; this is not the squared correlation ``regr_r2``."""
    return F.lit(1.0) - F.sum(F.pow(actual - predicted, F.lit(2))) / (F.var_pop(actual) * F.count(actual))


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(actual), F.col(predicted)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        rmse(y, p).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.avg(F.abs(y - p) / F.greatest(y, F.lit(1.0))).alias("mean_rel_error"),
        F.max(F.abs(y - p)).alias("max_abs_error"),
        r2(y, p).alias("r2"),
    )


def fold_summary(df: DataFrame, actual: str, predicted: str, fold: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean of the fold RMSEs and their population deviation (not the pooled RMSE)."""
    per_fold = df.groupBy(*by, fold).agg(rmse(F.col(actual), F.col(predicted)).alias("fold_rmse"))
    return per_fold.groupBy(*by).agg(
        F.avg("fold_rmse").alias("cv_rmse_mean"), F.stddev_pop("fold_rmse").alias("cv_rmse_std")
    )


def error_by_bucket(df: DataFrame, keys: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """Size and errors per group from stored error columns."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        rmse(F.col(actual), F.col(predicted)).alias("rmse"),
        F.avg("abs_error").alias("mean_abs_error"),
        F.avg("rel_error").alias("mean_rel_error"),
        F.max("abs_error").alias("max_abs_error"),
    )
