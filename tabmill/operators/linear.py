"""Regression on one feature as plain aggregates: every fold's fit comes out of one pass.

``regr_slope ... FILTER (fold <> f)`` keeps two moments per fold in the aggregation buffer, so
the table is read once and only one row per input partition is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.functions.checks import col
from tabmill.functions.targets import RAW_TARGET, TargetTransform
from tabmill.operators.ranks import medians


def fit_univariate(
    df: DataFrame, feature: str, label: str, k: int, fold: str = "fold", target: TargetTransform = RAW_TARGET
) -> DataFrame:
    """fold, fill, slope, intercept — one row per fold, fitted on the rows of the other folds.

    ``fill`` is the median of the feature over those rows and replaces its missing values.
    """
    fills = medians(df.withColumn("_x", col(feature).cast("double")), ["_x"], leave_out=fold)
    y = target.forward(col(label).cast("double"))
    fits = []
    for f in range(k):
        fill = F.lit(fills.get(f, {}).get("_x")).cast("double")
        x = F.when(F.col(fold) != f, F.coalesce(col(feature).cast("double"), fill))
        fits.append(
            F.struct(
                F.lit(f).alias(fold), fill.alias("fill"),
                F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
            )
        )
    return df.agg(F.array(*fits).alias("fits")).select(F.inline("fits"))


def out_of_fold_univariate(
    df: DataFrame, feature: str, label: str, k: int, fold: str = "fold", target: TargetTransform = RAW_TARGET,
    name: str = "y_pred_oof",
) -> DataFrame:
    """Adds the prediction of the model which was fitted without the row's fold."""
    fits = fit_univariate(df, feature, label, k, fold, target)
    x = F.coalesce(col(feature).cast("double"), F.col("fill"))
    # k rows on the right
    scored = df.join(F.broadcast(fits), fold)
    return scored.withColumn(name, target.inverse(F.col("intercept") + F.col("slope") * x)).drop("fill", "slope", "intercept")
