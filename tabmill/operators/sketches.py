"""Medians of training parts from mergeable quantile sketches: one small sketch per column and fold, merged over the other folds.

The table is read once, without counting by value, and what is shuffled is a sketch per input partition, fold and column: kilobytes,
whatever the number of distinct values. The exact medians of ``encode.fold_medians`` stay the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.functions.checks import col

# Values a sketch holds at its lowest level; up to so many values it holds them all.
SKETCH_SIZE = 1000


def rank_error(size: int = SKETCH_SIZE) -> float:
    """How far the rank of a sketched value lies from the rank asked for, as a share of the rows, in 99 of 100 cases.

    The published bound of the sketch for one rank; merging does not widen it.
    """
    return 2.296 / size**0.9723


def fold_sketches(df: DataFrame, columns: Sequence[str], fold: str = "fold", size: int = SKETCH_SIZE) -> DataFrame:
    """fold, column, sketch, n — the present values of each column and fold; parts without any are left out."""
    values = [col(c).cast("double") for c in columns]
    values = [F.when(~F.isnan(v), v) for v in values]
    made = [f(v).alias(f"{kind}{i}") for i, v in enumerate(values) for kind, f in (("s", lambda v: F.kll_sketch_agg_double(v, size)), ("n", F.count))]
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("sketch"), F.col(f"n{i}").alias("n")) for i, c in enumerate(columns)]
    # as many groups as folds, each with a sketch per column
    per_fold = df.where(F.col(fold).isNotNull()).groupBy(F.col(fold).cast("int").alias("fold")).agg(*made)
    return per_fold.select("fold", F.inline(F.array(*cells))).where("n > 0")


def fold_medians(df: DataFrame, columns: Sequence[str], fold: str = "fold", size: int = SKETCH_SIZE) -> DataFrame:
    """fold, column, n, median — for each fold over the present values of all other folds.

    With an even count the lower of both middle values. A value's rank is off by ``rank_error(size)`` of the rows, in 99 of 100
    cases; while all other folds together have no more than ``size`` values, it is exactly that value. A column without values gives NULL.
    """
    sketches = fold_sketches(df, columns, fold, size)
    left_out = df.where(F.col(fold).isNotNull()).select(F.col(fold).cast("int").alias("skip")).distinct()
    wanted = left_out.select("skip", F.explode(F.array(*[F.lit(c) for c in columns])).alias("wanted"))
    # one row per fold and column on both sides
    others = wanted.join(F.broadcast(sketches), (F.col("wanted") == F.col("column")) & (F.col("skip") != F.col("fold")), "left")
    merged = others.groupBy("skip", "wanted").agg(F.expr(f"kll_merge_agg_double(sketch, {int(size)})").alias("sketch"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    middle = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)))
    return merged.select(F.col("skip").alias(fold), F.col("wanted").alias("column"), "n", middle.alias("median"))
