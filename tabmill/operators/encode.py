"""Statistics fitted on one table and applied to another: medians, scale, category levels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.defaults import MISSING_CATEGORY
from tabmill.functions.checks import col
from tabmill.operators import sketches
from tabmill.operators.profile import level_counts, modes
from tabmill.operators.ranks import medians

INFREQUENT = "__infrequent__"
# Kept levels that a plan may hold as literals; a parameter of every operator that lists them.
MAX_KEPT_LEVELS = 5_000


# --- numbers ---


def impute_global(df: DataFrame, median_columns: Sequence[str], mode_columns: Sequence[str] = ()) -> DataFrame:
    """Fill with statistics of the whole table (exploration only: they leak into held-out rows)."""
    fills: dict = {}
    if median_columns:
        fills |= {c: m for c, m in medians(df, median_columns)[None].items() if m is not None}
    if mode_columns:
        # one row per named column
        fills |= {r["column"]: r["mode"] for r in modes(df, mode_columns).collect() if r["mode"] is not None}
    exprs = {
        c: F.coalesce(col(c).cast("double"), F.lit(v)) if c in median_columns
        else F.coalesce(col(c), F.lit(v).cast(df.schema[c].dataType))
        for c, v in fills.items()
    }
    return df.withColumns(exprs) if exprs else df


def fold_medians(df: DataFrame, columns: Sequence[str], fold: str = "fold", sketch: int | None = None) -> DataFrame:
    """fold, column, median — for each fold over the rows of all other folds; one row per pair.

    Exact, or with ``sketch`` from quantile sketches of that size, see ``sketches.rank_error``.
    """
    if sketch is not None:
        return sketches.fold_medians(df, columns, fold, sketch).drop("n")
    found = medians(df, columns, leave_out=fold)
    rows = [(f, c, m) for f, per_column in found.items() for c, m in per_column.items()]
    return df.sparkSession.createDataFrame(rows, f"{fold} int, column string, median double")


def impute_by_fold(df: DataFrame, columns: Sequence[str], fold: str = "fold", sketch: int | None = None) -> DataFrame:
    """Fill each row with the medians of the folds it does not belong to, exact or sketched.

    The joined side has one row per fold.
    """
    per_fold = fold_medians(df, columns, fold, sketch)
    wide = per_fold.groupBy(fold).agg(
        *[F.max(F.when(F.col("column") == c, F.col("median"))).alias(f"_m{i}") for i, c in enumerate(columns)]
    )
    joined = df.join(F.broadcast(wide), fold, "left")
    fills = {c: F.coalesce(col(c).cast("double"), F.col(f"_m{i}")) for i, c in enumerate(columns)}
    return joined.withColumns(fills).drop(*[f"_m{i}" for i in range(len(columns))])


def scale_statistics(df: DataFrame, columns: Sequence[str], fold: str | None = None, k: int = 0) -> DataFrame:
    """fold, column, mean, std — population deviation, a constant column counts as 1.

    With a fold column the statistics of every training part come from one pass; without it
    the fold is -1 and the statistics cover the table.
    """
    parts = [(f, F.col(fold) != f) for f in range(k)] if fold else [(-1, F.lit(True))]
    cells = [
        F.struct(
            F.lit(f).alias("fold"),
            F.lit(c).alias("column"),
            F.avg(F.when(inside, col(c))).alias("mean"),
            F.stddev_pop(F.when(inside, col(c))).alias("dev"),
        )
        for f, inside in parts
        for c in columns
    ]
    rows = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    return rows.select("fold", "column", "mean", F.when(F.col("dev") == 0, 1.0).otherwise(F.col("dev")).alias("std"))


def standardize(df: DataFrame, statistics: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(value - mean) / std for the named columns."""
    return df.withColumns({c: (col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in statistics.items()})


# --- categories ---


def fill_category(df: DataFrame, columns: Sequence[str], marker: str = MISSING_CATEGORY) -> DataFrame:
    return df.withColumns({c: F.coalesce(col(c).cast("string"), F.lit(marker)) for c in columns})


def levels(df: DataFrame, columns: Sequence[str], min_frequency: int | float = 10) -> DataFrame:
    """column, value, n, kept — a level is kept unless it is rarer than ``min_frequency``
    (a count, or a share of the rows if below 1). The missing marker is a level as well."""
    counts = level_counts(fill_category(df, columns), columns)
    if isinstance(min_frequency, float):
        # every row has one level per column; one total per named column on the right
        totals = counts.groupBy("column").agg(F.sum("n").alias("rows"))
        counts = counts.join(F.broadcast(totals), "column")
        counts = counts.withColumn("kept", F.col("n") >= F.col("rows") * min_frequency).drop("rows")
        return counts
    return counts.withColumn("kept", F.col("n") >= min_frequency)


def group_rare(df: DataFrame, level_table: DataFrame, columns: Sequence[str], max_levels: int = MAX_KEPT_LEVELS) -> DataFrame:
    """Replace rare levels by one marker and levels not seen in fitting by NULL.

    The ``max_levels`` most frequent kept levels are a list that the plan holds, and rows that have one do not take part in the
    look-up of the others: only rows with another level are joined by it, so a frequent level is no hot key.
    """
    kept = level_table.where(F.col("column").isin(list(columns)) & F.col("kept"))
    marker = F.col("value") == INFREQUENT
    found = kept.orderBy(marker.desc(), F.col("n").desc(), "column", "value").limit(max_levels).select("column", "value").collect()
    out = fill_category(df, columns)
    for c in columns:
        known = level_table.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("kept").alias("_kept"))
        out = _marked(out, c, sorted(r["value"] for r in found if r["column"] == c), known)
    return out


def kept_levels(level_table: DataFrame, columns: Sequence[str], max_levels: int = MAX_KEPT_LEVELS) -> dict[str, list[str]]:
    """The kept levels of each column in alphabetical order; more than ``max_levels`` in all are refused."""
    kept = level_table.where(F.col("column").isin(list(columns)) & F.col("kept")).select("column", "value")
    found = kept.limit(max_levels + 1).collect()
    if len(found) > max_levels:
        raise ValueError(f"more than {max_levels} kept levels: raise max_levels or the least frequency")
    out: dict[str, list[str]] = {c: [] for c in columns}
    for r in found:
        out[r["column"]].append(r["value"])
    return {c: sorted(v) for c, v in out.items()}


def _with_rare(df: DataFrame, c: str, kept: list[str], rare: DataFrame) -> DataFrame:
    """The table with ``_value``, which is set where column ``c`` has a rare level; ``rare`` has that one column."""
    is_kept = col(c).isin(kept) if kept else F.lit(False)
    return df.withColumn("_probe", F.when(~is_kept, col(c))).join(rare, F.col("_probe") == F.col("_value"), "left").drop("_probe")


def _marked(df: DataFrame, c: str, kept: list[str], known: DataFrame) -> DataFrame:
    """Column ``c`` with rare levels as one marker and unseen ones as NULL; ``known`` tells of every level whether it is kept."""
    if INFREQUENT in kept:
        raise ValueError(f"column {c} has a level {INFREQUENT!r}, which marks rare levels")
    level = F.when(F.col("_kept"), col(c)).when(F.col("_value").isNotNull(), F.lit(INFREQUENT))
    level = F.when(col(c).isin(kept), col(c)).otherwise(level) if kept else level
    return _with_rare(df, c, kept, known).withColumn(c, level).drop("_value", "_kept")


def level_column(column: str, level: str | None) -> str:
    """Name of the 0/1 column of a level, or of all rare ones. Underscores of the column are doubled, so that names differ
    wherever column or level do."""
    return f"{column.replace('_', '__')}_rare" if level is None else f"{column.replace('_', '__')}_is_{level}"


def one_hot(df: DataFrame, level_table: DataFrame, columns: Sequence[str], max_levels: int = MAX_KEPT_LEVELS) -> DataFrame:
    """One 0/1 column per kept level and one for all rare ones; unseen levels are 0 everywhere.

    Every kept level becomes a column of the schema, so ``max_levels`` bounds them. Names that the table has already are refused.
    """
    kept = kept_levels(level_table, columns, max_levels)
    rare = level_table.where(F.col("column").isin(list(columns)) & ~F.col("kept"))
    with_rare = {r["column"] for r in rare.select("column").distinct().collect()}  # some of the columns named
    names = [level_column(c, level) for c in columns for level in [*kept[c], *([None] if c in with_rare else [])]]
    clashes = sorted(set(names) & (set(df.columns) - set(columns)))
    if clashes or len(set(names)) < len(names):
        raise ValueError(f"the table has columns of these names already: {clashes}")
    out = fill_category(df, columns)
    for c in columns:
        if c in with_rare:
            out = _with_rare(out, c, kept[c], rare.where(F.col("column") == c).select(F.col("value").alias("_value")))
            out = out.withColumn(level_column(c, None), F.col("_value").isNotNull().cast("int")).drop("_value")
    flags = {level_column(c, level): (col(c) == F.lit(level)).cast("int") for c in columns for level in kept[c]}
    return out.withColumns(flags).drop(*columns)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of all parts, columns matched by name; columns missing in a part are NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
