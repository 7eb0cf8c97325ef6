"""What a table holds: types, missing values, levels, modes.

Questions about columns are answered by one aggregate row over the table, turned into one row
per column afterwards. Questions about levels go through ``level_counts``, which counts within
each input partition before anything is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmill.functions.checks import col, string_columns


def _per_column(df: DataFrame, columns: Sequence[str], **measures) -> DataFrame:
    """One row per column with the named aggregates, from a single pass."""
    row = df.agg(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), *[m(c).alias(name) for name, m in measures.items()])
                for c in columns
            ]
        ).alias("profile")
    )
    return row.select(F.inline("profile"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column, nulls"""
    return _per_column(df, columns or df.columns, nulls=lambda c: F.count_if(col(c).isNull()))


def total_nulls(df: DataFrame) -> DataFrame:
    return null_counts(df).agg(F.sum("nulls").alias("nulls"))


def columns_with_nulls(df: DataFrame) -> DataFrame:
    """Columns that have missing values, most missing first."""
    return null_counts(df).where("nulls > 0").orderBy(F.desc("nulls"), "column")


def column_info(df: DataFrame) -> DataFrame:
    """column, type, non_null"""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return _per_column(
        df, df.columns, type=lambda c: F.any_value(F.lit(types[c])), non_null=lambda c: F.count(col(c))
    )


def type_counts(df: DataFrame) -> dict[str, int]:
    """Number of columns per type; the schema answers, no job runs."""
    return dict(Counter(f.dataType.simpleString() for f in df.schema.fields))


def mixed_content(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """String columns whose values are partly numbers and partly not."""
    names = list(columns) if columns is not None else string_columns(df)
    numbers = lambda c: F.count_if(col(c).try_cast("double").isNotNull())
    found = _per_column(df, names, values=lambda c: F.count(col(c)), numbers=numbers)
    return found.where("numbers > 0 and numbers < values")


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), cast: str = "string") -> DataFrame:
    """One row per row and column: keep..., column, value."""
    cells = [F.struct(F.lit(c).alias("column"), col(c).cast(cast).alias("value")) for c in columns]
    return df.select(*keep, F.inline(F.array(*cells)))


def level_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """by..., column, value, n for the non-missing values of each column."""
    cells = long_form(df, columns, by).where("value is not null")
    return cells.groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of the non-missing values, most frequent first."""
    counts = df.where(col(column).isNotNull()).groupBy(col(column)).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), col(column))


def _most_frequent(order: Column) -> Column:
    """The pair (-n, value) that sorts first: highest count, smallest value among ties."""
    return F.min(F.struct((-F.col("n")).alias("neg"), order.alias("value")))


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, mode as text (the smallest of equally frequent values, in the order of the column's own type)

    Counting levels first keeps every aggregation buffer at one value per key; the built-in
    ``mode`` would hold all levels of a column in one task. A column without values has no mode.
    """
    by_type: dict[str, list[str]] = {}
    for c in columns:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    parts = []
    for kind, names in by_type.items():
        cells = long_form(df, names, cast=kind).where("value is not null")
        counts = cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        top = counts.groupBy("column").agg(_most_frequent(F.col("value")).alias("top"))
        parts.append(top.select("column", F.col("top.value").cast("string").alias("mode")))
    return _for_each(df, columns, reduce(DataFrame.unionByName, parts))


def _for_each(df: DataFrame, columns: Sequence[str], found: DataFrame) -> DataFrame:
    """One row per column named, also of those that ``found`` has none for."""
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return names.join(found, "column", "left")


def string_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column, count, unique, top, freq; a column without values counts 0"""
    names = list(columns) if columns is not None else string_columns(df)
    found = (
        level_counts(df, names)
        .groupBy("column")
        .agg(
            F.sum("n").alias("count"),
            F.count(F.lit(1)).alias("unique"),
            _most_frequent(F.col("value")).alias("first"),
        )
        .select("column", "count", "unique", F.col("first.value").alias("top"), (-F.col("first.neg")).alias("freq"))
    )
    return _for_each(df, names, found).fillna(0, subset=["count", "unique"])


def layer_report(**layers: DataFrame) -> DataFrame:
    """layer, rows — the row counts of several tables as one table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), "rows")
        for name, df in layers.items()
    ]
    report = counts[0]
    for part in counts[1:]:
        report = report.unionByName(part)
    return report
