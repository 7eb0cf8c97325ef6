"""One marker for missing values (NULL) from ingest on."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabmill.defaults import MISSING_TOKENS, NONE_FILL, READER_MISSING_TOKENS, ZERO_FILL
from tabmill.functions.checks import col, present, quoted, string_columns

# A number as CSV readers know it; a cast alone also takes '5D'.
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$|^\s*[+-]?[iI]nf(inity)?\s*$"
_NUMBER_STARTS = [*"0123456789+-. iI"]
_FLAGS = ["True", "TRUE", "true", "False", "FALSE", "false"]
_SURE_DIGITS = 18


def _kind(value: Column) -> Column:
    """missing, integer (of 64 bits), decimal, flag or text.

    The first character decides for most text, so that the pattern is tried on likely numbers
    and nothing is parsed in vain: a failing cast costs a hundred times a successful one.
    """
    number = F.substring(value, 1, 1).isin(_NUMBER_STARTS) & value.rlike(_NUMBER)
    fraction = value.contains(".") | value.contains("e") | value.contains("E") | value.contains("n")
    fits = (F.length(value) <= _SURE_DIGITS) | value.try_cast("bigint").isNotNull()
    return (
        F.when(value.isNull(), "missing")
        .when(number, F.when(~fraction & fits, "integer").otherwise("decimal"))
        .when(value.isin(_FLAGS), "flag")
        .otherwise("text")
    )


def normalize_missing(
    df: DataFrame,
    tokens: Sequence[str] = (*MISSING_TOKENS, *READER_MISSING_TOKENS),
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """Replace the missing tokens of string columns by NULL."""
    names = present(df, columns) if columns is not None else string_columns(df)
    if not names:
        return df
    listed = ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in tokens)
    return df.withColumns({c: F.expr(f"CASE WHEN {quoted(c)} NOT IN ({listed}) THEN {quoted(c)} END") for c in names})


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN orders above every number in Spark; the layers know NULL only."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.nanvl(col(c), F.lit(None).cast("double")) for c in names})


def infer_types(df: DataFrame, columns: Iterable[str] | None = None, widen_nullable: bool = True) -> DataFrame:
    """Cast string columns to the narrowest type all their values have.

    One pass decides for all columns: bigint, double, boolean or string. With
    ``widen_nullable`` an integer column with missing values becomes double and an empty
    column too, as in a reader whose integers cannot be missing.
    """
    names = present(df, columns) if columns is not None else string_columns(df)
    if not names:
        return df
    # one row per value and column, counted within each input partition: a single aggregate row
    # with several probes per column would be too much code to compile for wide tables
    cells = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), col(c).alias("value")) for c in names])))
    counts = cells.groupBy("column", _kind(F.col("value")).alias("kind")).count()
    kinds: dict[str, set[str]] = {c: set() for c in names}
    for r in counts.collect():
        kinds[r["column"]].add(r["kind"])
    casts = {}
    for c, found in kinds.items():
        complete = "missing" not in found
        values = found - {"missing"}
        if not values:
            target = "double" if found and widen_nullable else None
        elif values == {"integer"}:
            target = "bigint" if complete or not widen_nullable else "double"
        elif values <= {"integer", "decimal"}:
            target = "double"
        elif values == {"flag"} and (complete or not widen_nullable):
            target = "boolean"
        else:
            target = None
        if target:
            casts[c] = F.trim(col(c)).cast(target)
    return df.withColumns(casts) if casts else df


def fill_not_present(df: DataFrame, columns: Iterable[str] = tuple(NONE_FILL), value: str = "None") -> DataFrame:
    """Missing means "not present" in these columns; absent columns are skipped."""
    names = present(df, columns)
    # an all-missing column arrives as a number; the fill makes it text
    casts = {c: F.coalesce(col(c).cast("string"), F.lit(value)) for c in names}
    return df.withColumns(casts) if casts else df


def fill_zero(df: DataFrame, columns: Iterable[str] = tuple(ZERO_FILL)) -> DataFrame:
    names = present(df, columns)
    return df.fillna(0, subset=names) if names else df


def treat_missing(
    df: DataFrame, none_fill: Iterable[str] = tuple(NONE_FILL), zero_fill: Iterable[str] = tuple(ZERO_FILL)
) -> DataFrame:
    """Both constant fills; no statistic of the data is used."""
    return fill_zero(fill_not_present(df, none_fill), zero_fill)
