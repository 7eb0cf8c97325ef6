"""Checks made while the plan is built, before any job runs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "table") -> DataFrame:
    """Raise if a column is absent; otherwise return the table unchanged."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"{what} lacks required columns: {', '.join(absent)}")
    return df


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """Those of the columns which the table has, in the order given."""
    return [c for c in columns if c in df.columns]


def quoted(name: str) -> str:
    """A column name for use inside SQL text and ``F.col`` (leading digits, dots)."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.NumericType, T.BooleanType)) and f.name not in skip
    ]
