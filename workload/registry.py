"""Names, queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabmill.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL only its rows are checked, and tests do the rest."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists already")

        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return as_text(run(configure(spark), sf_dir))

        QUERIES[name] = configured
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def as_text(df: DataFrame) -> DataFrame:
    """Times, dates and flags as text, which both engines hand over alike, NULLs included."""
    changes = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            changes[f.name] = F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, (T.DateType, T.BooleanType)):
            changes[f.name] = F.col(f.name).cast("string")
    return df.withColumns(changes) if changes else df


def rounded(df: DataFrame, digits: int = 4, **special: int) -> DataFrame:
    """Doubles rounded: the engines add up in different orders."""
    changes = {
        f.name: F.round(F.col(f"`{f.name}`"), special.get(f.name, digits))
        for f in df.schema.fields
        if isinstance(f.dataType, T.DoubleType)
    }
    return df.withColumns(changes) if changes else df
