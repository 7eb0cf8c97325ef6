"""Timestamps of runs and loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabmill.defaults import RUN_VERSION_FORMAT


def epoch_to_timestamp(value: Column, unit: str = "auto") -> Column:
    """Epoch integer to timestamp; ``auto`` takes the unit from the magnitude.

    The magnitude rule is right for instants from 2001-09-09 on; state ``unit`` for older ones.
    """
    x = value.cast("bigint")
    by_unit = {
        "ns": F.timestamp_micros(F.call_function("div", x, F.lit(1000))),
        "us": F.timestamp_micros(x),
        "ms": F.timestamp_millis(x),
        "s": F.timestamp_seconds(x),
    }
    if unit != "auto":
        return by_unit[unit]
    return (
        F.when(x >= 10**18, by_unit["ns"])
        .when(x >= 10**15, by_unit["us"])
        .when(x >= 10**12, by_unit["ms"])
        .when(x >= 10**9, by_unit["s"])
    )


def load_timestamp(df: DataFrame, name: str, unit: str = "auto") -> Column:
    """A load time as timestamp, whether stored as epoch integer or as timestamp."""
    data_type = df.schema[name].dataType
    if isinstance(data_type, T.IntegralType):
        return epoch_to_timestamp(F.col(name), unit)
    return F.col(name).cast("timestamp")


def run_timestamp(version: Column, fmt: str = RUN_VERSION_FORMAT) -> Column:
    """Start of a run from its version; NULL where the version is no time stamp."""
    return F.try_to_timestamp(version, F.lit(fmt))


def run_version(ts: Column, fmt: str = RUN_VERSION_FORMAT) -> Column:
    """The version a run started at ``ts`` gets."""
    return F.date_format(ts, fmt)


def lenient_timestamp(text: Column) -> Column:
    """Timestamp from text; NULL where it cannot be read."""
    return F.try_to_timestamp(text)
