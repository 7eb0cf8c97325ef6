"""Row-wise features of the gold layer."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmill.defaults import BATHS, FLOOR_AREA, PORCHES, PRESENCE_FLAGS
from tabmill.functions.checks import col, present, require_columns


def or_zero(name: str) -> Column:
    return F.coalesce(col(name), F.lit(0))


def difference(left: str, right: str) -> Column:
    """``left - right``; a missing operand stays missing."""
    return col(left) - col(right)


def differs(left: str, right: str) -> Column:
    """1 unless both are present and equal: a missing operand counts as different."""
    return F.coalesce(col(left) != col(right), F.lit(True)).cast("int")


def weighted_sum(weights: Mapping[str, float], fill_missing: bool = True) -> Column:
    """Sum of weighted columns, missing parts as 0 (or missing as a whole)."""
    value = or_zero if fill_missing else col
    terms = [value(c) if w == 1.0 else F.lit(w) * value(c) for c, w in weights.items()]
    return reduce(add, terms)


def is_positive(name: str) -> Column:
    return (or_zero(name) > 0).cast("int")


def product(left: str, right: str) -> Column:
    return or_zero(left) * or_zero(right)


def add_features(
    df: DataFrame,
    floor_area: Mapping[str, float] = FLOOR_AREA,
    baths: Mapping[str, float] = BATHS,
    porches: Mapping[str, float] = PORCHES,
    flags: Mapping[str, str] = PRESENCE_FLAGS,
    fill_missing: bool = True,
) -> DataFrame:
    """All gold features in one projection.

    The summed features need their columns; ages, flags and the interaction are left out where
    a column is absent. ``fill_missing=False`` is the exploration variant: sums stay missing,
    and neither flags nor the interaction exist.
    """
    sums = {"TotalSF": floor_area, "TotalBath": baths, "TotalPorchSF": porches}
    for weights in sums.values():
        require_columns(df, weights, "feature input")

    def have(*names: str) -> bool:
        return len(present(df, names)) == len(names)

    new: dict[str, Column] = {}
    if have("YrSold", "YearBuilt"):
        new["HouseAge"] = difference("YrSold", "YearBuilt")
    if have("YrSold", "YearRemodAdd"):
        new["RemodAge"] = difference("YrSold", "YearRemodAdd")
    if fill_missing and have("YearRemodAdd", "YearBuilt"):
        new["IsRemodeled"] = differs("YearRemodAdd", "YearBuilt")
    new |= {name: weighted_sum(weights, fill_missing) for name, weights in sums.items()}
    if fill_missing:
        new |= {name: is_positive(c) for name, c in flags.items() if have(c)}
        if have("OverallQual", "GrLivArea"):
            new["QualSF"] = product("OverallQual", "GrLivArea")
    return df.withColumns(new)
