"""Target transforms, prediction errors and value buckets."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabmill.defaults import PRICE_CUTS, PRICE_REST


@dataclass(frozen=True)
class TargetTransform:
    """A function applied to the label before fitting and its inverse for predictions."""

    forward: Callable[[Column], Column]
    inverse: Callable[[Column], Column]


LOG_TARGET = TargetTransform(F.log1p, F.expm1)
RAW_TARGET = TargetTransform(lambda c: c, lambda c: c)


def abs_error(actual: Column, predicted: Column) -> Column:
    return F.abs(actual - predicted)


def rel_error(actual: Column, predicted: Column, floor: float = 1.0) -> Column:
    """Absolute error relative to the actual value, which counts as ``floor`` at least."""
    return abs_error(actual, predicted) / F.greatest(actual, F.lit(floor))


def bucket_label(value: Column, cuts: Sequence[tuple[float, str]] = PRICE_CUTS, rest: str = PRICE_REST) -> Column:
    """Label of the first cut above the value; everything else, NULL included, is ``rest``."""
    expr = F.when(value < cuts[0][0], cuts[0][1])
    for cut, label in cuts[1:]:
        expr = expr.when(value < cut, label)
    return expr.otherwise(rest)


def bucket_order(value: Column, cuts: Sequence[tuple[float, str]] = PRICE_CUTS) -> Column:
    expr = F.when(value < cuts[0][0], 0)
    for i, (cut, _) in enumerate(cuts[1:], start=1):
        expr = expr.when(value < cut, i)
    return expr.otherwise(len(cuts))


def has_prediction(predicted: Column) -> Column:
    return predicted.isNotNull() & ~F.isnan(predicted)


def stable_id(*parts: Column) -> Column:
    """A row identifier that a retried task computes again unchanged."""
    return F.sha2(F.concat_ws("|", *parts), 256)
