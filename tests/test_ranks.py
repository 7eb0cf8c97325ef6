"""Order statistics against brute force, on ugly data and on every path of the search."""

import math
import random
import statistics
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabmill.operators.folds import assign_folds, contiguous_folds, mark_holdout
from tabmill.operators.ranks import medians, values_at_ranks
from workload.fixtures import fixture

PATHS = [
    {},  # counted by value in one buffer
    {"buffer_up_to": 0},  # counted by value, chosen by running counts
    {"buffer_up_to": 0, "count_up_to": 3, "bins": 4},  # many rounds of narrowing
]


def numbers(n, seed):
    rng = random.Random(seed)
    kinds = [
        lambda: rng.choice([0.0, 0.0, 1.0]), lambda: rng.uniform(-1e-9, 1e-9), lambda: rng.lognormvariate(0, 20),
        lambda: float(rng.randint(-5, 5)), lambda: None,
    ]
    return [rng.choice(kinds)() for _ in range(n)]


@pytest.mark.parametrize("path", PATHS)
@pytest.mark.parametrize("n", [1, 2, 3, 50, 401])
def test_median(spark, path, n):
    data = [(i % 3, numbers(1, i + n)[0], i) for i in range(n)]
    df = spark.createDataFrame(data, "fold int, x double, y int")
    got = medians(df, ["x", "y"], **path)[None]
    present = [x for _, x, _ in data if x is not None]
    assert got["x"] == (statistics.median(present) if present else None)
    assert got["y"] == statistics.median(range(n))


@pytest.mark.parametrize("path", PATHS)
def test_median_of_the_other_folds(spark, path):
    data = [(i % 4, x) for i, x in enumerate(numbers(200, 7))]
    df = spark.createDataFrame(data, "fold int, x double").repartition(8)
    got = medians(df, ["x"], leave_out="fold", **path)
    for f in range(4):
        assert got[f]["x"] == statistics.median([x for g, x in data if g != f and x is not None])


@pytest.mark.parametrize("path", PATHS)
def test_infinite_and_nan(spark, path):
    data = [math.inf, -math.inf, math.nan, 1.0, 2.0, 3.0, math.inf]
    got = medians(spark.createDataFrame([(x,) for x in data], "x double"), ["x"], **path)[None]
    assert got["x"] == statistics.median([x for x in data if not math.isnan(x)])


def test_no_values(spark):
    assert medians(spark.createDataFrame([(None,)], "x double"), ["x"]) == {None: {"x": None}}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=60), st.data())
def test_values_at_ranks_of_wide_integers(spark, data, draw):
    ranks = draw.draw(st.lists(st.integers(0, len(data) - 1), min_size=1, max_size=4, unique=True))
    df = spark.createDataFrame([(x,) for x in data], "x bigint")
    assert values_at_ranks(df, "x", ranks, bins=8, count_up_to=2) == [sorted(data)[r] for r in ranks]


def test_one_value_holds_a_third_of_the_rows(spark):
    data = [5.0] * 400 + [float(i) / 7 for i in range(800)]
    df = spark.createDataFrame([(x,) for x in data], "x double")
    for path in PATHS:
        assert medians(df, ["x"], **path)[None]["x"] == statistics.median(data)


@pytest.mark.parametrize("n, k", [(10, 3), (7, 5), (3, 5), (1, 2), (20, 4)])
def test_contiguous_folds(spark, n, k):
    df = spark.createDataFrame([(100 - 3 * i,) for i in range(n)], "id bigint")
    got = [r["fold"] for r in contiguous_folds(df, "id", k).orderBy("id").collect()]
    expected = [f for f in range(k) for _ in range(n // k + (1 if f < n % k else 0))]
    assert got == expected


def test_folds_are_a_partition_whatever_the_layout(spark):
    ids = spark.range(2000)
    one = assign_folds(ids.coalesce(1), "id").orderBy("id").collect()
    many = assign_folds(ids.repartition(8), "id").orderBy("id").collect()
    assert one == many and {r["fold"] for r in one} == set(range(5))
    other = assign_folds(ids, "id", seed=43).orderBy("id").collect()
    assert other != one


def test_holdout_is_independent_of_folds(spark):
    both = mark_holdout(assign_folds(spark.range(5000), "id"), "id")
    shares = [r["s"] for r in both.groupBy("fold").agg({"is_holdout": "count"}).selectExpr("`count(is_holdout)` AS s").collect()]
    held = both.where("is_holdout").groupBy("fold").count().collect()
    assert all(800 < s < 1200 for s in shares) and all(150 < r["count"] < 260 for r in held)


def test_rows_without_key_are_spread_by_named_columns(spark):
    rows = spark.range(1000).select(F.lit(None).cast("long").alias("k"), "id")
    assert len(assign_folds(rows, "k").select("fold").distinct().collect()) == 1
    assert len(assign_folds(rows, "k", spread_by=["id"]).select("fold").distinct().collect()) == 5
    assert mark_holdout(rows, "k", spread_by=["id"]).select("is_holdout").distinct().count() == 2


def test_fold_medians_of_an_unstored_wide_table_are_planned_quickly(spark, sf):
    began = time.perf_counter()
    folded = assign_folds(fixture(spark, sf, "houses"), "Id").where("fold != 1 and GrLivArea is not null and GarageArea is not null")
    folded.groupBy("fold").count()._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - began < 5
