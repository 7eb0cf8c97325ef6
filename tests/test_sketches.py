"""Medians from sketches against exact ranks."""

import random
import statistics

from tabmill.operators import encode, sketches

SCHEMA = "fold int, x double, y double, z string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def others(rows, fold, at):
    return sorted(r[at] for r in rows if r[0] is not None and r[0] != fold and r[at] is not None and r[at] == r[at])


def test_small_parts_are_exact(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(4), rng.choice([None, float("nan"), rng.uniform(-9, 9)]), None, "a") for _ in range(300)] + [(None, 1e9, 1.0, None)]
    found = {(r["fold"], r["column"]): (r["n"], r["median"]) for r in sketches.fold_medians(table(spark, rows), ["x", "y"]).collect()}
    assert len(found) == 8
    for f in range(4):
        left = others(rows, f, 1)
        assert found[f, "x"] == (len(left), statistics.median_low(left))
        assert found[f, "y"] == (0, None)


def test_ranks_lie_within_the_stated_error(spark):
    size = 100
    rng = random.Random(4)
    # one fold holds a third of the rows, one value a quarter
    rows = [(rng.choice([0, 0, 1, 2, 3, 4]), rng.choice([7.0, rng.gauss(0, 50), rng.gauss(0, 50), rng.gauss(900, 1)]), float(i), "a") for i in range(30_000)]
    df = table(spark, rows).repartition(16)
    for r in sketches.fold_medians(df, ["x", "y"], size=size).collect():
        left = others(rows, r["fold"], 1 if r["column"] == "x" else 2)
        assert r["n"] == len(left)
        below, upto = sum(v < r["median"] for v in left), sum(v <= r["median"] for v in left)
        wide = 2 * sketches.rank_error(size) * len(left)
        assert below <= len(left) / 2 + wide and upto >= len(left) / 2 - wide


def test_the_option_fills_with_the_lower_middle_value_of_small_parts(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(3), rng.choice([None, float(rng.randrange(50))]), 1.0, str(i)) for i in range(200)]
    df = table(spark, rows)
    filled = {r["z"]: r["x"] for r in encode.impute_by_fold(df, ["x"], sketch=500).collect()}
    fills = [statistics.median_low(others(rows, f, 1)) for f in range(3)]
    assert filled == {z: fills[f] if x is None else x for f, x, _, z in rows}


def test_edges(spark):
    assert sketches.fold_medians(table(spark, []), ["x"]).collect() == []
    alone = table(spark, [(0, 1.0, 2.0, "a")])
    assert [tuple(r) for r in sketches.fold_medians(alone, ["x"]).collect()] == [(0, "x", 0, None)]
    plan = sketches.fold_sketches(table(spark, []), ["x", "y"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_kll" in plan
