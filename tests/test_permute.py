"""Importances by changed places, against a plain loop on a linear model."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tabmill.ml import permute
from tabmill.ml.regressors import linear_regression

SCHEMA = "k string, a double, b double, c string, y double"


def linear(df):
    return df.withColumn("prediction", 3 * F.coalesce(F.col("a"), F.lit(0.0)) - F.col("b") + F.length("c"))


def predicted(a, b, c):
    return 3 * (a or 0.0) - b + len(c)


def rows(n, rng):
    made = []
    for i in range(n):
        a, b, c = rng.choice([None, rng.uniform(-1, 1)]), rng.uniform(-1, 1), "x" * rng.randrange(3)
        made.append((f"k{i}", a, b, c, predicted(a, b, c) + rng.gauss(0, 0.1)))
    return made


def plain(data, together):
    """feature -> growth of the RMSE, row by row."""
    n_buckets = max(1, -(-len(data) // together))
    buckets = {}
    for r in data:
        digest = hashlib.md5(f"{r[0]}42:pairs".encode()).hexdigest()
        buckets.setdefault(int(digest[:8], 16) % n_buckets, []).append((digest, r))
    errors = {-1: [], 1: [], 2: [], 3: []}
    for found in buckets.values():
        found.sort()
        for i, (_, r) in enumerate(found):
            other = found[(i + 1) % len(found)][1]
            for at in errors:
                swapped = [other[j] if j == at else r[j] for j in (1, 2, 3)]
                errors[at].append((r[4] - predicted(*swapped)) ** 2)
    rmse = {at: (sum(e) / len(e)) ** 0.5 for at, e in errors.items()}
    return {name: (rmse[at], rmse[at] - rmse[-1]) for at, name in ((1, "a"), (2, "b"), (3, "c"))}


@pytest.mark.parametrize("together", [10_000, 50])
@pytest.mark.parametrize("parts", [1, 7])
def test_equal_to_a_plain_loop(spark, together, parts):
    data = rows(400, random.Random(1))
    df = spark.createDataFrame(data, SCHEMA).repartition(parts)
    found = permute.permutation_importances(linear, df, "y", ["a", "b", "c"], "k", rows_together=together).collect()
    expected = plain(data, together)
    assert {r["feature"]: (r["rmse"], r["importance"]) for r in found} == {c: pytest.approx(v) for c, v in expected.items()}
    assert {r["n"] for r in found} == {400}


def test_every_row_is_the_partner_of_one(spark):
    # keys that repeat or miss, and equal rows
    data = [(None if i % 3 == 0 else f"k{i % 5}", float(i % 20), 1.0, "x", 1.0) for i in range(600)]
    df = spark.createDataFrame(data, SCHEMA)
    out = permute.paired(df, ["a", "b"], "k", rows_together=40)
    given = sorted(r["_partner_row"]["c0"] for r in out.collect())
    assert given == sorted(r[1] for r in data)


def test_a_fitted_model_and_a_column_without_use(spark):
    rng = random.Random(2)
    data = [(f"k{i}", rng.uniform(0, 9), rng.uniform(0, 9), "x", 0.0) for i in range(500)]
    df = spark.createDataFrame([(k, a, b, c, 4 * a) for k, a, b, c, _ in data], SCHEMA)
    model = linear_regression("y", exclude=["k"]).fit(df)
    found = {r["feature"]: r["importance"] for r in permute.permutation_importances(model, df, "y", ["a", "b", "c"], "k").collect()}
    assert found["a"] > 5 and abs(found["b"]) < 1e-3 and abs(found["c"]) < 1e-3


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert [tuple(r) for r in permute.permutation_importances(linear, empty, "y", ["a"], "k").collect()] == [("a", 0, None, None)]
    one = spark.createDataFrame([("k", 1.0, 1.0, "x", 3.0), ("l", 1.0, 1.0, "x", None)], SCHEMA)
    assert [tuple(r) for r in permute.permutation_importances(linear, one, "y", ["a"], "k").collect()] == [("a", 1, 0.0, 0.0)]
    with pytest.raises(ValueError, match="_turn"):
        permute.permutation_importances(linear, one.withColumn("_turn", F.lit(1)), "y", ["a"], "k")
