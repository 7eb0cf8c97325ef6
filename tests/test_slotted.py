"""One-hot slots of many levels against a plain dictionary."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabmill.defaults import MISSING_CATEGORY
from tabmill.operators import encode, slotted

SCHEMA = "id int, a string, b string"


def table(n, rng, unseen=False):
    a = [None, "", "hot", "ä", "x y", *(f"l{i}" for i in range(30))] + (["new"] if unseen else [])
    weights = [3, 2, 40, 4, 5, *([1] * 30)] + ([30] if unseen else [])
    return [(i, rng.choices(a, weights)[0], rng.choice(["p", "q", None])) for i in range(n)]


def plain_slots(rows, least):
    """(column, level) -> slot."""
    slots, free = {}, 0
    for column, at in (("a", 1), ("b", 2)):
        counts = Counter(MISSING_CATEGORY if r[at] is None else r[at] for r in rows)
        kept = sorted((v for v, n in counts.items() if n >= least), key=lambda v: v.encode())
        for level in kept:
            slots[column, level] = free
            free += 1
        rare = [v for v in counts if v not in kept]
        slots.update({(column, v): free for v in rare})
        free += bool(rare)
    return slots, free


@pytest.mark.parametrize("hottest", [0, 3, 1000])
@pytest.mark.parametrize("blocks", [1, 6])
def test_equal_to_a_dictionary(spark, hottest, blocks):
    rng = random.Random(8)
    rows, later = table(500, rng), table(300, rng, unseen=True)
    slots = slotted.slot_table(encode.levels(spark.createDataFrame(rows, SCHEMA), ["a", "b"], 12), ["a", "b"], blocks)
    expected, size = plain_slots(rows, 12)
    assert {(r["column"], r["value"]): r["slot"] for r in slots.collect()} == expected
    out = slotted.one_hot_vectors(spark.createDataFrame(later, SCHEMA), slots, ["a", "b"], hottest)
    assert out.columns == ["id", "features"]
    found = {r["id"]: r["features"] for r in out.collect()}
    assert len(found) == len(later)
    for i, a, b in later:
        levels = [("a", MISSING_CATEGORY if a is None else a), ("b", MISSING_CATEGORY if b is None else b)]
        wanted = sorted(expected[level] for level in levels if level in expected)
        assert found[i].size == size and list(found[i].indices) == wanted and list(found[i].values) == [1.0] * len(wanted)


def test_200000_levels(spark):
    df = spark.range(400_000).select(F.concat(F.lit("level "), F.lpad((F.col("id") % 200_000).cast("string"), 6, "0")).alias("a"), "id")
    slots = slotted.slot_table(encode.levels(df, ["a"], 2), ["a"], 8)
    # texts of equal length, so the number in a level is its slot
    assert slots.agg(F.count("*"), F.count_if(F.col("slot") == F.substring("value", 7, 6).cast("int"))).first()[:] == (200_000, 200_000)
    out = slotted.one_hot_vectors(df, slots, ["a"])
    assert slotted.slot_count(slots) == 200_000
    assert out.where("id in (7, 199999, 200007)").select("id", "features").collect()[0]["features"].size == 200_000
    listed = slotted.slot_lists(df, slots, ["a"])
    assert listed.where(F.col("slots") == F.array((F.col("id") % 200_000).cast("int"))).count() == 400_000


def test_vectors_feed_a_learner(spark):
    from pyspark.ml.regression import LinearRegression

    df = spark.createDataFrame([(i, "uvw"[i % 3], None) for i in range(60)], SCHEMA)
    slots = slotted.slot_table(encode.levels(df, ["a", "b"], 1), ["a", "b"])
    out = slotted.one_hot_vectors(df.withColumn("y", F.when(F.col("a") == "v", 5.0).otherwise(1.0)), slots, ["a", "b"])
    fitted = LinearRegression(labelCol="y", regParam=1e-6).fit(out).transform(out)
    assert fitted.agg(F.max(F.abs(F.col("y") - F.col("prediction")))).first()[0] < 1e-3


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    slots = slotted.slot_table(encode.levels(empty, ["a", "b"], 1), ["a", "b"])
    assert slots.count() == 0 and slotted.slot_count(slots) == 0
    one = slotted.one_hot_vectors(spark.createDataFrame([(1, "x", None)], SCHEMA), slots, ["a", "b"]).first()
    assert one["features"].size == 0 and len(one["features"].indices) == 0
