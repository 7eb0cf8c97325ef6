from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tabmill.functions import targets, times


@pytest.mark.parametrize(
    "raw, expected",
    [
        (None, None),
        (10**9 - 1, None),
        (10**9, datetime(2001, 9, 9, 1, 46, 40)),
        (10**12 - 1, "far"),
        (10**12, datetime(2001, 9, 9, 1, 46, 40)),
        (10**15 - 1, "far"),
        (10**15, datetime(2001, 9, 9, 1, 46, 40)),
        (10**18, datetime(2001, 9, 9, 1, 46, 40)),
        (10**18 + 1999, datetime(2001, 9, 9, 1, 46, 40, 1)),
        (-5, None),
    ],
)
def test_epoch_unit_by_magnitude(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "v bigint").select(times.epoch_to_timestamp(F.col("v")).alias("t"))
    if expected == "far":
        assert df.selectExpr("year(t) > 9999 AS far").first()["far"]
    else:
        text = df.selectExpr("cast(t AS string) AS t").first()["t"]
        assert text == (None if expected is None else str(expected))


def test_stated_unit(spark):
    df = spark.createDataFrame([(86400,)], "v bigint").select(times.epoch_to_timestamp(F.col("v"), "s").alias("t"))
    assert df.selectExpr("cast(t AS string) AS t").first()["t"] == "1970-01-02 00:00:00"


def test_load_time_of_either_type(spark):
    df = spark.sql("SELECT 1000000000L AS a, timestamp '2001-09-09 01:46:40' AS b")
    r = df.select(times.load_timestamp(df, "a").alias("a"), times.load_timestamp(df, "b").alias("b")).first()
    assert r["a"] == r["b"]


@pytest.mark.parametrize("version, good", [("20240131_235959", True), ("manual-run", False), ("20241331_000000", False), ("", False), (None, False)])
def test_run_version(spark, version, good):
    df = spark.createDataFrame([(version,)], "v string").select(times.run_timestamp(F.col("v")).alias("t"))
    back = df.select(times.run_version(F.col("t")).alias("v")).first()["v"]
    assert back == (version if good else None)


@pytest.mark.parametrize(
    "y, label, order",
    [
        (None, "500k+", 6), (-1.0, "0-100k", 0), (99999.99, "0-100k", 0), (100000.0, "100k-150k", 1), (199999.0, "150k-200k", 2),
        (200000.0, "200k-300k", 3), (399999.0, "300k-400k", 4), (499999.0, "400k-500k", 5), (500000.0, "500k+", 6),
    ],
)
def test_buckets(spark, y, label, order):
    df = spark.createDataFrame([(y,)], "y double")
    r = df.select(targets.bucket_label(F.col("y")).alias("l"), targets.bucket_order(F.col("y")).alias("o")).first()
    assert (r["l"], r["o"]) == (label, order)


def test_relative_error_is_guarded(spark):
    df = spark.createDataFrame([(0.0, 3.0), (200.0, 100.0)], "y double, p double").coalesce(1)
    got = [r["e"] for r in df.select(targets.rel_error(F.col("y"), F.col("p")).alias("e")).collect()]
    assert got == [3.0, 0.5]


def test_rows_without_prediction(spark):
    df = spark.sql("SELECT * FROM VALUES (1.0D), (cast('NaN' AS double)), (NULL) t(p)")
    assert df.where(targets.has_prediction(F.col("p"))).count() == 1


def test_log_target_round_trip(spark):
    df = spark.range(1, 1000).select((F.col("id") * 997.0).alias("y"))
    error = F.abs(targets.LOG_TARGET.inverse(targets.LOG_TARGET.forward(F.col("y"))) - F.col("y"))
    assert df.agg(F.max(error / F.col("y")).alias("m")).first()["m"] < 1e-12


def test_stable_id_repeats(spark):
    df = spark.range(3).select(targets.stable_id(F.col("id"), F.lit("v")).alias("k"))
    assert df.collect() == df.collect() and df.distinct().count() == 3
