import math

import pytest
from pyspark.sql import functions as F

from tabmill.defaults import MISSING_TOKENS
from tabmill.functions.checks import require_columns
from tabmill.functions.missing import (
    fill_not_present, fill_zero, infer_types, nan_to_null, normalize_missing, treat_missing,
)
from tabmill.sources.readers import read_csv, read_features, read_optional
from tests.plans import physical


def values(df, column):
    return [r[column] for r in df.select(F.col(f"`{column}`")).collect()]


def test_every_token_is_missing(spark):
    df = spark.createDataFrame([(t,) for t in [*MISSING_TOKENS, "NaN", "NAN", "none", "x"]], "v string").coalesce(1)
    assert values(normalize_missing(df), "v") == [None] * 6 + ["NAN", "none", "x"]


def test_other_columns_are_left_alone(spark):
    df = spark.createDataFrame([("NA", "NA", 1)], "a string, b string, n int")
    row = normalize_missing(df, columns=["a", "absent"]).first()
    assert (row["a"], row["b"], row["n"]) == (None, "NA", 1)


@pytest.mark.parametrize(
    "texts, expected",
    [
        (["1", "-2", "+3"], "bigint"),
        (["1", None], "double"),
        (["1", "2.5"], "double"),
        (["1e3", ".5", "7.", "-inf"], "double"),
        (["9223372036854775807"], "bigint"),
        (["9223372036854775808", "1"], "double"),
        (["True", "false"], "boolean"),
        (["True", None], "string"),
        (["5D", "3F"], "string"),
        (["0x1p3"], "string"),
        (["2020-01-01"], "string"),
        (["1", "x"], "string"),
        (["+", "-"], "string"),
        ([None, None], "double"),
    ],
)
def test_inferred_type(spark, texts, expected):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    assert dict(infer_types(df).dtypes)["v"] == expected


def test_integers_may_stay_nullable(spark):
    df = spark.createDataFrame([("1",), (None,)], "v string")
    out = infer_types(df, widen_nullable=False)
    assert dict(out.dtypes)["v"] == "bigint" and sorted(values(out, "v"), key=str) == [1, None]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(math.nan,), (1.0,)], "v double").coalesce(1)
    assert values(nan_to_null(df), "v") == [None, 1.0]


def test_none_is_missing_first_and_a_level_later(spark):
    df = spark.createDataFrame([("None", "None")], "PoolQC string, MasVnrType string")
    row = treat_missing(normalize_missing(df)).first()
    assert (row["PoolQC"], row["MasVnrType"]) == ("None", None)


def test_fills_skip_absent_columns(spark):
    df = spark.createDataFrame([(1, None)], "x int, GarageYrBlt double")
    assert fill_zero(fill_not_present(df)).first()["GarageYrBlt"] == 0.0
    # an all-missing column arrives as a number and is still filled with the level
    assert fill_not_present(spark.createDataFrame([(None,)], "Alley double")).first()["Alley"] == "None"


def test_required_columns(spark):
    with pytest.raises(ValueError, match="B, C"):
        require_columns(spark.range(1).select(F.col("id").alias("A")), ["A", "B", "C"])


def test_csv_scan(spark, tmp_path):
    (tmp_path / "t.csv").write_text('Id,1stFlrSF,Name,Flag\n1,10,"a, b",True\n2,NA,N/A,False\n3,30,None,True\n')
    df = read_csv(spark, str(tmp_path / "t.csv"))
    assert df.dtypes == [("Id", "bigint"), ("1stFlrSF", "double"), ("Name", "string"), ("Flag", "boolean")]
    assert [tuple(r) for r in df.orderBy("Id").collect()] == [
        (1, 10.0, "a, b", True), (2, None, None, False), (3, 30.0, None, True)
    ]
    typed = read_csv(spark, str(tmp_path / "t.csv"), "Id int, Name string")
    assert typed.dtypes == [("Id", "int"), ("Name", "string")]
    assert read_features(spark, str(tmp_path / "t.csv")).count() == 3


def test_optional_inputs(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "a"))
    assert list(read_optional(spark, {"a": str(tmp_path / "a"), "b": str(tmp_path / "b")})) == ["a"]


def test_no_python_in_the_plan(spark, sf):
    from workload.features import _bronze
    from tabmill.plans import layers

    plan = physical(layers.gold(layers.silver(_bronze(spark, sf))))
    assert "EvalPython" not in plan and "Exchange" not in plan
