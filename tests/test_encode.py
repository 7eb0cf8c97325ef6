import statistics

import pytest
from pyspark.sql import functions as F

from tabmill.defaults import MISSING_CATEGORY
from tabmill.operators import encode, metrics, profile


@pytest.fixture(scope="module")
def colours(spark):
    data = ["red"] * 12 + ["blue"] * 10 + ["green"] * 9 + ["teal"] + [None] * 11
    return spark.createDataFrame([(i, c) for i, c in enumerate(data)], "id int, c string")


def test_levels(colours):
    kept = {r["value"]: (r["n"], r["kept"]) for r in encode.levels(colours, ["c"], 10).collect()}
    assert kept == {
        "red": (12, True), "blue": (10, True), "green": (9, False), "teal": (1, False), MISSING_CATEGORY: (11, True)
    }
    shares = {r["value"] for r in encode.levels(colours, ["c"], 0.22).where("kept").collect()}
    assert shares == {"red", "blue", MISSING_CATEGORY} - ({"blue"} if 10 < 43 * 0.22 else set())


def test_rare_unseen_and_missing(spark, colours):
    table = encode.levels(colours, ["c"], 10)
    new = spark.createDataFrame([(1, "red"), (2, "teal"), (3, "pink"), (4, None)], "id int, c string")
    got = {r["id"]: r["c"] for r in encode.group_rare(new, table, ["c"]).collect()}
    assert got == {1: "red", 2: encode.INFREQUENT, 3: None, 4: MISSING_CATEGORY}
    wide = {r["id"]: r for r in encode.one_hot(new, table, ["c"]).collect()}
    flags = [c for c in wide[1].asDict() if c != "id"]
    assert len(flags) == 4 and sum(wide[3][f] for f in flags) == 0
    assert all(sum(wide[i][f] for f in flags) == 1 for i in (1, 2, 4)) and wide[2]["c_rare"] == 1
    with pytest.raises(ValueError, match="more than 2 kept levels"):
        encode.one_hot(new, table, ["c"], max_levels=2)


def test_names_of_levels_do_not_clash(spark):
    rows = [(i, "b_c" if i % 2 else "infrequent", "c", "rare" if i == 0 else "often") for i in range(20)]
    df = spark.createDataFrame(rows, "id int, a string, a_b string, k string")
    table = encode.levels(df, ["a", "a_b"], 1).union(encode.levels(df, ["k"], 2))
    wide = encode.one_hot(df, table, ["a", "a_b", "k"])
    assert sorted(wide.columns) == sorted(["id", "a_is_b_c", "a_is_infrequent", "a__b_is_c", "k_is_often", "k_rare"])
    first = wide.where("id = 0").first()
    assert (first["a_is_infrequent"], first["a__b_is_c"], first["k_is_often"], first["k_rare"]) == (1, 1, 0, 1)
    with pytest.raises(ValueError, match="names already"):
        encode.one_hot(df.withColumn("k_rare", df["id"]), table, ["a", "a_b", "k"])
    marker = spark.createDataFrame([(encode.INFREQUENT,)] * 3, "c string")
    with pytest.raises(ValueError, match="marks rare levels"):
        encode.group_rare(marker, encode.levels(marker, ["c"], 1), ["c"])


def test_a_frequent_level_is_not_joined_by(spark):
    rows = [("often",)] * 900 + [(f"rare{i}",) for i in range(100)]
    df = spark.createDataFrame(rows, "c string")
    table = encode.levels(df, ["c"], 10)
    probes = encode._with_rare(df, "c", ["often"], table.where("not kept").selectExpr("value AS _value"))
    assert probes.where("_value is not null").count() == 100
    got = {r["c"]: r["count"] for r in encode.group_rare(df, table, ["c"]).groupBy("c").count().collect()}
    assert got == {"often": 900, encode.INFREQUENT: 100}


def test_scale_statistics(spark):
    df = spark.createDataFrame([(i % 2, float(i), 7.0) for i in range(10)], "fold int, x double, k double")
    got = {(r["fold"], r["column"]): (r["mean"], r["std"]) for r in encode.scale_statistics(df, ["x", "k"], "fold", 2).collect()}
    odd = [float(i) for i in range(1, 10, 2)]
    assert got[(0, "x")] == pytest.approx((statistics.mean(odd), statistics.pstdev(odd)))
    assert got[(1, "k")] == (7.0, 1.0)


def test_imputation_uses_the_other_folds(spark):
    df = spark.createDataFrame([(0, 1.0), (0, None), (1, 10.0), (1, 20.0), (1, None)], "fold int, x double")
    got = sorted((r["fold"], r["x"]) for r in encode.impute_by_fold(df, ["x"]).collect())
    assert got == [(0, 1.0), (0, 15.0), (1, 1.0), (1, 10.0), (1, 20.0)]


def test_held_out_rows_do_not_change_their_statistics(spark):
    base = [(f, float(10 * f + i)) for f in range(3) for i in range(5)]
    before = {r["fold"]: r["median"] for r in encode.fold_medians(spark.createDataFrame(base, "fold int, x double"), ["x"]).collect()}
    changed = [(f, 1e6 if f == 0 else x) for f, x in base]
    after = {r["fold"]: r["median"] for r in encode.fold_medians(spark.createDataFrame(changed, "fold int, x double"), ["x"]).collect()}
    assert before[0] == after[0] and before[1] != after[1] and before[2] != after[2]


def test_global_imputation(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (3.0, "a"), (10.0, "b"), (None, None)], "x double, s string")
    row = encode.impute_global(df, ["x"], ["s"]).where("x NOT IN (1, 2, 3, 10)").first()
    assert (row["x"], row["s"]) == (2.5, "a")


def test_profile(spark):
    df = spark.createDataFrame([("1", "b", None), ("x", "a", None), ("2", "a", 1), (None, "b", 2)], "m string, s string, n int")
    assert {r["column"]: r["nulls"] for r in profile.null_counts(df).collect()} == {"m": 1, "s": 0, "n": 2}
    assert [r["column"] for r in profile.columns_with_nulls(df).collect()] == ["n", "m"]
    assert profile.total_nulls(df).first()["nulls"] == 3
    assert [r["column"] for r in profile.mixed_content(df).collect()] == ["m"]
    assert {r["column"]: r["mode"] for r in profile.modes(df, ["s", "m"]).collect()} == {"s": "a", "m": "1"}
    assert profile.string_summary(df, ["s"]).first().asDict() == {"column": "s", "count": 4, "unique": 2, "top": "a", "freq": 2}
    assert profile.type_counts(df) == {"string": 2, "int": 1}
    assert {r["column"]: (r["type"], r["non_null"]) for r in profile.column_info(df).collect()}["n"] == ("int", 2)


def test_r2_is_not_squared_correlation(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0), (3.0, 7.0)], "y double, p double")
    got = df.agg(metrics.r2(F.col("y"), F.col("p")).alias("r2"), F.regr_r2("y", "p").alias("corr2")).first()
    assert got["corr2"] == pytest.approx(1.0) and got["r2"] == pytest.approx(1 - (4 + 9 + 16) / 2)


def test_cv_mean_is_the_mean_of_the_folds(spark):
    df = spark.createDataFrame([(0, 0.0, 1.0), (1, 0.0, 3.0), (1, 0.0, 3.0)], "fold int, y double, p double")
    r = metrics.fold_summary(df, "y", "p", "fold").first()
    assert (r["cv_rmse_mean"], r["cv_rmse_std"]) == (2.0, 1.0)


def test_any_number_of_kept_levels_is_grouped(spark):
    seen = spark.createDataFrame([(v,) for v in "aaabbbccdde"], "c string")
    table = encode.levels(seen, ["c"], 2)
    new = spark.createDataFrame([(v,) for v in "aabcdex"], "c string")
    for most in (4, 1):
        got = [r["c"] for r in encode.group_rare(new, table, ["c"], max_levels=most).collect()]
        assert sorted(got, key=str) == sorted(["a", "a", "b", "c", "d", encode.INFREQUENT, None], key=str)
