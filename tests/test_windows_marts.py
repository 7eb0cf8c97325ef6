import random

import pytest
from pyspark.sql import functions as F

from tabmill.operators import choose, windows
from tabmill.plans import marts
from tests.plans import physical
from workload.fixtures import fixture

MODELS = (
    "id string, name string, version string, is_champion boolean, cv_rmse_mean double, cv_rmse_std double, rmse_test double,"
    " r2_test double, created_at_utc timestamp, file_path string"
)


def models(spark, *rows):
    """(id, version, flag, rmse, time)"""
    full = [(i, f"n{i}", v, flag, rmse, None, None, None, at, None) for i, v, flag, rmse, at in rows]
    schema = MODELS.replace("created_at_utc timestamp", "created_at_utc bigint")
    return spark.createDataFrame(full, schema)


def test_latest_row_wins_and_missing_time_loses(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), ("b", None, "q")], "k string, t int, v string")
    got = {r["k"]: r["v"] for r in windows.dedup_latest(df, ["k"], "t").collect()}
    assert got == {"a": "y", "b": "q"}


def test_ties_do_not_depend_on_the_layout(spark):
    rows = [("a", 1, f"v{i}") for i in range(50)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, t int, v string")
    assert {windows.dedup_latest(df.repartition(n), ["k"], "t").first()["v"] for n in (1, 3, 8)} == {"v0"}


@pytest.mark.parametrize("n", [1, 3, 1500])
def test_top_rows_of_a_hot_group(spark, n):
    df = spark.range(3000).select((F.col("id") % 3 == 0).alias("hot"), F.col("id").alias("v"))
    df = df.withColumn("g", F.when(F.col("hot"), F.lit(0)).otherwise(F.col("v") % 50 + 1))
    got = windows.top_per_group(df, ["g"], [F.col("v").desc()], n)
    hot = [r["v"] for r in got.where("g = 0").orderBy(F.desc("v")).collect()]
    assert hot == sorted(range(0, 3000, 3), reverse=True)[:n]
    assert got.groupBy("g").count().agg(F.max("count").alias("m")).first()["m"] == min(n, 1000)


def test_groups_are_limited_before_the_shuffle(spark, sf):
    plan = physical(marts.core_cv_predictions(fixture(spark, sf, "cv"), ["y_pred_oof"]))
    limit_below = plan.index("WindowGroupLimit", plan.index("Exchange hashpartitioning"))
    assert limit_below > 0 and "SinglePartition" not in plan and "EvalPython" not in plan


def test_champion_order(spark):
    core = marts.core_models(
        models(
            spark, ("a", "v1", True, 9.0, 10**9), ("b", "v1", False, 1.0, 10**9), ("c", "v2", None, 2.0, 10**9),
            ("d", "v2", False, 5.0, 10**9), ("e", "v3", False, None, 10**9), ("f", "v3", False, 1.0, 10**9),
        )
    )
    got = {r["version"]: r["model_id"] for r in marts.champion_by_run(core).collect()}
    # flag first; a false flag before a missing one; a missing error before any number
    assert got == {"v1": "a", "v2": "d", "v3": "e"}


def test_bad_run_version_keeps_its_row(spark):
    core = marts.core_models(models(spark, ("a", "manual", True, 1.0, 10**9), ("b", "20240131_000000", True, 1.0, None)))
    rows = {r["id"]: r for r in core.collect()}
    assert rows["a"]["run_ts"] is None and rows["a"]["created_at_utc"] is not None
    assert str(rows["b"]["run_date"]) == "2024-01-31"


def test_latest_champion_uses_load_time_where_the_version_is_no_time(spark):
    core = marts.core_models(models(spark, ("a", "manual", True, 1.0, 1_700_000_000), ("b", "20200131_000000", True, 1.0, 1_800_000_000)))
    assert marts.latest_champion(marts.champion_by_run(core)).first()["model_id"] == "a"


def test_predictions_of_the_champion_are_joined_before_the_shuffle(spark, sf):
    champions = marts.champion_by_run(marts.core_models(fixture(spark, sf, "models"), ["cv_rmse_mean"]))
    predictions = fixture(spark, sf, "predictions")
    quick = marts.predictions_latest_champion(predictions, champions, ["predicted_price"])
    slow = marts.core_predictions(predictions, ["predicted_price"]).join(
        marts.latest_champion(champions), ["model_id", "model_version"]
    )
    assert sorted(quick.select("kaggle_id", "predicted_price").collect()) == sorted(slow.select("kaggle_id", "predicted_price").collect())
    plan = physical(quick)
    assert "BroadcastHashJoin" in plan and plan.index("Window ") < plan.index("BroadcastHashJoin")


def test_resolve_model(spark):
    df = spark.createDataFrame(
        [("1", "x", False, 5, "p1"), ("2", "x", True, 3, None), ("3", "y", None, None, "p3")],
        "id string, name string, is_champion boolean, created_at_utc int, file_path string",
    )
    pick = lambda **k: choose.resolve_model(df, **k).first()["id"]
    assert pick() == "2"
    assert pick(name="x") == "1" and pick(model_id="3") == "3"
    no_champion = df.where("id <> '2'")
    assert choose.resolve_model(no_champion).first()["id"] == "3"  # a missing time counts as latest
    assert choose.resolve_model(no_champion, missing_wins=False).first()["id"] == "1"
    assert choose.resolve_model(no_champion.drop("is_champion")).first()["id"] == "3"
    with pytest.raises(ValueError, match="no stored artefact"):
        choose.resolved_model(df)
    with pytest.raises(ValueError, match="no stored model"):
        choose.resolved_model(df, name="z")


def test_first_configuration_wins_ties(spark):
    df = spark.createDataFrame([("b", 1.0, 1), ("a", 1.0, 2), ("c", None, 0)], "id string, cv_rmse_mean double, ordinal int")
    assert choose.best_model(df, ordinal="ordinal").first()["id"] == "b"
    flags = {r["id"]: r["is_champion"] for r in choose.mark_champion(df, ordinal="ordinal").collect()}
    assert flags == {"a": False, "b": True, "c": False}


def test_catalog_views_push_the_champion_below_the_window(spark, sf, tmp_path):
    from tabmill.plans.views import apply_views
    from tabmill.sources.sinks import ensure_namespace, overwrite_table

    ensure_namespace(spark, "v_raw")
    for name, source in (("models", "models"), ("train_cv_predictions", "cv"), ("predictions", "predictions")):
        overwrite_table(fixture(spark, sf, source), f"v_raw.{name}", path=str(tmp_path / name))
    names = apply_views(spark, "v_raw", "v_core", "v_marts")
    assert apply_views(spark, "v_raw", "v_core", "v_marts") == names and len(names) == 10
    for name in names:
        assert spark.table(name).count() > 0
    plan = physical(spark.table("v_marts.predictions_latest_champion"))
    assert plan.index("Window ") < plan.index("BroadcastHashJoin") and "SinglePartition" not in plan
    marts_columns = marts.cv_error_by_bucket(marts.core_cv_predictions(spark.table("v_raw.train_cv_predictions"))).columns
    assert set(spark.table("v_marts.cv_error_by_bucket").columns) == set(marts_columns)
