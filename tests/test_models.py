from datetime import datetime

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tabmill.functions.missing import treat_missing
from tabmill.ml import mlp, prep, regressors
from tabmill.ml.target import TransformedTargetModel
from tabmill.operators import ranks
from tabmill.operators.folds import assign_folds, mark_holdout
from tabmill.plans import layers, training
from tabmill.plans.scoring import score_with_stored

FEATURES = ["GrLivArea", "OverallQual", "GarageArea", "MSZoning", "KitchenQual"]
STAMP = datetime(2024, 1, 31)
SMALL = {
    "forest": {"trees": 5, "max_depth": 6}, "boosting": {"trees": 5, "maxDepth": 3},
    "net": {"maxEpochs": 25, "batchSize": 32, "hidden": (32, 16)},
}


@pytest.fixture(scope="module")
def table(houses):
    """A label that the features explain but for a little noise."""
    df = houses.select("Id", *FEATURES).withColumn(
        "SalePrice",
        F.lit(50000.0) + 40 * F.coalesce("GrLivArea", F.lit(2000)) + 9000 * F.col("OverallQual") + F.col("Id") % 100,
    )
    return df.persist()


def r2(df, label="SalePrice"):
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="r2").evaluate(df)


def dense(df, column="features"):
    return np.array([r[column].toArray() for r in df.orderBy("Id").select(column).collect()])


def test_dense_features(table):
    out = prep.FeaturePrep(exclude=["Id", "SalePrice"], scaleNumeric=True, minFrequency=10).fit(table).transform(table)
    x, names = dense(out), prep.feature_names(out)
    assert x.shape[1] == len(names)
    numbers = [i for i, n in enumerate(names) if n.endswith("_value")]
    assert np.allclose(x[:, numbers].mean(axis=0), 0, atol=1e-9) and np.allclose(x[:, numbers].std(axis=0), 1)
    zones = [i for i, n in enumerate(names) if n.startswith("MSZoning_is")]
    assert len(zones) == 6 and set(x[:, zones].sum(axis=1)) == {1.0}  # five levels and the missing one


def test_rare_and_unseen_levels(spark, table):
    rare = table.withColumn("MSZoning", F.when(F.col("Id") < 3, F.concat(F.lit("rare"), F.col("Id"))).otherwise(F.col("MSZoning")))
    model = prep.FeaturePrep(exclude=["Id", "SalePrice"]).fit(rare)
    assert model.rare["MSZoning"] == 3
    new = rare.where("Id IN (1, 2, 3)").withColumn("MSZoning", F.when(F.col("Id") == 3, "unheard").otherwise(F.col("MSZoning")))
    out = model.transform(new)
    zones = [i for i, n in enumerate(prep.feature_names(out)) if n.startswith("MSZoning_is")]
    x = dense(out)[:, zones]
    assert x.sum(axis=1).tolist() == [1.0, 1.0, 0.0] and (x[0] == x[1]).all()
    assert out.count() == 3


def test_statistics_come_from_training_rows_only(table):
    folded = assign_folds(table, "Id")
    fit = lambda df: prep.FeaturePrep(exclude=["Id", "SalePrice", "fold"]).fit(df.where("fold <> 0")).fills
    changed = folded.withColumn("GrLivArea", F.when(F.col("fold") == 0, 10**6).otherwise(F.col("GrLivArea")))
    assert fit(folded) == fit(changed)


def test_unknown_kind_and_wide_category(spark, table):
    with pytest.raises(ValueError, match="unknown kind"):
        prep.FeaturePrep(kind="sparse")
    wide = table.withColumn("MSZoning", F.col("Id").cast("string"))
    with pytest.raises(ValueError, match="this learner takes"):
        prep.FeaturePrep(kind="hgb_native", exclude=["Id", "SalePrice"]).fit(wide)


def test_native_features_are_nominal(table):
    out = prep.FeaturePrep(kind="hgb_native", exclude=["Id", "SalePrice"]).fit(table).transform(table)
    nominal = out.schema["features"].metadata["ml_attr"]["attrs"]["nominal"]
    assert {a["name"] for a in nominal} == {"MSZoning_level", "KitchenQual_level"}


def test_linear_regression_is_least_squares(table):
    """All levels plus intercept are collinear; predictions are unique all the same."""
    model = regressors.linear_regression("SalePrice", exclude=["Id"]).fit(table)
    out = model.transform(table)
    x = dense(model.model.stages[0].transform(table))
    y = np.array([r[0] for r in table.orderBy("Id").select("SalePrice").collect()])
    a = np.hstack([x, np.ones((len(x), 1))])
    expected = a @ np.linalg.lstsq(a, y, rcond=None)[0]
    got = np.array([r[0] for r in out.orderBy("Id").select("prediction").collect()])
    assert np.abs(got - expected).max() < 1e-3 * y.mean()
    assert np.abs(got - expected).max() < 1.0


@pytest.mark.parametrize("name", ["LinearRegression", "RandomForest", "HistGBR_log", "MLP_log"])
def test_learners_find_the_signal(table, name):
    config = next(c for c in regressors.default_configs("SalePrice", **SMALL) if c.name == name)
    marked = mark_holdout(table, "Id")
    out = training.holdout_predictions(marked, config, ["Id", "SalePrice"])
    assert out.count() == marked.where("is_holdout").count()
    floor = {"LinearRegression": 0.9, "RandomForest": 0.8, "HistGBR_log": 0.3, "MLP_log": 0.5}[name]
    assert r2(out) > floor


def test_default_configurations():
    names = [c.name for c in regressors.default_configs("SalePrice")]
    assert names == [
        "LinearRegression", "LinearRegression_log", "RandomForest", "RandomForest_log", "HistGBR", "HistGBR_log", "MLP", "MLP_log"
    ]
    forest = regressors.random_forest("y").estimator.getStages()[1]
    assert [forest.getOrDefault(p) for p in ("trees", "minLeaf")] == [300, 1] and forest.getOrDefault("maxDepth") > 30
    boost = regressors.boosted_trees("y").estimator.getStages()[1]
    assert [boost.getOrDefault(p) for p in ("trees", "maxDepth", "stepSize", "minLeaf")] == [300, 6, 0.1, 20]


def test_every_id_is_predicted_once_out_of_fold(table):
    folded = assign_folds(table, "Id", 3)
    oof = training.out_of_fold(folded, lambda: regressors.linear_regression("SalePrice", exclude=["Id"]), 3, ["Id", "SalePrice"])
    assert sorted(r["Id"] for r in oof.collect()) == sorted(r["Id"] for r in table.collect())


def test_learners_share_fitted_preprocessing(table):
    preps = training.FittedPreps()
    make = lambda t: regressors.linear_regression("SalePrice", t, ["Id"])
    raw, log = preps.fit(make("raw"), table, "a"), preps.fit(make("log"), table, "a")
    other = preps.fit(make("raw"), table.where("Id % 2 = 0"), "b")
    assert raw.model.stages[0] is log.model.stages[0] and raw.model.stages[0] is not other.model.stages[0]
    alone = make("raw").fit(table)
    a = raw.transform(table).select("Id", "prediction").orderBy("Id").collect()
    b = alone.transform(table).select("Id", "prediction").orderBy("Id").collect()
    assert all(x["prediction"] == pytest.approx(y["prediction"]) for x, y in zip(a, b))


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(0)
    shapes = mlp.layer_shapes(3, (4, 2))
    w = mlp.initial_weights(shapes, 1)
    x, y = rng.normal(size=(6, 3)), rng.normal(size=6)
    grad, sse = mlp.gradient(w, shapes, x, y)
    for i in rng.choice(len(w), 8, replace=False):
        step = np.zeros_like(w)
        step[i] = 1e-6
        up, down = mlp.gradient(w + step, shapes, x, y)[1], mlp.gradient(w - step, shapes, x, y)[1]
        assert grad[i] == pytest.approx((up - down) / 2e-6 / len(x), abs=1e-5)


def test_early_stopping_returns_the_best_weights(spark, table):
    ready = prep.FeaturePrep(exclude=["Id", "SalePrice"], scaleNumeric=True).fit(table).transform(table)
    ready = ready.withColumn("label", F.col("SalePrice") / 1e5)
    net = mlp.MLPRegressor(earlyStopping=True, patience=2, maxEpochs=25, hidden=[8])
    model = net.fit(ready)
    assert len(model.val_losses) <= 25 and min(model.val_losses) < model.val_losses[0]
    with pytest.raises(RuntimeError):
        mlp.MLPRegressorModel().transform(ready)


def test_evaluation_and_scoring(spark, table, tmp_path):
    configs = [c for c in regressors.default_configs("SalePrice", **SMALL) if c.name.startswith("LinearRegression")]
    quick = regressors.default_configs("SalePrice", net={"maxEpochs": 2, "hidden": (4,)})
    configs.append(next(c for c in quick if c.name == "MLP"))
    found = training.evaluate(
        table, configs, "Id", "SalePrice", "20240131_000000", STAMP, k=2, model_dir=str(tmp_path / "models"), parallelism=2
    )
    models = {r["name"]: r for r in found.models.collect()}
    assert len(models) == 3 and [n for n, r in models.items() if r["is_champion"]] == [found.champion_name]
    best = models[found.champion_name]
    assert best["cv_rmse_mean"] == min(r["cv_rmse_mean"] for r in models.values()) and best["file_path"]
    assert all(r["file_path"] is None for n, r in models.items() if n != found.champion_name)
    train = mark_holdout(table, "Id").where("NOT is_holdout").count()
    assert {r["model_name"]: r["count"] for r in found.oof.groupBy("model_name").count().collect()} == dict.fromkeys(models, train)
    scored = score_with_stored(found.models, table.drop("SalePrice"), "Id", STAMP)
    live = {r["Id"]: r["prediction"] for r in found.champion.transform(table).collect()}
    rows = scored.collect()
    assert len(rows) == len(live) and all(abs(r["predicted_price"] - live[r["kaggle_id"]]) < 1e-6 * abs(live[r["kaggle_id"]]) for r in rows)
    assert {r["model_name"] for r in rows} == {found.champion_name}


def test_champion_only(spark, table):
    configs = [c for c in regressors.default_configs("SalePrice") if c.name.startswith("LinearRegression")]
    found = training.evaluate(table, configs, "Id", "SalePrice", "v", STAMP, k=2, mode="train-only")
    (row,) = found.models.collect()
    assert row["is_champion"] and row["cv_rmse_std"] is None and row["rmse_test"] is None and row["cv_rmse_mean"] > 0
    with pytest.raises(ValueError):
        training.evaluate(table, configs, "Id", "SalePrice", "v", STAMP, mode="other")


@pytest.mark.parametrize("name", ["MLP_log", "HistGBR"])
def test_stored_models_score_the_same(spark, table, tmp_path, name):
    quick = {**SMALL, "net": {"maxEpochs": 2, "hidden": (4,)}}
    config = next(c for c in regressors.default_configs("SalePrice", **quick) if c.name == name)
    model = config.factory().fit(table)
    model.write().overwrite().save(str(tmp_path / "m"))
    back = TransformedTargetModel.load(str(tmp_path / "m"))
    a = {r["Id"]: r["prediction"] for r in model.transform(table).collect()}
    b = {r["Id"]: r["prediction"] for r in back.transform(table).collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)


def test_importances(table):
    fitted = regressors.random_forest("SalePrice", exclude=["Id"], **SMALL["forest"]).fit(table)
    stages = fitted.model.stages
    top = prep.top_importances(stages[0].transform(table), stages[-1].featureImportances, 3).collect()
    assert top[0]["feature"] == "GrLivArea_value" and len(top) == 3


def test_feature_stage_equals_the_layers(houses):
    staged = prep.GoldFeatures().transform(houses)
    layered = layers.prepare(houses)
    columns = sorted(layered.columns)
    assert staged.select(columns).orderBy("Id").collect() == layered.select(columns).orderBy("Id").collect()
    assert treat_missing(houses).count() == houses.count()


def test_medians_of_all_folds_come_from_one_pass(spark, monkeypatch):
    rows = [(i, f, float(i % 7) if i % 5 else None, i * i % 11, 9.0 if f == 1 else None, 2.0 * i) for i in range(60) for f in [[0, 1, 2, 7, None][i % 5]]]
    df = spark.createDataFrame(rows, "Id int, fold int, a double, b int, c double, y double")
    calls = []
    spans = ranks._spans
    monkeypatch.setattr(ranks, "_spans", lambda cells: calls.append(1) or spans(cells))
    make = lambda: regressors.linear_regression("y", exclude=["Id"])
    oof = training.out_of_fold(df, make, 4, ["Id", "y"], parallelism=2)  # fold 3 has no rows, fold 7 and none are no test rows
    assert len(calls) == 2  # one pass for the folds, one for the part that leaves out an empty fold; there were four
    assert sorted(r["Id"] for r in oof.collect()) == [i for i in range(60) if i % 5 < 3]
    preps = training.FittedPreps()
    preps.share_folds(df, 4, "fold")
    stage = make().estimator.getStages()[0]
    for f in range(4):
        train = df.where(F.col("fold") != f).drop("fold")
        assert preps._find_fills(stage, train, training.fold_part(f)) == stage.find_fills(train)
    assert preps._find_fills(stage, df.drop("fold"), "all rows") == stage.find_fills(df.drop("fold"))
    text = training.FittedPreps()
    text.share_folds(df.withColumn("fold", F.col("fold").cast("string")), 4, "fold")
    assert text._folded is None
