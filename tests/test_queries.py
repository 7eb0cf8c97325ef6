"""Every registered query with SQL gives the rows DuckDB gives, at the smallest scale."""

import pytest

from tabmill.ml.regressors import default_configs
from tabmill.plans import layers
from workload.catalog import QUERIES, SQL
from workload.check import compare
from workload.fixtures import fixture


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_to_sql(spark, sf, name):
    outcome = compare(spark, sf, name, QUERIES[name], SQL[name])
    assert outcome.startswith("equal"), outcome


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["model_comparison", "champion_only_training", "stored_model_scores"])
def test_comparisons_take_all_configurations_columns_and_folds(spark, sf, monkeypatch, name):
    from workload import training

    asked = {}

    def noted(df, configs, *args, **options):
        asked.update(options, columns=df.columns, configs=configs)
        raise InterruptedError

    monkeypatch.setattr(training.training, "evaluate", noted)
    with pytest.raises(InterruptedError):
        QUERIES[name](spark, sf)
    assert [c.name for c in asked["configs"]] == [c.name for c in default_configs("SalePrice")] and len(asked["configs"]) == 8
    assert asked["k"] == 5 and asked["columns"] == layers.prepare(fixture(spark, sf, "houses")).columns
    forest = next(c for c in asked["configs"] if c.name == "RandomForest").factory().estimator.getStages()[-1]
    assert forest.getOrDefault("trees") == 300


@pytest.mark.parametrize("cores, fits", [(4, 8), (12, 12)])
def test_comparisons_fit_as_many_models_at_a_time_as_there_are_cores(spark, sf, monkeypatch, cores, fits):
    from workload import training

    asked = {}

    def noted(df, *args, **options):
        asked.update(options)
        raise InterruptedError

    monkeypatch.setattr(training.training, "evaluate", noted)
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", cores)
    with pytest.raises(InterruptedError):
        QUERIES["model_comparison"](spark, sf)
    assert asked["parallelism"] == fits  # eight nets of one core each left four of twelve cores idle
