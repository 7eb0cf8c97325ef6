import pytest

from tabmill import defaults
from tabmill.functions.features import add_features
from tabmill.functions.ordinal import encode_ordinals
from tabmill.plans import layers

BASE = {
    "YrSold": 2010, "YearBuilt": 2000, "YearRemodAdd": 2005, "TotalBsmtSF": 100.0, "1stFlrSF": 200.0, "2ndFlrSF": None,
    "FullBath": 2.0, "HalfBath": 1.0, "BsmtFullBath": None, "BsmtHalfBath": 1.0, "OpenPorchSF": 1.0, "EnclosedPorch": 2.0,
    "3SsnPorch": 3.0, "ScreenPorch": None, "WoodDeckSF": 5.0, "GarageArea": 0.0, "Fireplaces": None, "PoolArea": 3.0,
    "OverallQual": 5, "GrLivArea": None,
}
TYPES = ", ".join(f"`{c}` {'int' if c.startswith('Y') or c == 'OverallQual' else 'double'}" for c in BASE)


def row_of(spark, **changes):
    return spark.createDataFrame([tuple({**BASE, **changes}.values())], TYPES)


def test_sums_flags_and_product_fill_missing_parts(spark):
    r = add_features(row_of(spark)).first()
    assert (r["HouseAge"], r["RemodAge"], r["IsRemodeled"]) == (10, 5, 1)
    assert (r["TotalSF"], r["TotalBath"], r["TotalPorchSF"]) == (300.0, 3.0, 11.0)
    assert [r[f] for f in defaults.PRESENCE_FLAGS] == [1, 0, 0, 1]
    assert r["QualSF"] == 0.0


def test_ages_stay_missing_and_missing_years_count_as_remodeled(spark):
    r = add_features(row_of(spark, YearBuilt=None)).first()
    assert r["HouseAge"] is None and r["IsRemodeled"] == 1
    both = add_features(row_of(spark, YearBuilt=None, YearRemodAdd=None)).first()
    assert both["IsRemodeled"] == 1
    assert add_features(row_of(spark, YearRemodAdd=2000)).first()["IsRemodeled"] == 0


def test_exploration_variant_does_not_fill(spark):
    r = add_features(row_of(spark), fill_missing=False).first()
    assert r["TotalSF"] is None and "QualSF" not in r.asDict() and "IsRemodeled" not in r.asDict()


def test_required_and_optional_columns(spark):
    with pytest.raises(ValueError, match="HalfBath"):
        add_features(row_of(spark).drop("HalfBath"))
    out = add_features(row_of(spark).drop("YrSold", "PoolArea", "OverallQual"))
    assert not {"HouseAge", "RemodAge", "HasPool", "QualSF"} & set(out.columns)


@pytest.mark.parametrize("column", sorted(defaults.ORDINAL_COLUMNS))
def test_ordinal_scale(spark, column):
    scale = defaults.ORDINAL_COLUMNS[column]
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*scale, "??", None])], f"i int, {column} string")
    got = [r[column] for r in encode_ordinals(df).orderBy("i").collect()]
    assert got == [*range(len(scale) - 1, -1, -1), None, None]


def test_keys_come_first_and_must_exist(spark):
    df = row_of(spark).selectExpr("*", "7L AS Id", "1.5D AS SalePrice")
    out = layers.gold(layers.silver(df))
    assert out.columns[:2] == ["Id", "SalePrice"] and out.first()["Id"] == 7
    with pytest.raises(ValueError, match="SalePrice"):
        layers.silver(df.drop("SalePrice"))


def test_layers_keep_rows_for_any_partitioning(spark, houses):
    one = layers.prepare(houses.coalesce(1)).orderBy("Id").collect()
    many = layers.prepare(houses.repartition(8)).orderBy("Id").collect()
    assert one == many and len(one) == houses.count()
