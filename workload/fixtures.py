"""Stand-in inputs derived from the test tables: one SQL text for both engines.

The test tables have no missing values and no duplicates; the formulas make them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabmill.defaults import (
    EXPOSURE_SCALE, BASEMENT_FINISH_SCALE, FUNCTIONAL_SCALE, GARAGE_FINISH_SCALE, ORDINAL_COLUMNS, PAVED_SCALE,
    QUALITY_SCALE,
)
from workload.dialects import DUCK, SPARK, Dialect


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# name: (factor, modulus, each n-th missing)
NUMBERS = {
    "TotalBsmtSF": (13, 2000, 7),
    "1stFlrSF": (17, 3000, 1000003),
    "2ndFlrSF": (19, 1500, 13),
    "GrLivArea": (23, 4000, 17),
    "FullBath": (5, 4, 1000003),
    "HalfBath": (7, 3, 17),
    "BsmtFullBath": (11, 3, 13),
    "BsmtHalfBath": (13, 2, 19),
    "OpenPorchSF": (3, 200, 7),
    "EnclosedPorch": (5, 100, 11),
    "3SsnPorch": (7, 50, 13),
    "ScreenPorch": (9, 150, 17),
    "WoodDeckSF": (11, 300, 5),
    "GarageArea": (13, 800, 9),
    "Fireplaces": (17, 4, 8),
    "PoolArea": (19, 3, 10),
    "LotFrontage": (29, 120, 6),
    "MasVnrArea": (31, 400, 8),
}

# name: (levels, multiplier); one unknown level and one missing follow the levels
LEVELS = {
    "ExterQual": (QUALITY_SCALE, 11), "ExterCond": (QUALITY_SCALE, 13), "BsmtQual": (QUALITY_SCALE, 17),
    "BsmtCond": (QUALITY_SCALE, 19), "HeatingQC": (QUALITY_SCALE, 23), "KitchenQual": (QUALITY_SCALE, 3),
    "FireplaceQu": (QUALITY_SCALE, 29), "GarageQual": (QUALITY_SCALE, 31), "GarageCond": (QUALITY_SCALE, 37),
    "PoolQC": (QUALITY_SCALE, 5), "BsmtExposure": (EXPOSURE_SCALE, 3), "BsmtFinType1": (BASEMENT_FINISH_SCALE, 5),
    "BsmtFinType2": (BASEMENT_FINISH_SCALE, 7), "Functional": (FUNCTIONAL_SCALE, 3),
    "GarageFinish": (GARAGE_FINISH_SCALE, 5), "PavedDrive": (PAVED_SCALE, 2),
    "MiscFeature": (["Shed", "Gar2", "Othr"], 3), "Alley": (["Grvl", "Pave"], 3),
    "Fence": (["MnPrv", "GdPrv", "GdWo"], 2), "GarageType": (["Attchd", "Detchd", "BuiltIn"], 7),
    "MasVnrType": (["BrkFace", "Stone", "None"], 3), "Electrical": (["SBrkr", "FuseA", "FuseF"], 2),
}

HOUSE_TEXT = [*LEVELS, "MSZoning"]
HOUSE_NUMBERS = ["YrSold", "YearBuilt", "YearRemodAdd", *NUMBERS, "GarageYrBlt", "OverallQual"]


def _number(m: int, n: int, z: int) -> str:
    return f"CASE WHEN o_orderkey % {z} = 0 THEN NULL ELSE (o_custkey * {m} + o_orderkey) % {n} END"


def _level(names: list[str], k: int) -> str:
    cases = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate([*names, "Zz"]))
    return f"CASE (o_orderkey * {k}) % {len(names) + 2} {cases} END"


def houses_sql(d: Dialect, source: str = "orders") -> str:
    """One row per order."""
    columns = {c: _number(*spec) for c, spec in NUMBERS.items()}
    columns |= {c: _level(*spec) for c, spec in LEVELS.items()}
    columns["MSZoning"] = "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END"
    columns["OverallQual"] = "1 + o_orderkey % 10"
    years = "cast(year(o_orderdate) as bigint)"
    base = ", ".join(f"{expr} AS {d.name(c)}" for c, expr in columns.items())
    inner = (
        f"SELECT o_orderkey AS {d.name('Id')}, {years} AS {d.name('YrSold')}, {years} - o_custkey % 100 AS {d.name('YearBuilt')},"
        f" {base}, o_totalprice FROM {source}"
    )
    remod = (
        f"CASE WHEN {d.name('Id')} % 11 = 0 THEN NULL WHEN {d.name('Id')} % 2 = 0 THEN {d.name('YearBuilt')}"
        f" ELSE {d.name('YearBuilt')} + {d.name('Id')} % 10 END"
    )
    garage = f"CASE WHEN {d.name('Id')} % 6 = 0 THEN NULL ELSE {d.name('YearBuilt')} + {d.name('Id')} % 5 END"
    price = (
        f"50000.0E0 + 40 * coalesce({d.name('GrLivArea')}, 0) + 9000 * {d.name('OverallQual')} + o_totalprice * 0.2E0"
    )
    names = ["Id", "YrSold", "YearBuilt", *columns]
    return (
        f"SELECT {', '.join(d.name(c) for c in names)}, {remod} AS {d.name('YearRemodAdd')},"
        f" {garage} AS {d.name('GarageYrBlt')}, {price} AS {d.name('SalePrice')} FROM ({inner}) h"
    )


def _version(d: Dialect) -> str:
    january = "year(o_orderdate) = 1995 AND month(o_orderdate) = 1"
    return f"CASE WHEN {january} THEN 'manual-run' ELSE {d.run_version('o_orderdate')} END"


def _micros(d: Dialect) -> str:
    """Shifted so that the magnitude of the epoch tells its unit."""
    return f"{d.epoch_us('o_orderdate')} + 800000000000000"


def cv_sql(d: Dialect, source: str = "orders") -> str:
    us = f"({_micros(d)})"
    base = (
        f"SELECT o_orderkey AS kaggle_id, o_totalprice * 1.3E0 AS y_true, o_orderpriority AS model_name,"
        f" {_version(d)} AS model_version,"
        f" o_totalprice * 1.3E0 * (0.8031714159E0 + (o_orderkey % 97) / 241.0E0) AS y_pred_oof,"
        f" CASE o_orderkey % 5 WHEN 0 THEN {us} * 1000 WHEN 1 THEN {us} WHEN 2 THEN {d.idiv(us, '1000')}"
        f" WHEN 3 THEN {d.idiv(us, '1000000')} END AS created_at_utc FROM {source}"
    )
    both = (
        f"SELECT * FROM ({base}) a UNION ALL SELECT kaggle_id, y_true, model_name, model_version, y_pred_oof * 1.01E0,"
        f" created_at_utc - 1 FROM ({base}) b WHERE kaggle_id % 3 = 0"
    )
    return (
        "SELECT kaggle_id, y_true, y_pred_oof, abs(y_true - y_pred_oof) AS abs_error,"
        " abs(y_true - y_pred_oof) / greatest(y_true, 1.0E0) AS rel_error,"
        " concat(model_name, '@', model_version) AS model_id, model_name, model_version, created_at_utc"
        f" FROM ({both}) u"
    )


def models_sql(d: Dialect, source: str = "orders") -> str:
    base = (
        f"SELECT o_orderpriority AS name, {_version(d)} AS version, month(o_orderdate) AS m,"
        f" o_totalprice * 0.1031714159E0 AS p, {_micros(d)} AS us FROM {source}"
    )
    grouped = (
        "SELECT concat(name, '@', version) AS id, name, version,"
        " CASE max(m) % 3 WHEN 0 THEN NULL WHEN 1 THEN name = '3-MEDIUM' ELSE false END AS is_champion,"
        " CASE WHEN max(m) % 4 = 0 AND name = '5-LOW' THEN NULL ELSE round(avg(p), 4) END AS cv_rmse_mean,"
        " round(stddev_pop(p), 4) AS cv_rmse_std, round(max(p), 4) AS rmse_test, round(min(p) / max(p), 6) AS r2_test,"
        " max(us) AS created_at_utc,"
        f" CASE WHEN max(m) % 3 = 1 THEN concat('models/', name) END AS file_path FROM ({base}) b GROUP BY name, version"
    )
    return (
        f"SELECT * FROM ({grouped}) g UNION ALL SELECT id, name, version, false, cv_rmse_mean * 0.5E0, cv_rmse_std,"
        f" rmse_test, r2_test, created_at_utc - 1000000, file_path FROM ({grouped}) h WHERE name < '3'"
    )


def predictions_sql(d: Dialect, source: str = "orders") -> str:
    return (
        f"SELECT o_custkey AS kaggle_id, o_totalprice AS predicted_price,"
        f" concat(o_orderpriority, '@', {_version(d)}) AS model_id, o_orderpriority AS model_name,"
        f" {_version(d)} AS model_version, cast(o_orderdate as timestamp) AS created_at_utc FROM {source}"
    )


_TEXTS = {"houses": houses_sql, "cv": cv_sql, "models": models_sql, "predictions": predictions_sql}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(_TEXTS[name](SPARK, "{orders}"), orders=table(spark, sf_dir, "orders"))


def with_fixtures(names: str, body: str) -> str:
    """The SQL twin: fixtures as common table expressions before the query."""
    parts = ", ".join(f"{n} AS ({_TEXTS[n](DUCK)})" for n in names.split())
    return f"WITH {parts} {body}" if not body.lstrip().upper().startswith("WITH ") else f"WITH {parts}, {body.lstrip()[5:]}"


def houses_as_text(spark: SparkSession, sf_dir: str, path: str, part: str = "train") -> str:
    """The raw CSV files of the house table, missing values written as NA; returns their path."""
    houses = fixture(spark, sf_dir, "houses")
    if part == "test":
        houses = houses.drop("SalePrice")
    houses.write.option("header", True).option("nullValue", "NA").csv(path)
    return path


assert set(ORDINAL_COLUMNS) <= set(LEVELS)
