"""Bronze, silver and gold: each layer is one plan, its write the only action."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tabmill.defaults import ID_COLUMN, LABEL_COLUMN
from tabmill.functions.checks import col, require_columns
from tabmill.functions.features import add_features
from tabmill.functions.missing import infer_types, nan_to_null, normalize_missing, treat_missing
from tabmill.functions.ordinal import encode_ordinals
from tabmill.sources.readers import read_csv
from tabmill.sources.sinks import ensure_namespace, export_snapshot, manifest, overwrite_table, write_manifest


def on_features(df: DataFrame, keys: Sequence[str], step: Callable[[DataFrame], DataFrame], what: str) -> DataFrame:
    """Apply a row-wise step to a table whose keys (id, label) must exist and stay as they are.

    Keys come first in the result. Nothing is split and put together again: a row keeps its id.
    """
    require_columns(df, keys, what)
    out = step(df)
    rest = [c for c in out.columns if c not in set(keys)]
    return out.select(*[col(k) for k in keys], *[col(c) for c in rest])


def bronze(raw_text: DataFrame) -> DataFrame:
    """Typed table with NULL as the only missing marker."""
    return nan_to_null(infer_types(normalize_missing(raw_text)))


def silver(bronze_table: DataFrame, keys: Sequence[str] = (ID_COLUMN, LABEL_COLUMN)) -> DataFrame:
    return on_features(bronze_table, keys, treat_missing, "bronze table")


def gold(silver_table: DataFrame, keys: Sequence[str] = (ID_COLUMN, LABEL_COLUMN)) -> DataFrame:
    return on_features(silver_table, keys, lambda df: encode_ordinals(add_features(df)), "silver table")


def prepare(raw_table: DataFrame, keys: Sequence[str] = (ID_COLUMN, LABEL_COLUMN)) -> DataFrame:
    """Silver and gold in one plan, for training and scoring straight from the raw table."""
    return gold(silver(raw_table, keys), keys)


@dataclass(frozen=True)
class LayerTables:
    """Names of the layer tables within a namespace."""

    namespace: str

    def name(self, layer: str, part: str) -> str:
        suffix = {"bronze": "raw", "silver": "clean", "gold": "features"}[layer]
        return f"{self.namespace}.{layer}_{part}_{suffix}"


def run_layers(
    spark: SparkSession, train_csv: str, test_csv: str, tables: LayerTables, store: str, created_at: str,
    fmt: str = "parquet", table_root: str | None = None,
) -> dict[str, int]:
    """All layers for train and test, the feature store export and its manifest; rows per table."""
    ensure_namespace(spark, tables.namespace)
    rows: dict[str, int] = {}
    keys = {"train": (ID_COLUMN, LABEL_COLUMN), "test": (ID_COLUMN,)}

    def save(df: DataFrame, layer: str, part: str) -> DataFrame:
        name = tables.name(layer, part)
        path = f"{table_root}/{layer}_{part}" if table_root else None
        rows[f"{layer}_{part}"] = overwrite_table(df, name, fmt, path)
        return spark.table(name)

    for part, csv in (("train", train_csv), ("test", test_csv)):
        raw = save(nan_to_null(read_csv(spark, csv)), "bronze", part)
        clean = save(silver(raw, keys[part]), "silver", part)
        features = save(gold(clean, keys[part]), "gold", part)
        export_snapshot(features, f"{store}/{part}_gold.parquet")
    write_manifest(
        manifest(
            spark, created_at, {p: rows[f"gold_{p}"] for p in keys},
            gold_train_table=tables.name("gold", "train"), gold_test_table=tables.name("gold", "test"),
            train_parquet=f"{store}/train_gold.parquet", test_parquet=f"{store}/test_gold.parquet",
        ),
        f"{store}/manifest.json",
    )
    return rows
