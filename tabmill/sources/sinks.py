"""Tables, snapshots, exports, manifest, views."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tabmill.functions.checks import quoted, require_columns
from tabmill.session import remove_path
from tabmill.sources.readers import CSV_FORMAT, path_exists

# Stands between the name of a table and the number of a version of it.
VERSION_MARK = "__v"


def ensure_namespace(spark: SparkSession, name: str) -> None:
    spark.sql("CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:name)", args={"name": name})


def overwrite_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None, keep: int = 1) -> int:
    """Replace a catalog table with its schema; returns the rows written, counted on the way.

    Each version is a table of its own, ``<name>__v<number>_<id>``, and ``name`` a view of the latest one. The view changes in one step of the catalog
    after the rows are written, so a reader finds the old rows or the new ones, a table may be replaced from itself, and a
    write that fails leaves the old version in place. The ``keep`` versions before the latest stay for readers that have
    begun with them; older ones go. With ``path`` each version lies in a new folder below it. A plain table of that name, made by others,
    becomes version 0; only then is there no table for a moment. One writer at a time.
    """
    spark = df.sparkSession
    earlier = table_versions(spark, name)
    fresh = f"{name}{VERSION_MARK}{_number(earlier[-1]) + 1 if earlier else 1:09d}_{uuid.uuid4().hex[:8]}"
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt)
    if path:
        writer = writer.option("path", f"{path}/{uuid.uuid4().hex[:12]}")
    try:
        writer.saveAsTable(fresh)
    except Exception:
        _drop_version(spark, fresh, path)
        raise
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        plain = f"{name}{VERSION_MARK}{0:09d}_{uuid.uuid4().hex[:8]}"
        spark.sql(f"ALTER TABLE {_quoted_name(name)} RENAME TO {_quoted_name(plain)}")
        earlier.insert(0, plain)
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted_name(name)} AS SELECT * FROM {_quoted_name(fresh)}")
    for old in earlier[: max(0, len(earlier) - keep)]:
        _drop_version(spark, old, path)
    return seen.get["rows"]


def table_versions(spark: SparkSession, name: str) -> list[str]:
    """The versions of a table that ``overwrite_table`` wrote, oldest first."""
    *space, table = name.split(".")
    within = f"IN {_quoted_name('.'.join(space))} " if space else ""
    listed = spark.sql(f"SHOW TABLES {within}LIKE '{table}{VERSION_MARK}*'").select("tableName").collect()  # a few versions
    ours = re.compile(rf"{re.escape(table)}{VERSION_MARK}\d{{9}}_[0-9a-f]{{8}}", re.IGNORECASE)
    found = [r["tableName"] for r in listed if ours.fullmatch(r["tableName"])]
    return [".".join([*space, t]) for t in sorted(found, key=_number)]


def _number(version: str) -> int:
    return int(version.rsplit(VERSION_MARK, 1)[1].split("_")[0])


def _drop_version(spark: SparkSession, version: str, path: str | None) -> None:
    """Drop one version and, of tables kept below ``path``, its folder."""
    folder = _location(spark, version) if path and spark.catalog.tableExists(version) else None
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": version})
    if folder and f"{path}/" in folder:
        remove_path(spark, folder)


def _location(spark: SparkSession, name: str) -> str | None:
    rows = spark.sql(f"DESCRIBE FORMATTED {_quoted_name(name)}").where("col_name = 'Location'").collect()  # one row
    return rows[0]["data_type"] if rows else None


def _quoted_name(name: str) -> str:
    return ".".join(quoted(part) for part in name.split("."))


def export_snapshot(df: DataFrame, path: str, single_file: bool = False) -> int:
    """Overwrite a Parquet snapshot; returns the rows written. ``single_file`` sends everything
    through one task and is meant for small tables."""
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    (out.coalesce(1) if single_file else out).write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def export_submission(
    scored: DataFrame, path: str, key: str = "kaggle_id", value: str = "predicted_price",
    header: tuple[str, str] = ("Id", "SalePrice"),
) -> None:
    """id, prediction as CSV with header."""
    require_columns(scored, [key, value], "scored table")
    scored.select(F.col(key).alias(header[0]), F.col(value).alias(header[1])).write.mode("overwrite").options(
        **CSV_FORMAT
    ).csv(path)


def manifest(spark: SparkSession, created_at: str, rows: Mapping[str, int], **entries: str) -> DataFrame:
    """One row: time, named entries (tables, paths) and row counts."""
    fields = {"created_at_utc": created_at, **entries, **{f"{name}_rows": n for name, n in rows.items()}}
    return spark.range(1).select(*[F.lit(v).alias(c) for c, v in fields.items()])


def write_manifest(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """The one row of a manifest, or None if there is none."""
    if not path_exists(spark, path):
        return None
    row = spark.read.text(path).first()
    return json.loads(row["value"]) if row else None


def content_digest(df: DataFrame) -> DataFrame:
    """rows, digest — does not depend on row order or partitioning. Columns go in by name."""
    names = [F.col(quoted(c)) for c in sorted(df.columns)]
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.xxhash64(*names).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("digest"),
    )


def same_content(left: DataFrame, right: DataFrame) -> bool:
    return sorted(left.columns) == sorted(right.columns) and content_digest(left).first() == content_digest(right).first()


def sync_if_changed(spark: SparkSession, source: str, target: str, tables: tuple[str, ...] = ("train", "test")) -> bool:
    """Copy the tables of a feature store only if its manifest differs from the copy's, or the
    copy is incomplete. The manifest is written last, so a broken copy is repeated."""
    remote = read_manifest(spark, f"{source}/manifest.json")
    if remote is None:
        raise RuntimeError(f"no manifest in {source}")
    complete = all(path_exists(spark, f"{target}/{t}_gold.parquet/_SUCCESS") for t in tables)
    if complete and read_manifest(spark, f"{target}/manifest.json") == remote:
        return False
    for t in tables:
        export_snapshot(spark.read.parquet(f"{source}/{t}_gold.parquet"), f"{target}/{t}_gold.parquet")
    spark.read.text(f"{source}/manifest.json").coalesce(1).write.mode("overwrite").text(f"{target}/manifest.json")
    return True


def create_views(views: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """Register plans as session views; returns their names."""
    names = []
    for name, df in views.items():
        names.append(f"{prefix}{name}")
        df.createOrReplaceTempView(names[-1])
    return names
