"""Run history: appends by column name, each run at most once."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmill.functions.checks import present, quoted, require_columns
from tabmill.functions.times import lenient_timestamp
from tabmill.operators.encode import union_all
from tabmill.session import discard, materialize
from tabmill.sources.readers import CSV_FORMAT, path_exists, read_csv, read_growing

# --- fixed values: the run tables and the column that names the run ---
RUN_TABLES = {"models": "version", "train_cv_predictions": "model_version", "predictions": "model_version"}

# Names the delivery a row came with; a folder below the run's.
PART = "_part"
# The columns that name folders; text, whatever their values look like.
FOLDERS = (*dict.fromkeys(RUN_TABLES.values()), PART)
# The folder of the load ledger; readers of the table pass over names that begin so.
LEDGER = "_loads"


def append_history(df: DataFrame, path: str) -> None:
    """Append to a Parquet history. Columns are matched by name when it is read, and may grow."""
    df.write.mode("append").parquet(path)


def append_csv_history(df: DataFrame, path: str) -> None:
    """Append to a CSV history under its header; other columns than those of the header are
    refused, for CSV has no names to match them by."""
    spark = df.sparkSession
    if path_exists(spark, path):
        header = spark.read.options(**CSV_FORMAT).csv(path).columns
        if set(header) != set(df.columns):
            raise ValueError(f"columns {sorted(set(header) ^ set(df.columns))} differ from the history; use Parquet")
        df = df.select(*header)
    df.write.mode("append").options(**CSV_FORMAT).csv(path)


def distinct_runs(df: DataFrame, version: str) -> DataFrame:
    """The run versions of a snapshot."""
    return df.where(F.col(version).isNotNull()).select(F.col(version).cast("string").alias(version)).distinct()


def runs_already_loaded(stored: DataFrame, incoming: DataFrame, version: str) -> DataFrame:
    """The incoming run versions that the stored table has.

    Both sides are reduced to distinct versions before the join, within each input partition
    first, so a run with a third of the rows is one row when it is shuffled.
    """
    return distinct_runs(incoming, version).join(distinct_runs(stored, version), version, "left_semi")


def any_run_loaded(stored: DataFrame, incoming: DataFrame, version: str) -> bool:
    """Whether any incoming run is stored; versions are compared as text, whatever their type."""
    return version in stored.columns and not runs_already_loaded(stored, incoming, version).isEmpty()


def new_runs(stored: DataFrame | None, incoming: DataFrame, version: str) -> DataFrame:
    """Rows of runs which are not stored yet; rows without a run version are always new.

    The stored side is reduced to its run versions before the join, so a run with many rows
    weighs as much as any other. Spark broadcasts the versions while their size allows.
    """
    if stored is None or version not in stored.columns:
        return incoming
    known = distinct_runs(stored, version).withColumnRenamed(version, "_run")
    return incoming.join(known, F.col(version).cast("string") == F.col("_run"), "left_anti")


def read_raw(spark: SparkSession, path: str) -> DataFrame | None:
    """A RAW table as it was loaded; None if nothing was written yet."""
    stored = read_growing(spark, path, FOLDERS)
    return stored.drop(PART) if stored is not None else None


def deliveries(incoming: DataFrame, version: str) -> DataFrame:
    """version, _part, rows, digest: the rows of each run named by their content, whatever their order; one row per run."""
    columns = [F.col(quoted(c)) for c in sorted(incoming.columns)]
    digest = F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).cast("string")
    found = incoming.groupBy(F.col(version).alias(version)).agg(F.count(F.lit(1)).alias("_rows"), digest.alias("_digest"))
    return found.select(version, F.md5(F.concat_ws(":", "_rows", "_digest")).alias(PART), "_rows", "_digest")


def read_loads(spark: SparkSession, path: str, version: str) -> DataFrame | None:
    """version, _part, _rows, _digest of every delivery a RAW table has, from its ledger; None if nothing was loaded.

    No data file is opened. A table without a ledger, loaded before there was one or stopped between its first rows and their entry, is
    told from its folders; their rows and digests are NULL.
    """
    if path_exists(spark, f"{path}/{LEDGER}"):
        return spark.read.schema(_ledger_schema(version)).parquet(f"{path}/{LEDGER}")
    stored = read_growing(spark, path, (version, PART))
    if stored is None:
        return None
    named = stored.select(F.col(version).cast("string").alias(version), PART).distinct()
    return named.select(version, PART, F.lit(None).cast("bigint").alias("_rows"), F.lit(None).cast("string").alias("_digest"))


def _ledger_schema(version: str) -> str:
    return f"{quoted(version)} string, {PART} string, _rows bigint, _digest string"


def _note_loads(loaded: DataFrame, path: str, version: str) -> None:
    """Add one file to the ledger: a row for each delivery of a load."""
    entries = loaded.select(F.col(quoted(version)).cast("string").alias(version), PART, "_rows", "_digest")
    entries.coalesce(1).write.mode("append").parquet(f"{path}/{LEDGER}")


def load_raw(incoming: DataFrame, path: str, version: str, mode: str = "append", skip: str = "snapshot") -> bool:
    """Load a snapshot into a RAW table kept as Parquet; returns whether rows were written.

    ``mode``: append or truncate. ``skip`` (append only): 'snapshot' loads nothing if any of
    the runs is stored already, 'run' loads the runs that are not, 'part' loads what was not delivered before, also of runs
    stored already, 'none' always loads all.

    The table has a folder for each run and below it one for each delivery, named by its content. Which runs are stored is read from
    a ledger beside the folders: a file for each load, written after its rows. A load that was stopped in between has no entry, so it
    is made again, and a delivery that comes again replaces its own folder: nothing is added twice, rows without a version included
    (with skip 'none', which adds whatever comes, also rows of a stopped load). The snapshot is computed once and stored before it is looked at.
    """
    if skip not in ("snapshot", "run", "part", "none"):
        raise ValueError(f"unknown skip mode {skip!r}")
    if mode not in ("append", "truncate"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = incoming.sparkSession
    require_columns(incoming, [version], "snapshot")
    kept = materialize(incoming, "snapshot")
    try:
        return _load_stored(spark, kept, path, version, mode, skip)
    finally:
        discard(kept)


def _load_stored(spark: SparkSession, incoming: DataFrame, path: str, version: str, mode: str, skip: str) -> bool:
    parts = materialize(deliveries(incoming, version), "deliveries")
    scratch = [parts]
    try:
        wanted = parts
        if skip == "none":
            wanted = parts.withColumn(PART, F.lit(uuid.uuid4().hex))
        ledger = path_exists(spark, f"{path}/{LEDGER}")
        stored = read_loads(spark, path, version) if mode == "append" and (skip != "none" or not ledger) else None
        if stored is not None and not ledger:
            # the folders of a table without a ledger become its first entry
            stored = materialize(stored, "loads")
            scratch.append(stored)
            _note_loads(stored, path, version)
        if stored is not None and skip != "none":
            if skip == "snapshot" and any_run_loaded(stored, parts, version):
                return False
            if skip == "run":
                wanted = new_runs(stored, wanted, version)
            known = stored.select(F.col(version).alias("_run"), F.col(PART).alias("_known")).distinct()
            same = F.col(version).cast("string").eqNullSafe(F.col("_run")) & (F.col(PART) == F.col("_known"))
            wanted = wanted.join(known, same, "left_anti")
        wanted = materialize(wanted, "wanted")
        scratch.append(wanted)
        if mode == "append" and wanted.isEmpty():
            return False
        runs = wanted.select(F.col(version).alias("_run"), PART)
        rows = incoming.join(runs, F.col(version).eqNullSafe(F.col("_run"))).drop("_run")
        # named after their content, deliveries replace themselves and nothing else; a truncation removes the ledger as well
        overwrite = "dynamic" if mode == "append" else "static"
        rows.write.mode("overwrite").option("partitionOverwriteMode", overwrite).partitionBy(version, PART).parquet(path)
        _note_loads(wanted, path, version)
        return True
    finally:
        discard(*scratch)


def register_raw(spark: SparkSession, name: str, path: str) -> None:
    """Make a RAW folder a table of the catalog, with the columns and runs it has now; no rows are read or moved."""
    stored = read_growing(spark, path, FOLDERS)
    if stored is None:
        raise ValueError(f"nothing was loaded at {path}")
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in stored.schema.fields)
    runs = ", ".join(quoted(c) for c in stored.columns if c in FOLDERS)
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})
    spark.sql(
        f"CREATE TABLE IDENTIFIER(:name) ({columns}) USING parquet PARTITIONED BY ({runs}) LOCATION '{path}'", args={"name": name}
    )
    spark.catalog.recoverPartitions(name)


def load_all(
    spark: SparkSession, snapshots: Mapping[str, str], raw: str, mode: str = "append", skip: str = "snapshot",
    read: Callable[[SparkSession, str], DataFrame] | None = None,
) -> dict[str, str]:
    """Load every run table whose snapshot exists; table -> loaded, skipped or absent."""
    outcome = {}
    for table, version in RUN_TABLES.items():
        path = snapshots.get(table)
        if path is None or not path_exists(spark, path):
            outcome[table] = "absent"
            continue
        snapshot = read(spark, path) if read else spark.read.parquet(path)
        outcome[table] = "loaded" if load_raw(snapshot, f"{raw}/{table}", version, mode, skip) else "skipped"
    return outcome


def register_all(spark: SparkSession, raw: str, namespace: str) -> list[str]:
    """Register every run table that was loaded below ``raw``, for the views over them; returns their names."""
    names = [t for t in RUN_TABLES if path_exists(spark, f"{raw}/{t}")]
    for table in names:
        register_raw(spark, f"{namespace}.{table}", f"{raw}/{table}")
    return names


def parse_history(history: DataFrame, at: str = "created_at_utc") -> DataFrame:
    """Load times of a text history as timestamps; unreadable ones become NULL."""
    return history.withColumns({c: lenient_timestamp(F.col(c).cast("string")) for c in present(history, [at])})


def rebuild_raw(spark: SparkSession, csv_history: Mapping[str, str], raw: str) -> dict[str, str]:
    """Replace every RAW table whose CSV history exists."""
    outcome = {}
    for table in RUN_TABLES:
        path = csv_history.get(table)
        if path is None or not path_exists(spark, path):
            outcome[table] = "absent"
            continue
        load_raw(parse_history(read_csv(spark, path)), f"{raw}/{table}", RUN_TABLES[table], mode="truncate")
        outcome[table] = "loaded"
    return outcome


def union_runs(*snapshots: DataFrame) -> DataFrame:
    """History of several snapshots, columns by name; absent columns are NULL."""
    return union_all(snapshots)
