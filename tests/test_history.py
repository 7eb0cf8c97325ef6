import pytest
from pyspark.sql import functions as F

from tabmill.plans import layers
from tabmill.sources import history, sinks
from tabmill.sources.readers import read_growing
from tabmill.streaming.ingest import ingest_runs
from tests.plans import physical
from workload.fixtures import fixture


def run(spark, version, *values):
    return spark.createDataFrame([(version, v) for v in values], "version string, v int")


def stored(spark, path):
    return sorted((r["version"] or "", r["v"]) for r in history.read_raw(spark, path).collect())


def test_a_run_is_loaded_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert history.load_raw(run(spark, "a", 1, 2), path, "version")
    assert not history.load_raw(run(spark, "a", 1, 2), path, "version")
    mixed = run(spark, "a", 9).union(run(spark, "b", 3))
    assert not history.load_raw(mixed, path, "version")
    assert stored(spark, path) == [("a", 1), ("a", 2)]
    assert history.load_raw(mixed, path, "version", skip="run")
    assert stored(spark, path) == [("a", 1), ("a", 2), ("b", 3)]
    assert not history.load_raw(mixed, path, "version", skip="run")


@pytest.mark.parametrize("skip", ["snapshot", "run", "part"])
def test_rows_without_version_are_loaded_once(spark, tmp_path, skip):
    path = str(tmp_path / "raw")
    assert history.load_raw(run(spark, None, 1, 1), path, "version", skip=skip)
    assert not history.load_raw(run(spark, None, 1, 1), path, "version", skip=skip)
    assert history.load_raw(run(spark, None, 1), path, "version", skip=skip)
    assert stored(spark, path) == [("", 1), ("", 1), ("", 1)]


def test_a_run_in_parts_is_complete_and_repeats_add_nothing(spark, tmp_path):
    path = str(tmp_path / "raw")
    both = run(spark, "a", 3).union(run(spark, "b", 9))
    for snapshot in (run(spark, "a", 1, 2), run(spark, "a", 1, 2), both, both, run(spark, None, 7), run(spark, None, 7)):
        history.load_raw(snapshot, path, "version", skip="part")
    assert stored(spark, path) == [("", 7), ("a", 1), ("a", 2), ("a", 3), ("b", 9)]


def test_a_run_is_read_from_its_folder(spark, tmp_path):
    path = str(tmp_path / "raw")
    history.load_raw(run(spark, "007", 1).union(run(spark, "2024-01-31", 2)), path, "version")
    found = history.read_raw(spark, path)
    assert sorted(r["version"] for r in found.collect()) == ["007", "2024-01-31"] and "_part" not in found.columns
    plan = physical(found.where("version = '007'"))
    assert "PartitionFilters: [isnotnull(version" in plan


def test_versions_are_compared_as_text(spark):
    numbers = spark.createDataFrame([(1,), (2,)], "version bigint")
    assert not history.any_run_loaded(numbers, run(spark, "manual-run", 1), "version")
    assert history.any_run_loaded(numbers, run(spark, "2", 1), "version")


def test_a_snapshot_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    history.load_raw(run(spark, "a", 1), str(tmp_path / "raw"), "version")
    incoming = run(spark, "b", 1, 2, 3).mapInArrow(counted, "version string, v int")
    history.load_raw(incoming, str(tmp_path / "raw"), "version", skip="run")
    assert seen.value == 3


def test_truncate_and_forced_append(spark, tmp_path):
    path = str(tmp_path / "raw")
    history.load_raw(run(spark, "a", 1), path, "version")
    history.load_raw(run(spark, "a", 1), path, "version", skip="none")
    assert len(stored(spark, path)) == 2
    history.load_raw(run(spark, "b", 5), path, "version", mode="truncate")
    assert stored(spark, path) == [("b", 5)]
    with pytest.raises(ValueError):
        history.load_raw(run(spark, "b", 5), path, "version", mode="merge")


def spoil(folder):
    """Overwrite every data file, so that whoever opens one fails."""
    from pathlib import Path

    files = [f for f in Path(folder).rglob("*.parquet") if history.LEDGER not in f.parts]
    assert files
    for f in files:
        f.write_bytes(b"no data")
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)


@pytest.mark.parametrize("skip", ["snapshot", "run", "part", "none"])
def test_a_load_of_a_new_run_opens_no_old_file(spark, tmp_path, skip):
    path = str(tmp_path / "raw")
    history.load_raw(run(spark, "a", 1, 2).union(run(spark, None, 4)), path, "version")
    spoil(path)
    assert history.load_raw(run(spark, "b", 3), path, "version", skip=skip)
    if skip != "none":
        assert not history.load_raw(run(spark, "b", 3), path, "version", skip=skip)
    assert [r["v"] for r in spark.read.parquet(f"{path}/version=b").collect()] == [3]
    loads = history.read_loads(spark, path, "version")
    assert sorted((r["version"] or "", r["_rows"]) for r in loads.collect()) == [("", 1), ("a", 2), ("b", 1)]


@pytest.mark.parametrize("skip", ["snapshot", "run", "part"])
@pytest.mark.parametrize("first", [False, True])
def test_a_stopped_load_is_made_again(spark, tmp_path, monkeypatch, skip, first):
    path = str(tmp_path / "raw")
    if not first:
        history.load_raw(run(spark, "z", 9), path, "version")
    snapshot = run(spark, "a", 1, 2).union(run(spark, None, 4))

    def stopped(*_):
        raise InterruptedError

    with monkeypatch.context() as m:
        m.setattr(history, "_note_loads", stopped)
        with pytest.raises(InterruptedError):
            history.load_raw(snapshot, path, "version", skip=skip)
    # rows are there, their entry is not; the first load of all is told from the folders
    assert history.load_raw(snapshot, path, "version", skip=skip) != first
    assert not history.load_raw(snapshot, path, "version", skip=skip)
    assert stored(spark, path) == sorted([("", 4), ("a", 1), ("a", 2)] + ([] if first else [("z", 9)]))


def test_a_table_without_ledger_gets_one(spark, tmp_path):
    path = str(tmp_path / "raw")
    run(spark, "a", 1).withColumn("_part", F.lit("p")).write.partitionBy("version", "_part").parquet(path)
    assert not history.load_raw(run(spark, "a", 1), path, "version")
    spoil(path)
    assert history.load_raw(run(spark, "b", 3), path, "version")
    assert sorted(r["version"] for r in history.read_loads(spark, path, "version").collect()) == ["a", "b"]


def test_a_truncation_begins_a_new_ledger(spark, tmp_path):
    path = str(tmp_path / "raw")
    history.load_raw(run(spark, "a", 1), path, "version")
    history.load_raw(run(spark, "b", 5), path, "version", mode="truncate")
    assert [r["version"] for r in history.read_loads(spark, path, "version").collect()] == ["b"]
    assert history.load_raw(run(spark, "a", 1), path, "version")
    assert history.read_loads(spark, str(tmp_path / "none"), "version") is None


def test_new_columns_are_added(spark, tmp_path):
    path = str(tmp_path / "raw")
    history.load_raw(run(spark, "a", 1), path, "version")
    history.load_raw(run(spark, "b", 2).withColumn("extra", F.lit("x")).select("extra", "v", "version"), path, "version")
    rows = {r["version"]: (r["v"], r["extra"]) for r in read_growing(spark, path).collect()}
    assert rows == {"a": (1, None), "b": (2, "x")}


def test_csv_history_keeps_its_header(spark, tmp_path):
    path = str(tmp_path / "h")
    history.append_csv_history(run(spark, "a", 1), path)
    history.append_csv_history(run(spark, "b", 2).select("v", "version"), path)
    back = spark.read.option("header", True).csv(path)
    assert sorted(tuple(r) for r in back.collect()) == [("a", "1"), ("b", "2")]
    with pytest.raises(ValueError, match="extra"):
        history.append_csv_history(run(spark, "c", 3).withColumn("extra", F.lit(1)), path)


def test_new_runs_keep_rows_without_version(spark):
    incoming = run(spark, "a", 1).union(run(spark, "b", 2)).union(run(spark, None, 3))
    left = history.new_runs(run(spark, "a", 9), incoming, "version")
    assert sorted(r["v"] for r in left.collect()) == [2, 3]


def test_any_run_loaded(spark):
    stored_runs = run(spark, "a", *range(50)).union(run(spark, "b", 1))
    assert history.any_run_loaded(stored_runs, run(spark, "b", 1).union(run(spark, "c", 1)), "version")
    assert not history.any_run_loaded(stored_runs, run(spark, "d", 1).union(run(spark, "c", 1)), "version")
    assert not history.any_run_loaded(stored_runs, run(spark, None, 1), "version")


def test_a_stream_loads_each_run_once(spark, tmp_path):
    landing, raw, check = (str(tmp_path / p) for p in ("in", "raw", "check"))
    schema = run(spark, "a", 1).schema
    for version in ("a", "b", "a"):
        run(spark, version, 1, 2).write.mode("append").parquet(landing)
        ingest_runs(spark, landing, raw, "version", schema, check).awaitTermination()
    assert stored(spark, raw) == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]


def test_digest_ignores_order_and_sees_changes(spark):
    df = spark.range(100).withColumn("s", F.col("id").cast("string"))
    assert sinks.same_content(df, df.repartition(7).select("s", "id"))
    assert not sinks.same_content(df, df.where("id > 0"))
    assert not sinks.same_content(df, df.withColumn("s", F.when(F.col("id") == 3, "x").otherwise(F.col("s"))))
    assert not sinks.same_content(df, df.drop("s"))


def test_sync_repeats_a_broken_copy(spark, tmp_path):
    import shutil

    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    with pytest.raises(RuntimeError):
        sinks.sync_if_changed(spark, source, target)
    for t in ("train", "test"):
        sinks.export_snapshot(spark.range(5), f"{source}/{t}_gold.parquet")
    sinks.write_manifest(sinks.manifest(spark, "now", {"train": 5}), f"{source}/manifest.json")
    assert sinks.sync_if_changed(spark, source, target)
    assert not sinks.sync_if_changed(spark, source, target)
    shutil.rmtree(f"{target}/test_gold.parquet")
    assert sinks.sync_if_changed(spark, source, target)
    assert spark.read.parquet(f"{target}/test_gold.parquet").count() == 5


def test_layer_jobs(spark, sf, tmp_path):
    from workload.fixtures import houses_as_text

    train = houses_as_text(spark, sf, str(tmp_path / "train.csv"))
    test = houses_as_text(spark, sf, str(tmp_path / "test.csv"), "test")
    tables, store = layers.LayerTables("houses_layers"), str(tmp_path / "store")
    for _ in range(2):  # the second run replaces the first
        rows = layers.run_layers(spark, train, test, tables, store, "now", table_root=str(tmp_path / "tables"))
    n = fixture(spark, sf, "houses").count()
    assert set(rows.values()) == {n}
    gold = spark.read.parquet(f"{store}/train_gold.parquet")
    assert gold.columns[:2] == ["Id", "SalePrice"] and gold.count() == n
    assert "SalePrice" not in spark.table("houses_layers.gold_test_features").columns
    assert sinks.read_manifest(spark, f"{store}/manifest.json")["train_rows"] == n


def test_namespace_and_views(spark):
    sinks.ensure_namespace(spark, "some_space")
    sinks.ensure_namespace(spark, "some_space")
    assert sinks.create_views({"v": spark.range(3)}, "core_") == ["core_v"]
    assert spark.table("core_v").count() == 3
