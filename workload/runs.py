"""Tables, snapshots, run history and loads that run once. Every query writes below a new folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabmill.functions.targets import has_prediction
from tabmill.operators.profile import layer_report
from tabmill.plans import layers, marts
from tabmill.plans.views import apply_views
from tabmill.session import scratch_path
from tabmill.sources import history, sinks
from tabmill.sources.readers import read_csv, read_growing, read_optional, read_table
from workload.dialects import DUCK, SPARK, epoch_ts, text_of
from workload.fixtures import fixture, houses_as_text, table, with_fixtures
from workload.marts import CV_ROUND, FLAGS
from workload.registry import SQL, query, rounded

MODELS_ROUND = "SELECT * REPLACE (round(cv_rmse_mean, 6) AS cv_rmse_mean) FROM"


def _table_name(label: str) -> str:
    """A catalog name of this run only."""
    import uuid

    return f"{label}_{uuid.uuid4().hex[:12]}"


@query("catalog_scan", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def catalog_scan(spark, sf):
    name = _table_name("orders_scan")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    sinks.overwrite_table(orders, name, path=scratch_path(spark, name))
    return read_table(spark, name)


@query("overwritten_table", "SELECT o_orderkey, o_custkey AS customer FROM orders")
def overwritten_table(spark, sf):
    """The second write replaces rows and schema of the first."""
    orders, name = table(spark, sf, "orders"), _table_name("orders_replaced")
    sinks.overwrite_table(orders.select("o_orderkey", "o_totalprice"), name, path=scratch_path(spark, name))
    sinks.overwrite_table(
        orders.select("o_orderkey", F.col("o_custkey").alias("customer")), name, path=scratch_path(spark, name)
    )
    return read_table(spark, name)


@query("table_in_namespace", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def table_in_namespace(spark, sf):
    """A namespace that is made when needed, and a table within it."""
    sinks.ensure_namespace(spark, "tabmill_probe")
    name = "tabmill_probe." + _table_name("orders")
    days = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    sinks.overwrite_table(days, name, path=scratch_path(spark, "orders"))
    return read_table(spark, name)


@query(
    "layer_report",
    "SELECT 'lineitem' AS layer, count(*) AS \"rows\" FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders",
)
def layer_row_counts(spark, sf):
    return layer_report(lineitem=table(spark, sf, "lineitem"), orders=table(spark, sf, "orders"))


@query("rows_written", "SELECT 'orders' AS layer, count(*) AS \"rows\" FROM orders")
def rows_written(spark, sf):
    """The count comes from the write itself."""
    orders = table(spark, sf, "orders")
    rows = sinks.export_snapshot(orders, scratch_path(spark, "counted"))
    return spark.range(1).select(F.lit("orders").alias("layer"), F.lit(rows).cast("bigint").alias("rows"))


@query("snapshot_export", with_fixtures("cv", f"SELECT * REPLACE ({CV_ROUND}) FROM cv"))
def snapshot_export(spark, sf):
    path = scratch_path(spark, "snapshot")
    sinks.export_snapshot(fixture(spark, sf, "cv"), path)
    sinks.export_snapshot(fixture(spark, sf, "cv"), path)
    return rounded(spark.read.parquet(path), rel_error=8)


@query(
    "growing_history",
    with_fixtures(
        "cv",
        "SELECT kaggle_id, model_id, round(y_true, 4) AS y_true, cast(NULL AS varchar) AS note FROM cv WHERE kaggle_id % 2 = 0"
        " UNION ALL SELECT kaggle_id, model_id, round(y_true, 4), 'second' FROM cv WHERE kaggle_id % 2 = 1",
    ),
)
def growing_history(spark, sf):
    """Two runs with their columns in different order, the second with one more."""
    cv, path = fixture(spark, sf, "cv"), scratch_path(spark, "history")
    history.append_history(cv.where("kaggle_id % 2 = 0").select("kaggle_id", "model_id", "y_true"), path)
    second = cv.where("kaggle_id % 2 = 1").select("y_true", F.lit("second").alias("note"), "model_id", "kaggle_id")
    history.append_history(second, path)
    return rounded(read_growing(spark, path))


@query(
    "csv_history",
    with_fixtures("cv", "SELECT kaggle_id, model_id, round(y_true, 4) AS y_true FROM cv"),
)
def csv_history(spark, sf):
    cv, path = fixture(spark, sf, "cv"), scratch_path(spark, "history-csv")
    history.append_csv_history(cv.where("kaggle_id % 2 = 0").select("kaggle_id", "model_id", "y_true"), path)
    history.append_csv_history(cv.where("kaggle_id % 2 = 1").select("y_true", "model_id", "kaggle_id"), path)
    return rounded(read_csv(spark, path, "kaggle_id bigint, model_id string, y_true double"))


# quotes, commas, blanks, line breaks and backslashes
UGLY = {
    d: "SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN concat('say \"hi\", ', o_orderstatus) WHEN 1 THEN concat('  ', o_orderstatus, ' ')"
    f" WHEN 2 THEN concat(o_orderstatus, {br}, 'second line, \"quoted\"') WHEN 3 THEN concat('back', {bs}, 'slash', {bs}) WHEN 4 THEN '\"'"
    f" WHEN 5 THEN concat({bs}, '\"', ',') WHEN 6 THEN NULL ELSE o_orderstatus END AS note, o_orderpriority FROM {{orders}}"
    for d, br, bs in ((SPARK, "chr(10)", "chr(92)"), (DUCK, "chr(10)", "chr(92)"))
}


@query("csv_fidelity", f"SELECT o_orderkey, note, o_orderpriority AS version FROM ({UGLY[DUCK].format(orders='orders')}) u")
def csv_fidelity(spark, sf):
    """Through a CSV history in two appends, rebuilt as a RAW table: every text as it was."""
    csv, raw = scratch_path(spark, "history-csv"), scratch_path(spark, "raw")
    rows = spark.sql(UGLY[SPARK], orders=table(spark, sf, "orders")).withColumnRenamed("o_orderpriority", "version")
    for part in ("o_orderkey % 2 = 0", "o_orderkey % 2 = 1"):
        history.append_csv_history(rows.where(part), csv)
    history.rebuild_raw(spark, {"models": csv}, raw)
    return history.read_raw(spark, f"{raw}/models").select("o_orderkey", "note", "version")


@query(
    "union_of_runs",
    with_fixtures(
        "cv predictions",
        "SELECT kaggle_id, model_id, round(y_pred_oof, 4) AS y_pred_oof, NULL::double AS predicted_price FROM cv"
        " UNION ALL SELECT kaggle_id, model_id, NULL, round(predicted_price, 4) FROM predictions",
    ),
)
def union_of_runs(spark, sf):
    cv = fixture(spark, sf, "cv").select("kaggle_id", "model_id", "y_pred_oof")
    predictions = fixture(spark, sf, "predictions").select("predicted_price", "model_id", "kaggle_id")
    return rounded(history.union_runs(cv, predictions))


@query(
    "sync_if_changed",
    "SELECT part, o_orderkey, o_totalprice * 2 AS o_totalprice, 'true false true' AS copied"
    " FROM orders, (VALUES ('train'), ('test')) t(part)",
)
def sync_if_changed(spark, sf):
    """The copy after three calls: a first one, one that finds nothing new, one after all prices were doubled."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    source, target = scratch_path(spark, "store"), scratch_path(spark, "copy")
    steps = []
    for stamp, factor in (("1", 1), ("1", 1), ("2", 2)):
        priced = orders.withColumn("o_totalprice", F.col("o_totalprice") * factor)
        if len(steps) != 1:
            rows = {t: sinks.export_snapshot(priced, f"{source}/{t}_gold.parquet") for t in ("train", "test")}
            sinks.write_manifest(sinks.manifest(spark, stamp, rows), f"{source}/manifest.json")
        steps.append(str(sinks.sync_if_changed(spark, source, target)).lower())
    copies = [spark.read.parquet(f"{target}/{t}_gold.parquet").withColumn("part", F.lit(t)) for t in ("train", "test")]
    return copies[0].unionByName(copies[1]).withColumn("copied", F.lit(" ".join(steps)))


@query(
    "content_compared",
    "SELECT 'same rows in another order' AS pair, 'true' AS same UNION ALL SELECT 'one value differs', 'false'",
)
def content_compared(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    shuffled = orders.repartition(5, "o_totalprice").select("o_totalprice", "o_orderkey")
    other = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") == 1, 0.0).otherwise(F.col("o_totalprice")))
    pairs = [
        ("same rows in another order", sinks.same_content(orders, shuffled)),
        ("one value differs", sinks.same_content(orders, other)),
    ]
    return spark.createDataFrame(pairs, "pair string, same boolean")


# --- RAW loads ---


def _halves(spark, sf):
    """Two snapshots that share the runs of 1995."""
    models = fixture(spark, sf, "models")
    return models.where("version < '1996'"), models.where("version >= '1995' OR version = 'manual-run'")


@query("distinct_runs", with_fixtures("models", "SELECT DISTINCT version FROM models"))
def distinct_runs(spark, sf):
    return history.distinct_runs(fixture(spark, sf, "models"), "version")


@query(
    "runs_already_loaded",
    with_fixtures("models", "SELECT DISTINCT version FROM models WHERE version >= '1995' AND version < '1996'"),
)
def runs_already_loaded(spark, sf):
    first, second = _halves(spark, sf)
    return history.runs_already_loaded(first, second, "version")


@query(
    "new_runs",
    with_fixtures("models", text_of(f"{MODELS_ROUND} models WHERE version >= '1996'", flags=FLAGS)),
)
def new_runs(spark, sf):
    first, second = _halves(spark, sf)
    return rounded(history.new_runs(first, second, "version"), cv_rmse_mean=6, r2_test=6)


@query(
    "any_run_loaded",
    with_fixtures(
        "models",
        """WITH a AS (SELECT DISTINCT version FROM models WHERE version < '1996'),
           b AS (SELECT DISTINCT version FROM models WHERE version >= '1995' OR version = 'manual-run')
           SELECT 'shared runs' AS pair, cast(EXISTS (SELECT 1 FROM a JOIN b USING (version)) AS varchar) AS loaded
           UNION ALL SELECT 'no shared run', cast(EXISTS (SELECT 1 FROM a JOIN b USING (version) WHERE version >= '1996') AS varchar)""",
    ),
)
def any_run_loaded(spark, sf):
    first, second = _halves(spark, sf)
    pairs = [
        ("shared runs", history.any_run_loaded(first, second, "version")),
        ("no shared run", history.any_run_loaded(first, second.where("version >= '1996'"), "version")),
    ]
    return spark.createDataFrame(pairs, "pair string, loaded boolean")


def _loaded(spark, path):
    return rounded(history.read_raw(spark, path), cv_rmse_mean=6, r2_test=6)


@query(
    "raw_load",
    with_fixtures(
        "models",
        text_of(
            "SELECT * REPLACE (round(cv_rmse_mean, 6) AS cv_rmse_mean), CASE WHEN version >= '1996' THEN 'later' END AS stage"
            " FROM models WHERE version < '1996' OR version >= '1996'",
            flags=FLAGS,
        ),
    ),
)
def raw_load(spark, sf):
    """Append; the second snapshot has one more column."""
    models, path = fixture(spark, sf, "models"), scratch_path(spark, "raw")
    history.load_raw(models.where("version < '1996'"), path, "version")
    history.load_raw(models.where("version >= '1996'").withColumn("stage", F.lit("later")), path, "version")
    return _loaded(spark, path)


@query("raw_load_truncate", with_fixtures("models", text_of(f"{MODELS_ROUND} models WHERE version >= '1996'", flags=FLAGS)))
def raw_load_truncate(spark, sf):
    models, path = fixture(spark, sf, "models"), scratch_path(spark, "raw")
    history.load_raw(models, path, "version")
    history.load_raw(models.where("version >= '1996'"), path, "version", mode="truncate")
    return _loaded(spark, path)


@query("raw_load_once", with_fixtures("models", text_of(f"{MODELS_ROUND} models WHERE version < '1996'", flags=FLAGS)))
def raw_load_once(spark, sf):
    """The second snapshot shares runs with the table, so all of it is skipped."""
    first, second = _halves(spark, sf)
    path = scratch_path(spark, "raw")
    for snapshot in (first, first, second):
        history.load_raw(snapshot, path, "version")
    return _loaded(spark, path)


@query("raw_load_new_runs", with_fixtures("models", text_of(f"{MODELS_ROUND} models", flags=FLAGS)))
def raw_load_new_runs(spark, sf):
    """Of the second snapshot the runs not stored yet are loaded."""
    first, second = _halves(spark, sf)
    path = scratch_path(spark, "raw")
    for snapshot in (first, second, second):
        history.load_raw(snapshot, path, "version", skip="run")
    return _loaded(spark, path)


@query(
    "raw_load_always",
    with_fixtures(
        "models", text_of(f"{MODELS_ROUND} (SELECT * FROM models UNION ALL SELECT * FROM models) m", flags=FLAGS)
    ),
)
def raw_load_always(spark, sf):
    models, path = fixture(spark, sf, "models"), scratch_path(spark, "raw")
    for _ in range(2):
        history.load_raw(models, path, "version", skip="none")
    return _loaded(spark, path)


@query(
    "raw_rebuild",
    with_fixtures(
        "cv",
        text_of(
            f"""SELECT kaggle_id, model_id, model_version, round(y_true, 4) AS y_true,
                CASE WHEN kaggle_id % 7 <> 0 THEN {epoch_ts('created_at_utc')} END AS created_at_utc FROM cv""",
            ("created_at_utc",),
        ),
    ),
)
def raw_rebuild(spark, sf):
    """From the CSV history; load times that cannot be read become NULL, the two tables without
    history are left out."""
    from tabmill.functions.times import epoch_to_timestamp

    csv, raw = scratch_path(spark, "history-csv"), scratch_path(spark, "raw")
    at = F.date_format(epoch_to_timestamp(F.col("created_at_utc")), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    history.append_csv_history(
        fixture(spark, sf, "cv").select(
            "kaggle_id", "model_id", "model_version", "y_true",
            F.when(F.col("kaggle_id") % 7 == 0, "unknown").otherwise(at).alias("created_at_utc"),
        ),
        csv,
    )
    history.rebuild_raw(spark, {"train_cv_predictions": csv}, raw)
    return rounded(history.read_raw(spark, f"{raw}/train_cv_predictions"))


@query(
    "load_all_tables",
    with_fixtures(
        "models cv",
        "SELECT 'models' AS run_table, 'loaded' AS first_load, 'skipped' AS second_load, (SELECT count(*) FROM models) AS stored"
        " UNION ALL SELECT 'train_cv_predictions', 'loaded', 'skipped', (SELECT count(*) FROM cv)"
        " UNION ALL SELECT 'predictions', 'absent', 'absent', 0",
    ),
)
def load_all_tables(spark, sf):
    """Snapshots of two of the three tables exist; loading them again changes nothing."""
    root, raw = scratch_path(spark, "snapshots"), scratch_path(spark, "raw")
    sinks.export_snapshot(fixture(spark, sf, "models"), f"{root}/models.parquet")
    sinks.export_snapshot(fixture(spark, sf, "cv"), f"{root}/train_cv_predictions.parquet")
    paths = {t: f"{root}/{t}.parquet" for t in history.RUN_TABLES}
    first = history.load_all(spark, paths, raw)
    second = history.load_all(spark, paths, raw)
    found = {t: history.read_raw(spark, f"{raw}/{t}") for t in first}
    return spark.createDataFrame(
        [(t, first[t], second[t], df.count() if (df := found[t]) is not None else 0) for t in first],
        "run_table string, first_load string, second_load string, stored bigint",
    )


@query(
    "predictions_dropped",
    with_fixtures(
        "cv",
        "SELECT kaggle_id, model_id, round(y_pred_oof, 4) AS y_pred_oof FROM cv WHERE kaggle_id % 10 > 1",
    ),
)
def predictions_dropped(spark, sf):
    """Rows whose prediction is missing or no number are left out."""
    cv = fixture(spark, sf, "cv").select("kaggle_id", "model_id", "y_pred_oof")
    gaps = F.when(F.col("kaggle_id") % 10 == 0, F.lit(None)).when(F.col("kaggle_id") % 10 == 1, float("nan")).otherwise(F.col("y_pred_oof"))
    holed = cv.withColumn("y_pred_oof", gaps)
    return rounded(holed.where(has_prediction(F.col("y_pred_oof"))))


@query("optional_inputs", "SELECT 'orders' AS input, count(*) AS \"rows\" FROM orders")
def optional_inputs(spark, sf):
    found = read_optional(spark, {"orders": f"{sf}/orders.parquet", "returns": f"{sf}/returns.parquet"})
    return layer_report(**found).withColumnRenamed("layer", "input")


@query("run_filter", "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def run_filter(spark, sf):
    """A list that the scan filters by."""
    return table(spark, sf, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).select("o_orderkey")


@query(
    "existence",
    "SELECT 'urgent' AS probe, cast(EXISTS (SELECT 1 FROM orders WHERE o_orderpriority = '1-URGENT') AS varchar) AS found"
    " UNION ALL SELECT 'no such status', cast(EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'X') AS varchar)",
)
def existence(spark, sf):
    orders = table(spark, sf, "orders")
    probes = [
        ("urgent", not orders.where("o_orderpriority = '1-URGENT'").isEmpty()),
        ("no such status", not orders.where("o_orderstatus = 'X'").isEmpty()),
    ]
    return spark.createDataFrame(probes, "probe string, found boolean")


@query(
    "submission",
    with_fixtures("predictions", 'SELECT kaggle_id AS "Id", predicted_price AS "SalePrice" FROM predictions'),
)
def submission(spark, sf):
    path = scratch_path(spark, "submission")
    sinks.export_submission(fixture(spark, sf, "predictions"), path)
    return spark.read.option("header", True).schema("Id bigint, SalePrice double").csv(path)


@query(
    "manifest",
    "SELECT '2024-01-31T00:00:00' AS created_at_utc, 'gold_train' AS gold_train_table, (SELECT count(*) FROM orders) AS train_rows",
)
def manifest(spark, sf):
    path = scratch_path(spark, "manifest")
    rows = table(spark, sf, "orders").count()
    sinks.write_manifest(sinks.manifest(spark, "2024-01-31T00:00:00", {"train": rows}, gold_train_table="gold_train"), path)
    return spark.read.schema("created_at_utc string, gold_train_table string, train_rows bigint").json(path)


@query(
    "layer_jobs",
    "SELECT layer, n AS \"rows\" FROM (SELECT unnest(['bronze_train', 'silver_train', 'gold_train', 'bronze_test',"
    " 'silver_test', 'gold_test']) AS layer), (SELECT count(*) AS n FROM orders) c",
)
def layer_jobs(spark, sf):
    """From two CSV files through all layer tables to the feature store."""
    root = scratch_path(spark, "layers")
    train = houses_as_text(spark, sf, f"{root}/train.csv")
    test = houses_as_text(spark, sf, f"{root}/test.csv", "test")
    tables = layers.LayerTables(_table_name("layers"))
    rows = layers.run_layers(spark, train, test, tables, f"{root}/store", "2024-01-31T00:00:00", table_root=f"{root}/tables")
    return spark.createDataFrame(list(rows.items()), "layer string, rows bigint")


@query(
    "incremental_ingest",
    with_fixtures("models", text_of(f"{MODELS_ROUND} models", flags=FLAGS)),
)
def incremental_ingest(spark, sf):
    """Snapshots as a stream of files: the second arrives twice and is loaded once."""
    from tabmill.streaming.ingest import ingest_runs

    models = fixture(spark, sf, "models")
    landing, raw, checkpoint = (scratch_path(spark, x) for x in ("landing", "raw", "stream"))
    schema = models.schema
    for part in ("version < '1996'", "version >= '1996'", "version >= '1996'"):
        models.where(part).write.mode("append").parquet(landing)
        ingest_runs(spark, landing, raw, "version", schema, checkpoint).awaitTermination()
    return _loaded(spark, raw)


@query(
    "ingest_run_in_parts",
    with_fixtures("models", text_of(f"{MODELS_ROUND} models", flags=FLAGS)),
)
def ingest_run_in_parts(spark, sf):
    """Each run arrives in three deliveries, rows without a version too, and the second one comes twice."""
    from tabmill.streaming.ingest import ingest_runs

    models = fixture(spark, sf, "models")
    landing, raw, checkpoint = (scratch_path(spark, x) for x in ("landing", "raw", "stream"))
    part = F.pmod(F.xxhash64("id", "cv_rmse_mean"), F.lit(3))
    for delivery in (0, 1, 1, 2):
        models.where(part == delivery).write.mode("append").parquet(landing)
        ingest_runs(spark, landing, raw, "version", models.schema, checkpoint).awaitTermination()
    return _loaded(spark, raw)


@query(
    "raw_to_views",
    with_fixtures(
        "models",
        f"""SELECT id, round(cv_rmse_mean, 6) AS cv_rmse_mean FROM (
              SELECT *, row_number() OVER (PARTITION BY id ORDER BY {epoch_ts('created_at_utc')} DESC NULLS LAST,
                                           cv_rmse_mean NULLS FIRST) AS rn FROM models) m WHERE rn = 1""",
    ),
)
def raw_to_views(spark, sf):
    """Load, skip, load with one more column, register, views: what a warehouse user reads."""
    raw, names = scratch_path(spark, "raw"), [_table_name(n) for n in ("raw", "core", "marts")]
    models = fixture(spark, sf, "models")
    early, late = models.where("version < '1996'"), models.where("version >= '1996'").withColumn("stage", F.lit("later"))
    for snapshot in (early, early, late):
        history.load_raw(snapshot, f"{raw}/models", "version")
    history.load_raw(fixture(spark, sf, "cv"), f"{raw}/train_cv_predictions", "model_version")
    history.load_raw(fixture(spark, sf, "predictions"), f"{raw}/predictions", "model_version")
    sinks.ensure_namespace(spark, names[0])
    history.register_all(spark, raw, names[0])
    apply_views(spark, *names)
    return rounded(spark.table(f"{names[1]}.v_models").select("id", "cv_rmse_mean"), 6)


@query(
    "latest_of_history",
    with_fixtures(
        "models",
        f"""SELECT id, round(cv_rmse_mean, 6) AS cv_rmse_mean FROM (
              SELECT *, row_number() OVER (PARTITION BY id ORDER BY {epoch_ts('created_at_utc')} DESC NULLS LAST,
                                           cv_rmse_mean NULLS FIRST) AS rn FROM models) m WHERE rn = 1""",
    ),
)
def latest_of_history(spark, sf):
    """The core view over a history that was loaded twice without skipping."""
    models, path = fixture(spark, sf, "models"), scratch_path(spark, "raw")
    for _ in range(2):
        history.load_raw(models, path, "version", skip="none")
    return rounded(marts.core_models(history.read_raw(spark, path), ["cv_rmse_mean"]).select("id", "cv_rmse_mean"), 6)


def _catalog_views(spark, sf):
    """RAW tables of a new namespace with the views over them; returns the namespaces."""
    raw, core, mart = (_table_name(n) for n in ("raw", "core", "marts"))
    sinks.ensure_namespace(spark, raw)
    for name, source in (("models", "models"), ("train_cv_predictions", "cv"), ("predictions", "predictions")):
        sinks.overwrite_table(fixture(spark, sf, source), f"{raw}.{name}", path=scratch_path(spark, f"{raw}-{name}"))
    apply_views(spark, raw, core, mart)
    return core, mart


# in the views all remaining columns settle ties, so the row with the smaller prediction wins as well
@query("view_cv_error_by_bucket", SQL["cv_error_by_bucket"])
def view_cv_error_by_bucket(spark, sf):
    _, mart = _catalog_views(spark, sf)
    return rounded(spark.table(f"{mart}.cv_error_by_bucket"), mean_rel_error=8)


@query("view_champion_by_run", SQL["champion_by_run"])
def view_champion_by_run(spark, sf):
    _, mart = _catalog_views(spark, sf)
    return rounded(spark.table(f"{mart}.champion_by_run"), cv_rmse_mean=6, r2_test=6)


@query("view_predictions_latest_champion", SQL["predictions_latest_champion"])
def view_predictions_latest_champion(spark, sf):
    _, mart = _catalog_views(spark, sf)
    return spark.table(f"{mart}.predictions_latest_champion")


@query("view_top_outliers", SQL["top_outliers"])
def view_top_outliers(spark, sf):
    _, mart = _catalog_views(spark, sf)
    return rounded(spark.table(f"{mart}.top_outliers"), rel_error=8)


@query("view_core_models", SQL["core_models"])
def view_core_models(spark, sf):
    core, _ = _catalog_views(spark, sf)
    return rounded(spark.table(f"{core}.v_models"), cv_rmse_mean=6, r2_test=6)
