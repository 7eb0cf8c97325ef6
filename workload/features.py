"""Ingest, profile and features of the house table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabmill import defaults
from tabmill.functions.checks import col, numeric_columns, present, require_columns
from tabmill.functions.features import add_features
from tabmill.functions.missing import fill_not_present, fill_zero, infer_types, normalize_missing
from tabmill.functions.ordinal import encode_ordinals
from tabmill.functions.targets import LOG_TARGET, abs_error, has_prediction, rel_error
from tabmill.operators import encode, profile, slotted, windows
from tabmill.operators.ranks import medians
from tabmill.plans import layers
from tabmill.session import scratch_path
from tabmill.sources.readers import read_csv, read_features
from workload.dialects import DUCK, SPARK
from workload.fixtures import (
    HOUSE_NUMBERS, HOUSE_TEXT, LEVELS, NUMBERS, fixture, houses_as_text, table, with_fixtures,
)
from workload.registry import query, rounded

q = DUCK.name
ALL = ["Id", "SalePrice", *HOUSE_NUMBERS, *HOUSE_TEXT]


def columns_sql(names, change=lambda c: None) -> str:
    return ", ".join(f"{change(c) or q(c)} AS {q(c)}" for c in names)


def bronze_cell(c: str) -> str | None:
    """What is left of a house column once the missing tokens are gone."""
    if c in HOUSE_TEXT:
        return f"nullif({q(c)}, 'None')"
    if c == "SalePrice":
        return f"round({q(c)}, 4)"
    return None


def silver_cell(c: str) -> str | None:
    if c in defaults.NONE_FILL:
        return f"coalesce({bronze_cell(c) or q(c)}, 'None')"
    if c in defaults.ZERO_FILL:
        return f"coalesce({q(c)}, 0)"
    return bronze_cell(c)


def scale_sql(value: str, scale) -> str:
    cases = " ".join(f"WHEN '{level}' THEN {len(scale) - 1 - i}" for i, level in enumerate(scale))
    return f"CASE {value} {cases} END"


def gold_cell(c: str) -> str | None:
    if c in defaults.ORDINAL_COLUMNS:
        return scale_sql(silver_cell(c) or q(c), defaults.ORDINAL_COLUMNS[c])
    return silver_cell(c)


def sum_sql(weights, fill=True) -> str:
    return " + ".join(f"{w} * " + (f"coalesce({q(c)}, 0)" if fill else q(c)) for c, w in weights.items())


FEATURES = {
    "HouseAge": f"{q('YrSold')} - {q('YearBuilt')}",
    "RemodAge": f"{q('YrSold')} - {q('YearRemodAdd')}",
    "IsRemodeled": f"CASE WHEN {q('YearRemodAdd')} = {q('YearBuilt')} THEN 0 ELSE 1 END",
    "TotalSF": sum_sql(defaults.FLOOR_AREA),
    "TotalBath": sum_sql(defaults.BATHS),
    "TotalPorchSF": sum_sql(defaults.PORCHES),
    **{f: f"CASE WHEN {q(c)} > 0 THEN 1 ELSE 0 END" for f, c in defaults.PRESENCE_FLAGS.items()},
    "QualSF": f"coalesce({q('OverallQual')}, 0) * coalesce({q('GrLivArea')}, 0)",
}
FEATURES_SQL = ", ".join(f"{expr} AS {q(f)}" for f, expr in FEATURES.items())

BRONZE_SQL = f"SELECT {columns_sql(ALL, bronze_cell)} FROM houses"
SILVER_SQL = f"SELECT {columns_sql(ALL, silver_cell)} FROM houses"
GOLD_SQL = f"SELECT {columns_sql(ALL, gold_cell)}, {FEATURES_SQL} FROM houses"


def _as_numbers(df):
    """Counts and years as doubles: their type depends on whether a value is missing."""
    return df.withColumns({c: col(c).cast("double") for c in numeric_columns(df, ["Id"])})


def _double(sql: str, extra=()) -> str:
    """The same on the other side; text columns stay."""
    names = [c for c in [*ALL, *extra] if c not in HOUSE_TEXT and c != "Id"]
    return f"SELECT * REPLACE ({', '.join(f'cast({q(c)} AS double) AS {q(c)}' for c in names)}) FROM ({sql})"


def _double_gold(sql: str) -> str:
    names = [c for c in [*ALL, *FEATURES] if c != "Id" and (c not in HOUSE_TEXT or c in defaults.ORDINAL_COLUMNS)]
    return f"SELECT * REPLACE ({', '.join(f'cast({q(c)} AS double) AS {q(c)}' for c in names)}) FROM ({sql})"


# --- scans and types ---


@query("csv_scan", with_fixtures("houses", _double(BRONZE_SQL)))
def csv_scan(spark, sf):
    path = houses_as_text(spark, sf, scratch_path(spark, "houses-csv"))
    return rounded(_as_numbers(read_csv(spark, path)))


@query("csv_scan_with_schema", with_fixtures("houses", f"SELECT {columns_sql(['Id', 'GrLivArea', 'MSZoning', 'PoolQC'], bronze_cell)} FROM houses"))
def csv_scan_with_schema(spark, sf):
    path = houses_as_text(spark, sf, scratch_path(spark, "houses-csv"))
    return read_csv(spark, path, "Id bigint, GrLivArea bigint, MSZoning string, PoolQC string")


@query(
    "missing_tokens",
    """SELECT c_custkey, CASE WHEN c_custkey % 5 < 3 THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_name
       FROM customer""",
)
def missing_tokens(spark, sf):
    marked = table(spark, sf, "customer").select(
        "c_custkey", "c_name",
        F.expr("CASE c_custkey % 5 WHEN 0 THEN 'NA' WHEN 1 THEN 'None' WHEN 2 THEN '' ELSE c_mktsegment END").alias("c_mktsegment"),
    )
    return normalize_missing(marked, columns=["c_mktsegment"])


INFERRED = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CASE WHEN count(v) = count(*) FILTER (WHERE regexp_full_match(v, '[+-]?[0-9]+')) THEN
          CASE WHEN count(v) = count(*) THEN 'bigint' ELSE 'double' END
        WHEN count(v) = count(try_cast(v AS double)) THEN 'double' ELSE 'string' END AS "type", count(v) AS non_null
        FROM (SELECT {f"cast({q(c)} AS varchar)" if c not in HOUSE_TEXT else bronze_cell(c)} AS v FROM houses) h"""
    for c in ["Id", "SalePrice", *HOUSE_NUMBERS, *HOUSE_TEXT]
)


@query("inferred_types", with_fixtures("houses", INFERRED))
def inferred_types(spark, sf):
    houses = fixture(spark, sf, "houses")
    text = normalize_missing(houses.select(*[col(c).cast("string").alias(c) for c in houses.columns]))
    return profile.column_info(infer_types(text))


@query(
    "features_by_suffix",
    "SELECT o_orderkey, o_orderpriority, round(o_totalprice, 2) AS o_totalprice, 'csv' AS kind FROM orders UNION ALL"
    " SELECT o_orderkey, o_orderpriority, round(o_totalprice, 2), 'parquet' FROM orders",
)
def features_by_suffix(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    path = scratch_path(spark, "features") + ".csv"
    orders.write.option("header", True).csv(path)
    from_csv = read_features(spark, path).withColumn("kind", F.lit("csv"))
    from_parquet = read_features(spark, f"{sf}/orders.parquet").select(*orders.columns, F.lit("parquet").alias("kind"))
    return rounded(encode.union_all([from_csv, from_parquet]), 2)


# --- layers ---


@query("bronze_layer", with_fixtures("houses", _double(BRONZE_SQL)))
def bronze_layer(spark, sf):
    houses = fixture(spark, sf, "houses")
    text = houses.select(*[F.coalesce(col(c).cast("string"), F.lit("NA")).alias(c) for c in houses.columns])
    return rounded(_as_numbers(layers.bronze(text)))


def _bronze(spark, sf):
    """The house table as the bronze layer stores it."""
    return normalize_missing(fixture(spark, sf, "houses"))


@query("silver_layer", with_fixtures("houses", SILVER_SQL))
def silver_layer(spark, sf):
    return rounded(layers.silver(_bronze(spark, sf)))


@query("gold_layer", with_fixtures("houses", _double_gold(GOLD_SQL)))
def gold_layer(spark, sf):
    return rounded(_as_numbers(layers.gold(layers.silver(_bronze(spark, sf)))))


@query("gold_layer_without_label", with_fixtures("houses", f"SELECT * EXCLUDE ({q('SalePrice')}) FROM ({_double_gold(GOLD_SQL)})"))
def gold_layer_without_label(spark, sf):
    return rounded(_as_numbers(layers.prepare(_bronze(spark, sf).drop("SalePrice"), keys=["Id"])))


@query("not_present_fill", with_fixtures("houses", f"SELECT {q('Id')}, {columns_sql(defaults.NONE_FILL, silver_cell)} FROM houses"))
def not_present_fill(spark, sf):
    return fill_not_present(_bronze(spark, sf).select("Id", *defaults.NONE_FILL))


@query("zero_fill", with_fixtures("houses", f"SELECT {q('Id')}, coalesce({q('GarageYrBlt')}, 0) AS {q('GarageYrBlt')} FROM houses"))
def zero_fill(spark, sf):
    return fill_zero(_bronze(spark, sf).select("Id", "GarageYrBlt"))


@query("row_features", with_fixtures("houses", f"SELECT {q('Id')}, {', '.join(f'cast({e} AS double) AS {q(f)}' for f, e in FEATURES.items())} FROM houses"))
def row_features(spark, sf):
    return _as_numbers(add_features(_bronze(spark, sf)).select("Id", *FEATURES))


EXPLORED = {
    "HouseAge": FEATURES["HouseAge"], "RemodAge": FEATURES["RemodAge"], "TotalSF": sum_sql(defaults.FLOOR_AREA, False),
    "TotalBath": sum_sql(defaults.BATHS, False), "TotalPorchSF": sum_sql(defaults.PORCHES, False),
}


@query("row_features_unfilled", with_fixtures("houses", f"SELECT {q('Id')}, {', '.join(f'cast({e} AS double) AS {q(f)}' for f, e in EXPLORED.items())} FROM houses"))
def row_features_unfilled(spark, sf):
    return _as_numbers(add_features(_bronze(spark, sf), fill_missing=False).select("Id", *EXPLORED))


@query("ordinal_columns", with_fixtures("houses", f"SELECT {q('Id')}, {columns_sql(defaults.ORDINAL_COLUMNS, gold_cell)} FROM houses"))
def ordinal_columns(spark, sf):
    clean = fill_not_present(_bronze(spark, sf).select("Id", *defaults.ORDINAL_COLUMNS))
    return encode_ordinals(clean)


@query("drop_columns", with_fixtures("houses", f"SELECT {q('Id')}, {q('SalePrice')} FROM houses"))
def drop_columns(spark, sf):
    houses = fixture(spark, sf, "houses")
    return houses.drop(*[c for c in houses.columns if c not in ("Id", "SalePrice")])


@query("columns_of_a_type", with_fixtures("houses", f"SELECT {', '.join(q(c) for c in HOUSE_TEXT)} FROM houses"))
def columns_of_a_type(spark, sf):
    from tabmill.functions.checks import string_columns

    houses = fixture(spark, sf, "houses")
    return houses.select(*[col(c) for c in string_columns(houses)])


# --- profile ---

NULLS = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({q(c)}) AS nulls FROM houses" for c in ALL)


@query("null_counts", with_fixtures("houses", NULLS))
def null_counts(spark, sf):
    return profile.null_counts(fixture(spark, sf, "houses"))


@query("columns_with_nulls", with_fixtures("houses", f"SELECT * FROM ({NULLS}) n WHERE nulls > 0"))
def columns_with_nulls(spark, sf):
    return profile.columns_with_nulls(fixture(spark, sf, "houses"))


@query("ten_columns_with_most_nulls", with_fixtures("houses", f'SELECT * FROM ({NULLS}) n ORDER BY nulls DESC, "column" LIMIT 10'))
def ten_columns_with_most_nulls(spark, sf):
    return windows.head(profile.null_counts(fixture(spark, sf, "houses")), 10, F.desc("nulls"), F.asc("column"))


@query("total_nulls", with_fixtures("houses", f"SELECT cast(sum(nulls) AS bigint) AS nulls FROM ({NULLS}) n"))
def total_nulls(spark, sf):
    return profile.total_nulls(fixture(spark, sf, "houses"))


@query("column_info", with_fixtures("houses", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{'string' if c in HOUSE_TEXT else 'double' if c == 'SalePrice' else 'bigint'}' AS \"type\","
    f" count({q(c)}) AS non_null FROM houses" for c in ALL
)))
def column_info(spark, sf):
    return profile.column_info(fixture(spark, sf, "houses"))


@query("value_counts", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def value_counts(spark, sf):
    return profile.value_counts(table(spark, sf, "orders"), "o_orderpriority")


MEDIAN_COLUMNS = ["GrLivArea", "TotalBsmtSF", "LotFrontage", "MasVnrArea", "SalePrice"]


@query("exact_medians", with_fixtures("houses", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(cast(median({q(c)}) AS double), 4) AS median FROM houses" for c in MEDIAN_COLUMNS
)))
def exact_medians(spark, sf):
    found = medians(fixture(spark, sf, "houses"), MEDIAN_COLUMNS)[None]
    return rounded(spark.createDataFrame(list(found.items()), "column string, median double"))


@query("modes", with_fixtures("houses", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", (SELECT v FROM (SELECT {q(c)} AS v, count(*) AS n FROM houses WHERE {q(c)} IS NOT NULL"
    f" GROUP BY 1 ORDER BY n DESC, v LIMIT 1) m) AS mode" for c in ("MasVnrType", "Electrical", "MSZoning")
)))
def modes(spark, sf):
    return profile.modes(fixture(spark, sf, "houses"), ["MasVnrType", "Electrical", "MSZoning"])


SUMMARY_COLUMNS = ["c_mktsegment", "c_name"]


@query("string_summary", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", cast(sum(n) AS bigint) AS "count", count(*) AS "unique",
        arg_min(v, (-n, v)) AS top, max(n) AS freq FROM (SELECT {c} AS v, count(*) AS n FROM customer GROUP BY 1) x"""
    for c in SUMMARY_COLUMNS
))
def string_summary(spark, sf):
    return profile.string_summary(table(spark, sf, "customer"), SUMMARY_COLUMNS)


@query("mixed_content", """SELECT 'mixed' AS "column", count(v) AS "values", count(try_cast(v AS double)) AS numbers FROM (
    SELECT CASE WHEN o_orderkey % 3 = 0 THEN cast(o_custkey AS varchar) ELSE o_orderpriority END AS v FROM orders) x""")
def mixed_content(spark, sf):
    texts = table(spark, sf, "orders").selectExpr(
        "CASE WHEN o_orderkey % 3 = 0 THEN cast(o_custkey AS string) ELSE o_orderpriority END AS mixed",
        "o_orderpriority AS words", "cast(o_custkey AS string) AS digits",
    )
    return profile.mixed_content(texts)


@query("row_count", "SELECT count(*) AS row_count FROM lineitem")
def row_count(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("row_count"))


@query("first_rows", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5")
def first_rows(spark, sf):
    return windows.head(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), 5, F.asc("o_orderkey"))


@query("column_expressions", with_fixtures("cv", """
    SELECT kaggle_id, model_id, round(y_pred_oof, 4) AS y_pred_oof, round(abs(y_true - y_pred_oof), 4) AS abs_error,
           round(abs(y_true - y_pred_oof) / greatest(y_true, 1.0), 8) AS rel_error, 'run-1' AS tag
    FROM cv WHERE y_pred_oof IS NOT NULL"""))
def column_expressions(spark, sf):
    """Errors, literal tags, casts and the filter for rows with a prediction."""
    y, p = F.col("y_true"), F.col("y_pred_oof").cast("double")
    rows = fixture(spark, sf, "cv").where(has_prediction(F.col("y_pred_oof"))).select(
        F.col("kaggle_id").cast("bigint").alias("kaggle_id"), "model_id", p.alias("y_pred_oof"),
        abs_error(y, p).alias("abs_error"), rel_error(y, p).alias("rel_error"), F.lit("run-1").alias("tag"),
    )
    return rounded(rows, rel_error=8)


@query("log_target_round_trip", """SELECT o_orderkey, round(ln(1 + o_totalprice), 8) AS log_price,
       round(exp(ln(1 + o_totalprice)) - 1, 4) AS price FROM orders""")
def log_target_round_trip(spark, sf):
    log_price = LOG_TARGET.forward(F.col("o_totalprice"))
    out = table(spark, sf, "orders").select(
        "o_orderkey", log_price.alias("log_price"), LOG_TARGET.inverse(log_price).alias("price")
    )
    return rounded(out, log_price=8)


# --- encoding ---

MEDIAN_OF = {c: f"(SELECT median({q(c)}) FROM houses)" for c in defaults.MEDIAN_FILL}
MODE_OF = {
    c: f"(SELECT v FROM (SELECT {bronze_cell(c)} AS v, count(*) AS n FROM houses WHERE {bronze_cell(c)} IS NOT NULL"
    f" GROUP BY 1 ORDER BY n DESC, v LIMIT 1) m)" for c in defaults.MODE_FILL
}


@query("global_imputation", with_fixtures("houses", f"SELECT {q('Id')}, " + ", ".join(
    [f"cast(coalesce({q(c)}, {MEDIAN_OF[c]}) AS double) AS {q(c)}" for c in defaults.MEDIAN_FILL]
    + [f"coalesce({bronze_cell(c)}, {MODE_OF[c]}) AS {q(c)}" for c in defaults.MODE_FILL]
) + " FROM houses"))
def global_imputation(spark, sf):
    houses = _bronze(spark, sf).select("Id", *defaults.MEDIAN_FILL, *defaults.MODE_FILL)
    return encode.impute_global(houses, defaults.MEDIAN_FILL, defaults.MODE_FILL)


# customers with gaps in a text column, and few customers per nation
GAPS = {
    d: "SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS segment,"
    f" {d.text('c_nationkey * c_nationkey % 23')} AS region_code FROM {{customer}}"
    for d in (SPARK, DUCK)
}


def _gaps(spark, sf):
    return spark.sql(GAPS[SPARK], customer=table(spark, sf, "customer"))


GAPS_SQL = "WITH gaps AS (" + GAPS[DUCK].format(customer="customer") + ")"
LEVELS_SQL = """
lv AS (SELECT 'segment' AS "column", coalesce(segment, '__missing__') AS "value", count(*) AS n FROM gaps GROUP BY 2
       UNION ALL SELECT 'region_code', region_code, count(*) FROM gaps GROUP BY 2)"""


@query("category_fill", f"{GAPS_SQL} SELECT c_custkey, coalesce(segment, '__missing__') AS segment FROM gaps")
def category_fill(spark, sf):
    return encode.fill_category(_gaps(spark, sf), ["segment"]).select("c_custkey", "segment")


@query("level_frequencies", f"{GAPS_SQL}, {LEVELS_SQL} SELECT \"column\", \"value\", n, cast(n >= 65 AS varchar) AS kept FROM lv")
def level_frequencies(spark, sf):
    return encode.levels(_gaps(spark, sf), ["segment", "region_code"], 65)


@query("level_shares", f"{GAPS_SQL}, {LEVELS_SQL} SELECT \"column\", \"value\", n,"
       " cast(n >= 0.05 * (SELECT count(*) FROM gaps) AS varchar) AS kept FROM lv")
def level_shares(spark, sf):
    return encode.levels(_gaps(spark, sf), ["segment", "region_code"], 0.05)


@query("rare_levels_grouped", f"""{GAPS_SQL}, {LEVELS_SQL}
    SELECT c_custkey, CASE WHEN a.n >= 65 THEN a."value" ELSE '__infrequent__' END AS segment,
           CASE WHEN b.n >= 65 THEN b."value" ELSE '__infrequent__' END AS region_code
    FROM gaps JOIN lv a ON a."column" = 'segment' AND a."value" = coalesce(segment, '__missing__')
              JOIN lv b ON b."column" = 'region_code' AND b."value" = region_code""")
def rare_levels_grouped(spark, sf):
    gaps = _gaps(spark, sf)
    columns = ["segment", "region_code"]
    return encode.group_rare(gaps, encode.levels(gaps, columns, 65), columns)


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("one_hot_columns", f"{GAPS_SQL} SELECT c_custkey, " + ", ".join(
    f"CASE WHEN segment = '{s}' THEN 1 ELSE 0 END AS \"segment_is_{s}\"" for s in SEGMENTS
) + ", CASE WHEN segment IS NULL THEN 1 ELSE 0 END AS \"segment_is___missing__\" FROM gaps")
def one_hot_columns(spark, sf):
    gaps = _gaps(spark, sf).select("c_custkey", "segment")
    return encode.one_hot(gaps, encode.levels(gaps, ["segment"], 1), ["segment"])


@query(
    "numeric_modes",
    """SELECT * FROM (SELECT 'n' AS "column", cast(v AS varchar) AS "mode" FROM (SELECT (c_custkey - 1) // 2 % 13 + 5 AS v, count(*) AS n FROM customer
       GROUP BY 1 ORDER BY n DESC, v LIMIT 1) a)
       UNION ALL SELECT 'd', cast(v AS varchar) FROM (SELECT cast(c_nationkey * 1.5E0 AS double) AS v, count(*) AS n FROM customer GROUP BY 1 ORDER BY n DESC, v LIMIT 1) b
       UNION ALL SELECT 'none', NULL""",
)
def numeric_modes(spark, sf):
    """Ties are settled by number, not by text; a column without values has no mode."""
    customers = table(spark, sf, "customer").select(
        F.expr("(c_custkey - 1) div 2 % 13 + 5").alias("n"), (F.col("c_nationkey") * F.lit(1.5)).alias("d"),
        F.lit(None).cast("string").alias("none"),
    )
    return profile.modes(customers, ["n", "d", "none"])


@query(
    "summary_with_empty_column",
    """SELECT 'seg' AS "column", count(*) AS "count", count(DISTINCT c_mktsegment) AS "unique",
              (SELECT c_mktsegment FROM customer GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top,
              (SELECT count(*) FROM customer GROUP BY c_mktsegment ORDER BY 1 DESC LIMIT 1) AS freq FROM customer
       UNION ALL SELECT 'none', 0, 0, NULL, NULL""",
)
def summary_with_empty_column(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("seg"), F.lit(None).cast("string").alias("none"))
    return profile.string_summary(customers)


@query(
    "gold_with_empty_ordinals",
    with_fixtures("houses", f"SELECT {q('Id')}, cast(NULL AS integer) AS {q('KitchenQual')}, cast(NULL AS integer) AS {q('PavedDrive')} FROM houses"),
)
def gold_with_empty_ordinals(spark, sf):
    """Ordinal columns that arrived without any value, and so as numbers."""
    houses = fixture(spark, sf, "houses").withColumns({c: F.lit(None).cast("double") for c in ("KitchenQual", "PavedDrive")})
    return layers.prepare(houses).select("Id", "KitchenQual", "PavedDrive")


TYPED = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@query(
    "column_types_counted",
    f"""SELECT CASE t WHEN 'VARCHAR' THEN 'string' ELSE lower(t) END AS type, count(*) AS n
        FROM (SELECT unnest([{", ".join(f"typeof(any_value({c}))" for c in TYPED)}]) AS t FROM orders) x GROUP BY 1""",
)
def column_types_counted(spark, sf):
    orders = table(spark, sf, "orders").select(*TYPED)
    found = profile.type_counts(orders)
    return spark.createDataFrame(sorted(found.items()), "type string, n bigint")


@query("columns_present", "SELECT o_orderkey, o_totalprice FROM orders")
def columns_present(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select(*present(orders, ["o_orderkey", "no_such_column", "o_totalprice"]))


@query("required_columns", "SELECT o_orderkey FROM orders")
def required_columns(spark, sf):
    """The table goes on if it has the columns; it is refused if it lacks one."""
    orders = require_columns(table(spark, sf, "orders"), ["o_orderkey"])
    try:
        require_columns(orders, ["o_orderkey", "no_such_column"])
    except ValueError:
        return orders.select("o_orderkey")
    raise AssertionError("a table without a required column went on")


# fitted on some customers and applied to all: rare levels, levels not seen, and names that would clash if they were just joined
CLASHING = {
    d: "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'b_c' WHEN c_custkey % 50 = 1 THEN 'infrequent' ELSE 'z' END AS a,"
    " CASE WHEN c_custkey % 4 = 0 THEN 'c' WHEN c_custkey % 4 = 1 THEN 'is_c' ELSE NULL END AS a_b,"
    f" {d.text('c_nationkey')} AS nation FROM {{customer}}"
    for d in (SPARK, DUCK)
}
RARE_BELOW = 30
CLASHING_SQL = f"""WITH c AS ({CLASHING[DUCK].format(customer="customer")}), fitted AS (SELECT * FROM c WHERE nation <> '7' AND c_custkey % 2 = 1),
    lv AS (SELECT nation, count(*) AS n FROM fitted GROUP BY nation)
    SELECT c_custkey, cast(a = 'b_c' AS integer) AS "a_is_b_c", cast(a = 'infrequent' AS integer) AS "a_is_infrequent",
           cast(a = 'z' AS integer) AS "a_is_z", cast(coalesce(a_b = 'is_c', false) AS integer) AS "a__b_is_is_c",
           cast(a_b IS NULL AS integer) AS "a__b_is___missing__",
           cast(coalesce(n < {RARE_BELOW}, false) AS integer) AS nation_rare, cast(coalesce(n >= {RARE_BELOW}, false) AS integer) AS nation_kept
    FROM c LEFT JOIN lv USING (nation)"""


@query("one_hot_rare_unseen", CLASHING_SQL)
def one_hot_rare_unseen(spark, sf):
    customers = spark.sql(CLASHING[SPARK], customer=table(spark, sf, "customer"))
    fitted = customers.where("nation <> '7' AND c_custkey % 2 = 1")
    counted = encode.levels(fitted, ["a", "a_b"], 1).union(encode.levels(fitted, ["nation"], RARE_BELOW))
    out = encode.one_hot(customers, counted, ["a", "a_b", "nation"])
    kept = [c for c in out.columns if c.startswith("nation_is_")]
    total = sum((F.col(c) for c in kept), F.lit(0))
    return out.withColumn("nation_kept", total).drop(*kept)


SCALED = ["GrLivArea", "OverallQual", "GarageArea"]


@query("scale_statistics", with_fixtures("houses", " UNION ALL ".join(
    f"SELECT -1 AS fold, '{c}' AS \"column\", round(avg({q(c)}), 6) AS mean, round(stddev_pop({q(c)}), 6) AS std FROM houses"
    for c in SCALED
)))
def scale_statistics(spark, sf):
    return rounded(encode.scale_statistics(fixture(spark, sf, "houses"), SCALED), 6)


@query("standardized", with_fixtures("houses", f"SELECT {q('Id')}, " + ", ".join(
    f"round(({q(c)} - avg({q(c)}) OVER ()) / stddev_pop({q(c)}) OVER (), 8) AS {q(c)}" for c in SCALED
) + " FROM houses"))
def standardized(spark, sf):
    houses = fixture(spark, sf, "houses").select("Id", *SCALED)
    # one row per named column
    found = {r["column"]: (r["mean"], r["std"]) for r in encode.scale_statistics(houses, SCALED).collect()}
    return rounded(encode.standardize(houses, found), 8)


assert set(NUMBERS) <= set(HOUSE_NUMBERS) and set(LEVELS) <= set(HOUSE_TEXT)


SLOTTED_SQL = f"""
WITH o AS (SELECT o_orderkey, concat('customer ', o_custkey) AS c0, strftime(o_orderdate, '%Y-%m-%d') AS c1, o_orderpriority AS c2 FROM orders),
lv AS ({" UNION ALL ".join(f"SELECT {i} AS place, coalesce(c{i}, '__missing__') AS v, count(*) >= 10 AS kept FROM o GROUP BY 2" for i in range(3))}),
k AS (SELECT place, CASE WHEN kept THEN v ELSE '' END AS v, NOT kept AS rare FROM lv GROUP BY 1, 2, 3),
s AS (SELECT *, row_number() OVER (ORDER BY place, rare, v) - 1 AS slot FROM k),
d AS (SELECT lv.place, lv.v, slot FROM lv JOIN s ON s.place = lv.place AND s.rare = (NOT kept) AND (s.rare OR s.v = lv.v))
SELECT o_orderkey, cast(d0.slot AS integer) AS customer_slot, cast(d1.slot AS integer) AS day_slot, cast(d2.slot AS integer) AS priority_slot
FROM o JOIN d d0 ON d0.place = 0 AND d0.v = coalesce(c0, '__missing__') JOIN d d1 ON d1.place = 1 AND d1.v = coalesce(c1, '__missing__')
JOIN d d2 ON d2.place = 2 AND d2.v = coalesce(c2, '__missing__')"""


@query("one_hot_slots", SLOTTED_SQL)
def one_hot_slots(spark, sf):
    """Levels that grow with the table, encoded by a stored table of slots; the slots of a row, one for each column."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("customer "), "o_custkey").alias("c0"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("c1"),
        F.col("o_orderpriority").alias("c2"),
    )
    columns = ["c0", "c1", "c2"]
    slots = slotted.slot_table(encode.levels(orders, columns, 10), columns)
    listed = slotted.slot_lists(orders, slots, columns, spread_by=["o_orderkey"])
    return listed.select("o_orderkey", *[F.get("slots", F.lit(i)).alias(n) for i, n in enumerate(("customer_slot", "day_slot", "priority_slot"))])
