"""Folds, fitted statistics, cross-validation and model comparison on the house table."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabmill.functions.targets import LOG_TARGET, RAW_TARGET
from tabmill.ml import regressors
from tabmill.ml.compiled import LinearFormula, compile_linear
from tabmill.ml.permute import permutation_importances
from tabmill.ml.prep import CategoryCast, FeaturePrep, feature_names, top_importances
from tabmill.ml.target import TransformedTargetModel
from tabmill.operators import choose, encode, folds, linear, metrics, sketches
from tabmill.plans import layers, training
from tabmill.plans.scoring import score, score_with_stored
from tabmill.session import materialize, scratch_path, shared_root
from workload.dialects import DUCK, SPARK, hash_bucket
from workload.fixtures import fixture, table, with_fixtures
from workload.registry import query, rounded

q = DUCK.name
K = 5
FOLD = hash_bucket('"Id"', "42:fold", K)
HOLDOUT = f"({hash_bucket(chr(34) + 'Id' + chr(34), '42:split', 100)}) < 20"
FOLDED = f"folded AS (SELECT *, {FOLD} AS fold FROM houses)"
ALL_FOLDS = f"ks AS (SELECT unnest(range({K})) AS k)"


def _folded(spark, sf):
    return folds.assign_folds(fixture(spark, sf, "houses"), "Id", K)


# --- folds ---


@query("holdout_split", with_fixtures("houses", f"SELECT {q('Id')}, cast({HOLDOUT} AS varchar) AS is_holdout FROM houses"))
def holdout_split(spark, sf):
    return folds.mark_holdout(fixture(spark, sf, "houses").select("Id"), "Id")


@query("shuffled_folds", with_fixtures("houses", f"WITH {FOLDED} SELECT {q('Id')}, cast(fold AS integer) AS fold FROM folded"))
def shuffled_folds(spark, sf):
    return _folded(spark, sf).select("Id", "fold")


@query(
    "contiguous_folds",
    with_fixtures(
        "houses",
        f"""SELECT {q('Id')}, cast(CASE WHEN pos < (n % {K}) * (n // {K} + 1) THEN pos // (n // {K} + 1)
              ELSE (pos - (n % {K}) * (n // {K} + 1)) // (n // {K}) + n % {K} END AS integer) AS fold
            FROM (SELECT {q('Id')}, row_number() OVER (ORDER BY {q('Id')}) - 1 AS pos, count(*) OVER () AS n FROM houses) h""",
    ),
)
def contiguous_folds(spark, sf):
    return folds.contiguous_folds(fixture(spark, sf, "houses").select("Id"), "Id", K)


# text keys that share long beginnings
TEXT_KEY = {d: f"SELECT concat('order-key-', {d.text('o_orderkey % 7')}, '-', {d.text('o_orderkey')}) AS key FROM {{orders}}" for d in (SPARK, DUCK)}


@query(
    "contiguous_folds_text_key",
    f"""SELECT key, cast(CASE WHEN pos < (n % {K}) * (n // {K} + 1) THEN pos // (n // {K} + 1)
          ELSE (pos - (n % {K}) * (n // {K} + 1)) // (n // {K}) + n % {K} END AS integer) AS fold
        FROM (SELECT key, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS n
              FROM ({TEXT_KEY[DUCK].format(orders="orders")}) k) h""",
)
def contiguous_folds_text_key(spark, sf):
    return folds.contiguous_folds(spark.sql(TEXT_KEY[SPARK], orders=table(spark, sf, "orders")), "key", K)


@query(
    "folds_with_missing_keys",
    f"""SELECT CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey END AS key, cast(CASE WHEN o_orderkey % 4 <> 0 THEN
          {hash_bucket('o_orderkey', '42:fold', K)} END AS integer) AS fold, 1 AS has_fold, 1 AS has_flag FROM orders""",
)
def folds_with_missing_keys(spark, sf):
    """Every row has a fold and a flag, also where its key is missing; which one is fixed by the key where there is one."""
    keyed = table(spark, sf, "orders").select(F.expr("CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey END").alias("key"), "o_custkey", "o_totalprice")
    marked = folds.mark_holdout(
        folds.assign_folds(keyed, "key", K, spread_by=["o_custkey", "o_totalprice"]), "key", spread_by=["o_custkey", "o_totalprice"]
    )
    return marked.select(
        "key", F.when(F.col("key").isNotNull(), F.col("fold")).alias("fold"),
        F.col("fold").isNotNull().cast("int").alias("has_fold"), F.col("is_holdout").isNotNull().cast("int").alias("has_flag"),
    )


# --- statistics per fold ---

IMPUTED = ["GrLivArea", "TotalBsmtSF", "GarageArea"]
FOLD_MEDIANS = " UNION ALL ".join(
    f"SELECT cast(k AS integer) AS fold, '{c}' AS \"column\", cast(median({q(c)}) AS double) AS median"
    f" FROM ks JOIN folded ON fold <> k GROUP BY k" for c in IMPUTED
)


@query("fold_medians", with_fixtures("houses", f"WITH {FOLDED}, {ALL_FOLDS} {FOLD_MEDIANS}"))
def fold_medians(spark, sf):
    return encode.fold_medians(_folded(spark, sf), IMPUTED)


SKETCHED = " UNION ALL ".join(
    f"SELECT cast(k AS integer) AS fold, '{c}' AS \"column\", count({q(c)}) AS n, 'true' AS near FROM ks JOIN folded ON fold <> k GROUP BY k" for c in IMPUTED
)


@query("fold_medians_sketched", with_fixtures("houses", f"WITH {FOLDED}, {ALL_FOLDS} {SKETCHED}"))
def fold_medians_sketched(spark, sf):
    """Sketched medians and, counted over the table, whether their ranks lie within twice the stated error (a sketch may miss it once)."""
    folded = _folded(spark, sf)
    found = sketches.fold_medians(folded, IMPUTED).collect()  # one row per fold and column
    ranks = folded.agg(F.array(*[
        F.struct(
            F.lit(r["fold"]).alias("fold"), F.lit(r["column"]).alias("column"), F.lit(r["n"]).alias("n"),
            F.count_if((F.col("fold") != r["fold"]) & (F.col(r["column"]) < r["median"])).alias("below"),
            F.count_if((F.col("fold") != r["fold"]) & (F.col(r["column"]) <= r["median"])).alias("upto"),
        )
        for r in found
    ]).alias("ranks")).select(F.inline("ranks"))
    share = 2 * sketches.rank_error()
    near = (F.col("below") <= (0.5 + share) * F.col("n")) & (F.col("upto") >= (0.5 - share) * F.col("n"))
    return ranks.select("fold", "column", "n", near.alias("near"))


@query(
    "fold_imputation",
    with_fixtures(
        "houses",
        f"WITH {FOLDED}, {ALL_FOLDS}, med AS ({FOLD_MEDIANS}) SELECT {q('Id')}, cast(fold AS integer) AS fold, "
        + ", ".join(
            f"coalesce(cast({q(c)} AS double), (SELECT median FROM med WHERE \"column\" = '{c}' AND med.fold = folded.fold)) AS {q(c)}"
            for c in IMPUTED
        )
        + " FROM folded",
    ),
)
def fold_imputation(spark, sf):
    return encode.impute_by_fold(_folded(spark, sf).select("Id", "fold", *IMPUTED), IMPUTED).select("Id", "fold", *IMPUTED)


@query(
    "fold_scale_statistics",
    with_fixtures(
        "houses",
        f"WITH {FOLDED}, {ALL_FOLDS} " + " UNION ALL ".join(
            f"SELECT cast(k AS integer) AS fold, '{c}' AS \"column\", round(avg({q(c)}), 6) AS mean, round(stddev_pop({q(c)}), 6) AS std"
            f" FROM ks JOIN folded ON fold <> k GROUP BY k" for c in IMPUTED
        ),
    ),
)
def fold_scale_statistics(spark, sf):
    return rounded(encode.scale_statistics(_folded(spark, sf), IMPUTED, "fold", K), 6)


# --- regression on one feature: exact ---


def univariate_sql(feature: str, forward: str, inverse: str, name: str) -> str:
    """CTEs ending in ``name``: the out-of-fold prediction of every row."""
    x = q(feature)
    return f"""
    m_{name} AS (SELECT k, cast(median({x}) AS double) AS med FROM ks JOIN folded ON fold <> k GROUP BY k),
    f_{name} AS (SELECT ks.k, med, regr_slope({forward}, coalesce({x}, med)) AS slope, regr_intercept({forward}, coalesce({x}, med)) AS icept
                 FROM ks JOIN folded ON fold <> ks.k JOIN m_{name} m ON m.k = ks.k GROUP BY ks.k, med),
    {name} AS (SELECT {q('Id')}, fold, {q('SalePrice')} AS y, {inverse.format(p=f'(icept + slope * coalesce({x}, med))')} AS p
               FROM folded JOIN f_{name} f ON f.k = fold)"""


RAW_SQL = (q("SalePrice"), "{p}")
LOG_SQL = (f"ln(1 + {q('SalePrice')})", "(exp({p}) - 1)")


@query(
    "univariate_fits",
    with_fixtures(
        "houses",
        f"WITH {FOLDED}, {ALL_FOLDS}, {univariate_sql('GrLivArea', *RAW_SQL, 'o')}"
        " SELECT cast(k AS integer) AS fold, med AS fill, round(slope, 6) AS slope, round(icept, 4) AS intercept FROM f_o",
    ),
)
def univariate_fits(spark, sf):
    return rounded(linear.fit_univariate(_folded(spark, sf), "GrLivArea", "SalePrice", K), slope=6)


@query(
    "out_of_fold_univariate",
    with_fixtures(
        "houses",
        f"WITH {FOLDED}, {ALL_FOLDS}, {univariate_sql('GrLivArea', *RAW_SQL, 'o')}"
        f" SELECT {q('Id')}, cast(fold AS integer) AS fold, round(y, 4) AS {q('SalePrice')}, round(p, 4) AS y_pred_oof FROM o",
    ),
)
def out_of_fold_univariate(spark, sf):
    scored = linear.out_of_fold_univariate(_folded(spark, sf), "GrLivArea", "SalePrice", K)
    return rounded(scored.select("Id", "fold", "SalePrice", "y_pred_oof"))


@query(
    "out_of_fold_log_target",
    with_fixtures(
        "houses",
        f"WITH {FOLDED}, {ALL_FOLDS}, {univariate_sql('GrLivArea', *LOG_SQL, 'o')}"
        f" SELECT {q('Id')}, round(p, 3) AS y_pred_oof FROM o",
    ),
)
def out_of_fold_log_target(spark, sf):
    scored = linear.out_of_fold_univariate(_folded(spark, sf), "GrLivArea", "SalePrice", K, target=LOG_TARGET)
    return rounded(scored.select("Id", "y_pred_oof"), 3)


CANDIDATES = [
    (f"{feature}{suffix}", feature, target, sql)
    for feature in ("GrLivArea", "OverallQual", "TotalBsmtSF")
    for suffix, target, sql in (("", RAW_TARGET, RAW_SQL), ("_log", LOG_TARGET, LOG_SQL))
]
COMPARED_SQL = (
    f"WITH {FOLDED}, {ALL_FOLDS}, "
    + ", ".join(univariate_sql(feature, *sql, f"o{i}") for i, (_, feature, _, sql) in enumerate(CANDIDATES))
    + ", scores AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS name, {i} AS ordinal, avg(r) AS cv_rmse_mean, stddev_pop(r) AS cv_rmse_std"
        f" FROM (SELECT fold, sqrt(avg(pow(y - p, 2))) AS r FROM o{i} GROUP BY fold) x"
        for i, (name, _, _, _) in enumerate(CANDIDATES)
    )
    + ")"
)


def _scores(spark, sf):
    """One row per candidate; all of them are compared on the same folds."""
    folded = materialize(_folded(spark, sf).select("Id", "fold", "SalePrice", "GrLivArea", "OverallQual", "TotalBsmtSF"), "folded")
    oof = encode.union_all([
        linear.out_of_fold_univariate(folded, feature, "SalePrice", K, target=target).select(
            F.lit(name).alias("name"), F.lit(i).alias("ordinal"), "fold", "SalePrice", "y_pred_oof"
        )
        for i, (name, feature, target, _) in enumerate(CANDIDATES)
    ])
    return metrics.fold_summary(oof, "SalePrice", "y_pred_oof", "fold", ["name", "ordinal"]).withColumn("id", F.col("name"))


@query(
    "compared_candidates",
    with_fixtures(
        "houses",
        COMPARED_SQL + " SELECT name, ordinal, round(cv_rmse_mean, 3) AS cv_rmse_mean, round(cv_rmse_std, 3) AS cv_rmse_std,"
        " cast(ordinal = (SELECT ordinal FROM scores ORDER BY cv_rmse_mean, ordinal LIMIT 1) AS varchar) AS is_champion FROM scores",
    ),
)
def compared_candidates(spark, sf):
    return rounded(choose.mark_champion(_scores(spark, sf), ordinal="ordinal").drop("id"), 3)


@query(
    "holdout_metrics",
    with_fixtures(
        "houses",
        f"""WITH h AS (SELECT {q('OverallQual')} AS x, {q('SalePrice')} AS y, {HOLDOUT} AS held FROM houses),
            f AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS icept FROM h WHERE NOT held)
            SELECT cast(held AS varchar) AS is_holdout, count(*) AS n, round(sqrt(avg(pow(y - (icept + slope * x), 2))), 3) AS rmse,
                   round(1 - sum(pow(y - (icept + slope * x), 2)) / (var_pop(y) * count(y)), 8) AS r2
            FROM h, f GROUP BY held""",
    ),
)
def holdout_metrics(spark, sf):
    """Fitted on the training rows, measured on both parts."""
    houses = folds.mark_holdout(fixture(spark, sf, "houses"), "Id").withColumn("part", F.col("is_holdout").cast("int"))
    # leaving out part 1 is fitting on part 0
    fit = linear.fit_univariate(houses, "OverallQual", "SalePrice", 2, fold="part").where("part = 1").first()
    scored = houses.withColumn("p", F.lit(fit["intercept"]) + F.lit(fit["slope"]) * F.col("OverallQual"))
    found = metrics.regression_metrics(scored, "SalePrice", "p", ["is_holdout"])
    return rounded(found.select("is_holdout", "n", "rmse", "r2"), 3, r2=8)


# --- Spark ML where the result is unique: least squares, fitted encodings ---


def two_features_sql(forward: str, inverse: str) -> str:
    """Least squares on two features in closed form, per fold, after median imputation."""
    x1, x2 = q("GrLivArea"), q("OverallQual")
    return f"""
    med AS (SELECT k, cast(median({x1}) AS double) AS med FROM ks JOIN folded ON fold <> k GROUP BY k),
    r AS (SELECT ks.k, fold, coalesce({x1}, med) AS a, {x2} AS b, {q('SalePrice')} AS y, {forward} AS t
          FROM ks JOIN med USING (k), folded),
    s AS (SELECT k, avg(a) AS ma, avg(b) AS mb, avg(t) AS mt, var_pop(a) AS va, var_pop(b) AS vb, covar_pop(a, b) AS vab,
                 covar_pop(a, t) AS vat, covar_pop(b, t) AS vbt FROM r WHERE fold <> k GROUP BY k),
    c AS (SELECT k, ma, mb, mt, (vat * vb - vbt * vab) / (va * vb - vab * vab) AS ca, (vbt * va - vat * vab) / (va * vb - vab * vab) AS cb
          FROM s),
    o AS (SELECT fold, y, {inverse.format(p='(mt + ca * (a - ma) + cb * (b - mb))')} AS p FROM r JOIN c USING (k) WHERE fold = k)
    SELECT cast(fold AS integer) AS fold, count(*) AS n, round(sqrt(avg(pow(y - p, 2))), 2) AS rmse,
           round(1 - sum(pow(y - p, 2)) / (var_pop(y) * count(y)), 6) AS r2 FROM o GROUP BY fold"""


def _two_features(spark, sf, target):
    houses = fixture(spark, sf, "houses").select("Id", "SalePrice", "GrLivArea", "OverallQual")
    folded = materialize(folds.assign_folds(houses, "Id", K), "folded")
    oof = training.out_of_fold(folded, lambda: regressors.linear_regression("SalePrice", target, ["Id"]), K, ["Id", "SalePrice"])
    found = metrics.regression_metrics(oof, "SalePrice", "prediction", ["fold"])
    return rounded(found.select("fold", "n", "rmse", "r2"), 2, r2=6)


@query("least_squares_oof", with_fixtures("houses", f"WITH {FOLDED}, {ALL_FOLDS}, {two_features_sql(*RAW_SQL)}"))
def least_squares_oof(spark, sf):
    return _two_features(spark, sf, "raw")


@query("least_squares_log_oof", with_fixtures("houses", f"WITH {FOLDED}, {ALL_FOLDS}, {two_features_sql(*LOG_SQL)}"))
def least_squares_log_oof(spark, sf):
    return _two_features(spark, sf, "log")


RARE_BELOW = 100
PREPARED_SQL = f"""
WITH h AS (SELECT *, median({q('GrLivArea')}) OVER () AS med, cast({q('YearBuilt')} AS varchar) AS built FROM houses),
n AS (SELECT coalesce(cast({q('GrLivArea')} AS double), med) AS a, cast({q('OverallQual')} AS double) AS b FROM h),
z AS (SELECT (a - avg(a) OVER ()) / stddev_pop(a) OVER () AS a, (b - avg(b) OVER ()) / stddev_pop(b) OVER () AS b FROM n),
lv AS (SELECT 'MSZoning' AS c, coalesce({q('MSZoning')}, '__missing__') AS v, count(*) AS n FROM h GROUP BY 2
       UNION ALL SELECT 'built', built, count(*) FROM h GROUP BY 2)
SELECT slot, count(*) AS filled, round(sum(v * v * v), 3) AS cubes FROM (
  SELECT 'GrLivArea_value' AS slot, a AS v FROM z UNION ALL SELECT 'OverallQual_value', b FROM z) x GROUP BY slot
UNION ALL
SELECT c || '_is_' || CASE WHEN n < {RARE_BELOW} THEN '__infrequent__' ELSE v END AS slot, cast(sum(n) AS bigint), cast(sum(n) AS double)
FROM lv GROUP BY 1"""


@query("prepared_slots", with_fixtures("houses", PREPARED_SQL))
def prepared_slots(spark, sf):
    """What the vector slots add up to: imputed and scaled numbers, kept and rare levels."""
    houses = fixture(spark, sf, "houses").select(
        "Id", "GrLivArea", "OverallQual", "MSZoning", F.col("YearBuilt").cast("string").alias("built")
    )
    out = FeaturePrep(exclude=["Id"], scaleNumeric=True, minFrequency=RARE_BELOW).fit(houses).transform(houses)
    names = F.array(*[F.lit(n) for n in feature_names(out)])
    cells = out.select(F.posexplode(vector_to_array("features")).alias("at", "v")).where("v <> 0")
    # feature vectors have far fewer slots than the table has rows, so this sums up before the shuffle
    sums = cells.groupBy("at").agg(F.count(F.lit(1)).alias("filled"), F.sum(F.pow("v", F.lit(3))).alias("cubes"))
    return rounded(sums.select(F.get(names, F.col("at")).alias("slot"), "filled", "cubes"), 3)


@query(
    "union_of_folds",
    with_fixtures("cv", f"SELECT kaggle_id, model_id, round(y_pred_oof, 4) AS y_pred_oof, cast({hash_bucket('kaggle_id', '42:fold', K)} AS integer) AS fold FROM cv"),
)
def union_of_folds(spark, sf):
    """Parts by fold put together again: each row once."""
    cv = folds.assign_folds(fixture(spark, sf, "cv").select("kaggle_id", "model_id", "y_pred_oof"), "kaggle_id", K)
    return rounded(encode.union_all([cv.where(F.col("fold") == f) for f in range(K)]))


# --- Spark ML: what a learner gives depends on its algorithm, so these queries state what any right one gives ---

FEATURES = ["GrLivArea", "OverallQual", "TotalBsmtSF", "GarageArea", "MSZoning", "KitchenQual", "MasVnrType"]
# Sizes of single learners here: all rows, columns and folds; fewer trees and epochs than the defaults (README, "Decisions").
SHORT = {"forest": {"trees": 100}, "net": {"maxEpochs": 300}}
STAMP = datetime(2024, 1, 31)


def _features(spark, sf):
    return fixture(spark, sf, "houses").select("Id", "SalePrice", *FEATURES)


# numbers filled, levels in alphabetical order: what a row's slots hold, by name
SLOTS_SQL = f"""
WITH med AS (SELECT median({q('GrLivArea')}) AS a, median({q('TotalBsmtSF')}) AS b FROM houses),
lv AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS place FROM (SELECT DISTINCT coalesce({q('MSZoning')}, '__missing__') AS v FROM houses) x)
SELECT {q('Id')}, cast(coalesce({q('GrLivArea')}, a) AS double) AS area, cast(coalesce({q('TotalBsmtSF')}, b) AS double) AS basement,
"""


def _slots(out, **names):
    """Named slots of the vector as columns."""
    at = {n: i for i, n in enumerate(feature_names(out))}
    values = vector_to_array("features")
    return out.select("Id", *[F.get(values, F.lit(at[slot])).alias(name) for name, slot in names.items()])


@query(
    "prepared_features_dense",
    with_fixtures("houses", SLOTS_SQL + f"""cast(place = (SELECT max(place) FROM lv) AS integer)::DOUBLE AS last_zone
        FROM houses JOIN lv ON v = coalesce({q('MSZoning')}, '__missing__'), med"""),
)
def prepared_features_dense(spark, sf):
    houses = _features(spark, sf)
    out = FeaturePrep(exclude=["Id", "SalePrice"]).fit(houses).transform(houses)
    last = [n for n in feature_names(out) if n.startswith("MSZoning_is_")][-1]
    return _slots(out, area="GrLivArea_value", basement="TotalBsmtSF_value", last_zone=last)


@query(
    "prepared_features_native",
    with_fixtures("houses", SLOTS_SQL + f"place::DOUBLE AS zone FROM houses JOIN lv ON v = coalesce({q('MSZoning')}, '__missing__'), med"),
)
def prepared_features_native(spark, sf):
    houses = CategoryCast(columns=["OverallQual"]).transform(_features(spark, sf))
    out = FeaturePrep(kind="hgb_native", exclude=["Id", "SalePrice"]).fit(houses).transform(houses)
    return _slots(out, area="GrLivArea_value", basement="TotalBsmtSF_value", zone="MSZoning_level")


# every id once, in its fold, predicted better than by the mean
LEARNED_SQL = with_fixtures(
    "houses",
    f"WITH {FOLDED} SELECT cast(fold AS integer) AS fold, count(*) AS n, count(DISTINCT {q('Id')}) AS ids, 'true' AS learned FROM folded GROUP BY fold",
)


def _out_of_fold(spark, sf, make, floor):
    """All gold columns and rows in five folds, ``learned``: the share of the variance explained
    lies above the floor."""
    gold = layers.prepare(fixture(spark, sf, "houses"))
    folded = materialize(folds.assign_folds(gold, "Id", K), "folded", "fold")
    oof = materialize(training.out_of_fold(folded, make, K, ["Id", "SalePrice"], parallelism=K), "oof")
    scores = metrics.regression_metrics(oof, "SalePrice", "prediction", ["fold"]).select("fold", "n", (F.col("r2") > floor).alias("learned"))
    ids = oof.groupBy("fold").agg(F.countDistinct("Id").alias("ids"))
    return scores.join(F.broadcast(ids), "fold").select("fold", "n", "ids", "learned")  # one row per fold


@query("linear_regression_oof", LEARNED_SQL)
def linear_regression_oof(spark, sf):
    return _out_of_fold(spark, sf, lambda: regressors.linear_regression("SalePrice", exclude=["Id"]), 0.5)


@query("linear_regression_log_oof", LEARNED_SQL)
def linear_regression_log_oof(spark, sf):
    return _out_of_fold(spark, sf, lambda: regressors.linear_regression("SalePrice", "log", exclude=["Id"]), 0.3)


@query("random_forest_oof", LEARNED_SQL)
def random_forest_oof(spark, sf):
    return _out_of_fold(spark, sf, lambda: regressors.random_forest("SalePrice", exclude=["Id"], **SHORT["forest"]), 0.5)


@query("small_forest_oof", LEARNED_SQL)
def small_forest_oof(spark, sf):
    return _out_of_fold(spark, sf, lambda: regressors.small_forest("SalePrice", exclude=["Id"], **SHORT["forest"]), 0.5)


@query("boosted_trees_oof", LEARNED_SQL)
def boosted_trees_oof(spark, sf):
    return _out_of_fold(spark, sf, lambda: regressors.boosted_trees("SalePrice", exclude=["Id"]), 0.5)


@query("neural_net_oof", LEARNED_SQL)
def neural_net_oof(spark, sf):
    return _out_of_fold(spark, sf, lambda: regressors.neural_net("SalePrice", "log", exclude=["Id"], **SHORT["net"]), 0.0)


@query("feature_importances")
def feature_importances(spark, sf):
    gold = materialize(layers.prepare(fixture(spark, sf, "houses")), "gold")
    fitted = regressors.random_forest("SalePrice", exclude=["Id"], **SHORT["forest"]).fit(gold)
    stages = fitted.model.stages
    return top_importances(stages[0].transform(gold), stages[-1].featureImportances)


PAIRED_ROWS = 10_000
PERMUTED_SQL = with_fixtures(
    "houses",
    f"""WITH med AS (SELECT cast(median({q('GrLivArea')}) AS double) AS med FROM houses),
    r AS (SELECT {q('Id')} AS id, {q('GrLivArea')} AS area, coalesce({q('GrLivArea')}, med) AS a, {q('OverallQual')} AS b, {q('SalePrice')} AS t FROM houses, med),
    s AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(t) AS mt, var_pop(a) AS va, var_pop(b) AS vb, covar_pop(a, b) AS vab,
                 covar_pop(a, t) AS vat, covar_pop(b, t) AS vbt FROM r),
    c AS (SELECT *, (vat * vb - vbt * vab) / (va * vb - vab * vab) AS ca, (vbt * va - vat * vab) / (va * vb - vab * vab) AS cb FROM s),
    h AS (SELECT *, md5(id::varchar || '42:pairs') AS digest,
                 {hash_bucket('id', '42:pairs', f'(SELECT cast(ceil(count(*) / {PAIRED_ROWS}.0) AS bigint) FROM houses)')} AS bucket FROM r),
    p AS (SELECT *, coalesce(lead(id) OVER w, first_value(id) OVER w) AS partner FROM h WINDOW w AS (PARTITION BY bucket ORDER BY digest)),
    x AS (SELECT p.t, p.a, p.b, o.a AS oa, o.b AS ob FROM p JOIN r o ON o.id = p.partner),
    e AS (SELECT sqrt(avg(pow(t - (mt + ca * (a - ma) + cb * (b - mb)), 2))) AS plain,
                 sqrt(avg(pow(t - (mt + ca * (oa - ma) + cb * (b - mb)), 2))) AS area,
                 sqrt(avg(pow(t - (mt + ca * (a - ma) + cb * (ob - mb)), 2))) AS quality, count(t) AS n FROM x, c)
    SELECT 'GrLivArea' AS feature, n, round(area, 2) AS rmse, round(area - plain, 2) AS importance FROM e
    UNION ALL SELECT 'OverallQual', n, round(quality, 2), round(quality - plain, 2) FROM e""",
)


@query("permuted_importances", PERMUTED_SQL)
def permuted_importances(spark, sf):
    """How much the error of a fitted pipeline grows when the values of a feature change places."""
    houses = materialize(fixture(spark, sf, "houses").select("Id", "SalePrice", "GrLivArea", "OverallQual"), "scored")
    fitted = regressors.linear_regression("SalePrice", exclude=["Id"]).fit(houses)
    return rounded(permutation_importances(fitted, houses, "SalePrice", ["GrLivArea", "OverallQual"], "Id", rows_together=PAIRED_ROWS), 2)


def _compared(spark, sf, mode="analysis"):
    """The gold table and the comparison of all default configurations on all its columns and five folds."""
    gold = materialize(layers.prepare(fixture(spark, sf, "houses")), "gold")
    found = training.evaluate(
        gold, regressors.default_configs("SalePrice"), "Id", "SalePrice", "20240131_000000", STAMP,
        # nets and boosting take one core for each fit, so fewer fits at a time than cores would leave some idle
        k=K, mode=mode, model_dir=scratch_path(spark, "models"), parallelism=max(8, spark.sparkContext.defaultParallelism),
        ledger=f"{shared_root(spark)}/fit-ledger",
    )
    return gold, found


@query("model_comparison")
def model_comparison(spark, sf):
    """All configurations through cross-validation, hold-out, champion, refit and storage."""
    return _compared(spark, sf)[1].models


@query("champion_only_training")
def champion_only_training(spark, sf):
    return _compared(spark, sf, "train-only")[1].models


@query("stored_model_scores")
def stored_model_scores(spark, sf):
    """Train from the raw table, store the champion, load it and score the table without label."""
    gold, found = _compared(spark, sf)
    return score_with_stored(found.models, gold.drop("SalePrice"), "Id", STAMP)


FORMULA_SQL = with_fixtures(
    "houses",
    f"""WITH med AS (SELECT cast(median({q('GrLivArea')}) AS double) AS med FROM houses),
    r AS (SELECT {q('Id')} AS id, coalesce({q('GrLivArea')}, med) AS a, {q('OverallQual')} AS b, ln(1 + {q('SalePrice')}) AS t FROM houses, med),
    s AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(t) AS mt, var_pop(a) AS va, var_pop(b) AS vb, covar_pop(a, b) AS vab,
                 covar_pop(a, t) AS vat, covar_pop(b, t) AS vbt FROM r),
    c AS (SELECT *, (vat * vb - vbt * vab) / (va * vb - vab * vab) AS ca, (vbt * va - vat * vab) / (va * vb - vab * vab) AS cb FROM s)
    SELECT id AS kaggle_id, round(exp(mt + ca * (a - ma) + cb * (b - mb)) - 1, 2) AS predicted_price, 'm1' AS model_id,
        'LinearRegression_log' AS model_name, '20240131_000000' AS model_version, '2024-01-31 00:00:00.000000' AS created_at_utc
    FROM r, c""",
)
FORMULA_TAGS = {"model_id": "m1", "model_name": "LinearRegression_log", "model_version": "20240131_000000"}


def _two_feature_model(spark, sf):
    houses = materialize(fixture(spark, sf, "houses").select("Id", "SalePrice", "GrLivArea", "OverallQual"), "scored")
    return houses, regressors.linear_regression("SalePrice", "log", exclude=["Id"]).fit(houses)


@query("batch_scores", FORMULA_SQL)
def batch_scores(spark, sf):
    """A fitted pipeline scores a table without label."""
    houses, fitted = _two_feature_model(spark, sf)
    return rounded(score(fitted, houses.drop("SalePrice"), "Id", FORMULA_TAGS, STAMP), 2)


@query("stored_formula_scores", FORMULA_SQL)
def stored_formula_scores(spark, sf):
    """The same pipeline compiled to a formula, stored, read back and applied as one expression."""
    houses, fitted = _two_feature_model(spark, sf)
    path = scratch_path(spark, "formula")
    compile_linear(fitted).store(spark, path)
    return rounded(score(LinearFormula.load(spark, path), houses.drop("SalePrice"), "Id", FORMULA_TAGS, STAMP), 2)


@query("reloaded_model_scores", FORMULA_SQL)
def reloaded_model_scores(spark, sf):
    """The same pipeline saved and loaded as a model."""
    houses, fitted = _two_feature_model(spark, sf)
    path = scratch_path(spark, "model")
    fitted.write().overwrite().save(path)
    return rounded(score(TransformedTargetModel.load(path), houses.drop("SalePrice"), "Id", FORMULA_TAGS, STAMP), 2)
