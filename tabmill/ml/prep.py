"""Preprocessing fitted on training rows only.

``ohe_dense``: median for numbers (scaled on request), one-hot categories with rare levels as
one. ``hgb_native``: median for numbers, categories as nominal features for tree learners.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.defaults import MISSING_CATEGORY
from tabmill.functions.checks import col, numeric_columns, present, string_columns
from tabmill.functions.features import add_features
from tabmill.functions.missing import treat_missing
from tabmill.functions.ordinal import encode_ordinals
from tabmill.ml.storage import TableStored
from tabmill.operators.encode import INFREQUENT, levels
from tabmill.operators.ranks import medians
from tabmill.session import materialize

KINDS = ("ohe_dense", "hgb_native")
# Defaults of the parameters that bound levels: vector slots a learner may get, and levels of one nominal feature.
MAX_LEVELS = 100_000
MAX_NOMINAL_LEVELS = 255


class GoldFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The row-wise steps of silver and gold as a stage, for models that score raw tables."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return encode_ordinals(add_features(treat_missing(df)))


class CategoryCast(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Casts the named columns that are present to text categories."""

    columns = Param(Params._dummy(), "columns", "columns to cast", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns: list[str] | None = None):
        super().__init__()
        if columns is not None:
            self._set(columns=list(columns))

    def _transform(self, df: DataFrame) -> DataFrame:
        names = present(df, self.getOrDefault(self.columns))
        return df.withColumns({c: col(c).cast("string") for c in names}) if names else df


class _PrepParams(Params):
    kind = Param(Params._dummy(), "kind", "ohe_dense or hgb_native", TypeConverters.toString)
    exclude = Param(Params._dummy(), "exclude", "columns that are no features", TypeConverters.toListString)
    minFrequency = Param(Params._dummy(), "minFrequency", "levels below it are grouped", TypeConverters.toFloat)
    scaleNumeric = Param(Params._dummy(), "scaleNumeric", "standardise numbers", TypeConverters.toBoolean)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)
    maxLevels = Param(Params._dummy(), "maxLevels", "kept levels of all columns", TypeConverters.toInt)
    maxNominalLevels = Param(Params._dummy(), "maxNominalLevels", "levels of a nominal feature: the learner's bins less one", TypeConverters.toInt)


class FeaturePrep(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """``minFrequency`` below 1 is a share of the rows, otherwise a count."""

    @keyword_only
    def __init__(
        self, *, kind: str = "ohe_dense", exclude: list[str] | None = None, minFrequency: float = 10,
        scaleNumeric: bool = False, outputCol: str = "features", maxLevels: int = MAX_LEVELS,
        maxNominalLevels: int = MAX_NOMINAL_LEVELS,
    ):
        super().__init__()
        if kind not in KINDS:
            raise ValueError(f"unknown kind {kind!r}")
        self._set(
            kind=kind, exclude=list(exclude or []), minFrequency=float(minFrequency), scaleNumeric=scaleNumeric,
            outputCol=outputCol, maxLevels=maxLevels, maxNominalLevels=maxNominalLevels,
        )

    #: Medians found before on the same rows; they depend on no parameter but ``exclude``.
    known_fills: dict[tuple, dict[str, float]] | None = None

    def find_fills(self, df: DataFrame) -> dict[tuple, dict[str, float]]:
        """Medians of the numbers. A column without any value is left out, as an imputer without a statistic does."""
        numbers = numeric_columns(df, self.getOrDefault(self.exclude))
        return {tuple(numbers): {c: m for c, m in medians(df, numbers)[None].items() if m is not None} if numbers else {}}

    def with_fills(self, fills: dict[tuple, dict[str, float]]) -> "FeaturePrep":
        """A copy that takes these medians where it reads the same columns."""
        made = self.copy()
        made.known_fills = fills
        return made

    def _fit(self, df: DataFrame) -> "FeaturePrepModel":
        skip = self.getOrDefault(self.exclude)
        kind = self.getOrDefault(self.kind)
        numbers, categories = numeric_columns(df, skip), string_columns(df, skip)
        fills = (self.known_fills or {}).get(tuple(numbers))
        if fills is None:
            fills = self.find_fills(df)[tuple(numbers)]
        scale = _scale(df, fills) if self.getOrDefault(self.scaleNumeric) and kind == "ohe_dense" and fills else {}
        table, kept, rare = None, {}, {}
        if categories:
            threshold = self.getOrDefault(self.minFrequency)
            threshold = threshold if threshold < 1 else int(threshold)
            if kind == "hgb_native":
                threshold = 1
            table = materialize(levels(df, categories, threshold), "levels")
            kept, rare = _kept_levels(
                table, categories, self.getOrDefault(self.maxNominalLevels) if kind == "hgb_native" else None, self.getOrDefault(self.maxLevels)
            )
        model = FeaturePrepModel(fills, scale, kept, rare, table)
        return self._copyValues(model)


def _scale(df: DataFrame, fills: dict[str, float]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation after imputation, all columns in one pass."""
    filled = {c: F.coalesce(col(c).cast("double"), F.lit(m)) for c, m in fills.items()}
    aggs = [f(x).alias(f"{n}{i}") for i, x in enumerate(filled.values()) for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = df.agg(*aggs).first()
    return {c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(filled)}


def _kept_levels(
    table: DataFrame, categories: list[str], per_column_limit: int | None, limit: int
) -> tuple[dict[str, list[str]], dict[str, int]]:
    """Kept levels per column in alphabetical order, and the number of rare ones."""
    sizes = {
        r["column"]: r
        for r in table.groupBy("column")
        .agg(F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("rare"))
        .collect()
    }
    per_column = max((r["kept"] for r in sizes.values()), default=0)
    if per_column_limit is not None and per_column > per_column_limit:
        raise ValueError(f"a category has {per_column} levels, this learner takes {per_column_limit}")
    if sum(r["kept"] for r in sizes.values()) > limit:
        raise ValueError(f"more than {limit} frequent levels; raise minFrequency or maxLevels")
    kept: dict[str, list[str]] = {c: [] for c in categories}
    for r in table.where("kept").select("column", "value").collect():
        kept[r["column"]].append(r["value"])
    return {c: sorted(v) for c, v in kept.items()}, {c: sizes[c]["rare"] if c in sizes else 0 for c in categories}


class FeaturePrepModel(TableStored, Model, _PrepParams):
    def __init__(self, fills=None, scale=None, kept=None, rare=None, table=None):
        super().__init__()
        self.fills = fills or {}
        self.scale = {c: tuple(v) for c, v in (scale or {}).items()}
        self.kept = kept or {}
        self.rare = rare or {}
        self.table = table

    def _state(self) -> dict:
        return {"fills": self.fills, "scale": self.scale, "kept": self.kept, "rare": self.rare}

    def _table(self):
        return self.table

    @classmethod
    def _restore(cls, metadata: dict, table_path: str, spark) -> "FeaturePrepModel":
        table = spark.read.parquet(table_path) if metadata["kept"] else None
        return cls(metadata["fills"], metadata["scale"], metadata["kept"], metadata["rare"], table)

    def _transform(self, df: DataFrame) -> DataFrame:
        native = self.getOrDefault(self.kind) == "hgb_native"
        numbers = {c: f"_num{i}" for i, c in enumerate(self.fills)}
        out = df.withColumns({name: self._number(c) for c, name in numbers.items()}) if numbers else df
        indexed, inputs = [], []
        for i, (c, names) in enumerate(self.kept.items()):
            inputs.append(f"_cat{i}")
            indexed.append(f"_idx{i}")
            # a learner needs at least one level, also where all rows miss the column
            labels = [*names, INFREQUENT] if self.rare[c] else names or [MISSING_CATEGORY]
            indexer = StringIndexerModel.from_labels(labels, inputs[-1], indexed[-1], handleInvalid="keep")
            out = indexer.transform(self._category(out, c, inputs[-1]))
        categories = indexed
        if self.kept and not native:
            categories = [f"{c}_is" for c in self.kept]
            # the encoder learns its sizes from the column metadata; this reads no rows
            encoder = OneHotEncoder(inputCols=indexed, outputCols=categories, dropLast=True)
            out = encoder.fit(out).transform(out)
        elif self.kept:
            renamed = {i: f"{c}_level" for i, c in zip(indexed, self.kept)}
            out = out.withColumnsRenamed(renamed)
            categories = list(renamed.values())
        plain = {name: f"{c}_value" for c, name in numbers.items()}
        out = out.withColumnsRenamed(plain)
        out = VectorAssembler(inputCols=[*plain.values(), *categories], outputCol=self.getOrDefault(self.outputCol)).transform(out)
        return out.drop(*plain.values(), *categories, *inputs, *indexed)

    def _number(self, c: str):
        value = F.coalesce(col(c).cast("double"), F.lit(self.fills[c]))
        if c in self.scale:
            mean, std = self.scale[c]
            value = (value - F.lit(mean)) / F.lit(std)
        return value

    def _category(self, df: DataFrame, c: str, name: str) -> DataFrame:
        """The level as the indexer knows it: rare levels by their common marker."""
        filled = F.coalesce(col(c).cast("string"), F.lit(MISSING_CATEGORY))
        if not self.rare[c]:
            return df.withColumn(name, filled)
        rare = self.table.where((F.col("column") == c) & ~F.col("kept")).select(F.col("value").alias("_rare"))
        # rows with a kept level take no part in the join, so a frequent level is no hot key
        is_kept = F.col(name).isin(self.kept[c]) if self.kept[c] else F.lit(False)
        probed = df.withColumn(name, filled).withColumn("_probe", F.when(~is_kept, F.col(name)))
        joined = probed.join(rare, F.col("_probe") == F.col("_rare"), "left")
        return joined.withColumn(name, F.when(F.col("_rare").isNotNull(), INFREQUENT).otherwise(F.col(name))).drop("_rare", "_probe")


def feature_names(df: DataFrame, vector: str = "features") -> list[str]:
    """Names of the vector slots, from the column metadata."""
    attrs = df.schema[vector].metadata["ml_attr"]["attrs"]
    slots = [a for group in attrs.values() for a in group]
    return [a["name"] for a in sorted(slots, key=lambda a: a["idx"])]


def top_importances(transformed: DataFrame, importances, n: int = 15, vector: str = "features") -> DataFrame:
    """feature, importance — the n most important slots; as many rows as the vector is wide."""
    pairs = list(zip(feature_names(transformed, vector), [float(v) for v in importances.toArray()]))
    table = transformed.sparkSession.createDataFrame(pairs, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(n)
