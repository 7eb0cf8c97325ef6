"""Scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tabmill.defaults import MISSING_TOKENS, READER_MISSING_TOKENS
from tabmill.functions.missing import infer_types, normalize_missing

# How every CSV file here is written and read: quotes are doubled, blanks belong to the value, and an empty text differs from
# a missing one.
CSV_FORMAT = {
    "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    "nullValue": "", "emptyValue": '""',
}


def read_csv_text(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """All columns as text. Without ``multi_line`` large files are read in parts, but a value must not hold a line break."""
    options = {**CSV_FORMAT, "emptyValue": ""}
    return spark.read.options(**options).option("multiLine", multi_line).csv(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    tokens: Sequence[str] = (*MISSING_TOKENS, *READER_MISSING_TOKENS),
    widen_nullable: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """CSV with header. With a schema the missing tokens are removed and the rest is cast, which
    needs no pass over the data; without one the types are inferred after the tokens are gone."""
    text = normalize_missing(read_csv_text(spark, path, multi_line), tokens)
    if schema is None:
        return infer_types(text, widen_nullable=widen_nullable)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return text.select(*[text[f"`{f.name}`"].cast(f.dataType).alias(f.name) for f in schema.fields])


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Feature table: CSV if the name ends so, Parquet otherwise."""
    if path.lower().endswith(".csv"):
        return read_csv(spark, path)
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_optional(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """The inputs that are there; absent ones are skipped, others go on."""
    return {name: read_features(spark, path) for name, path in paths.items() if path_exists(spark, path)}


def read_growing(spark: SparkSession, path: str, text: Sequence[str] = ()) -> DataFrame | None:
    """A Parquet history whose parts may have gained columns; None if nothing was written yet.

    The columns named in ``text`` stay text where they name folders, whatever their values look like.
    """
    if not path_exists(spark, path):
        return None
    try:
        found = spark.read.option("mergeSchema", True).parquet(path)
        schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name in text else f for f in found.schema])
        return spark.read.schema(schema).parquet(path) if schema != found.schema else found
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise
