"""The corpus pipeline: documents through five operators, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmill.llm import binpieces, covering, hostrules, nbsvm, suffixes
from tabmill.llm.queries import END_ID, WORD_BPE
from tabmill.session import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that more likely than not have label 0; learned from the labels that are not held out."""
    model = nbsvm.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(nbsvm.score(F.col("text"), model) >= 0.5)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the base rule, or the verdict on their host, rejects."""
    return hostrules.keep_good(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near-duplicates."""
    return covering.keep_first(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that stand earlier in the corpus, cut at whole characters."""
    cleaned = suffixes.remove_repeats(docs, whole_characters=True)
    text = F.col("kept").cast("string")
    columns = {"text": text, "n_chars": F.length(text).cast("long")}
    return cleaned.select(*[columns.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences whose lengths are powers of two, with their tokens."""
    return binpieces.pack(docs, WORD_BPE, END_ID)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("packing", packing),
]

#: A learned score is no SQL; tests/llm holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
