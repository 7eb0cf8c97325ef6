"""Packing by powers of two: every document is cut into pieces whose lengths are powers of two.

A piece is a sequence of its own, so no sequence crosses documents and none is padded; sequences of one length lie in one
bucket, from which batches of equal shape are drawn. Pieces of the greatest length come first in a document, then the binary
digits of what is left, largest first.

Defined results: a null or empty text has the end id alone and makes one piece of length 1; a null id is a value like any
other; repeated rows are packed as often as they occur; an empty table gives no pieces. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabmill.llm.wordwise import encoder, portions
from tabmill.session import materialize, scratch_path

GREATEST = 4096
# Rows of a length and a task each that a broadcast may hold: some 40 MB.
MOST_SENT = 1_000_000
# Tasks that are added up in one window.
TASKS_TOGETHER = 4_096
SCHEMA = "doc_id long, start long, length int, doc_tokens long, tokens binary, part int, place long"


def binary_lengths(n: int, greatest: int = GREATEST) -> list[int]:
    """Powers of two that add up to n, none above the greatest."""
    full, left = divmod(n, greatest)
    return [greatest] * full + [1 << k for k in reversed(range(greatest.bit_length())) if left >> k & 1]


def _cut(tokenizer_path: str, end_id: int, greatest: int):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, keeps_space=False).encode
        part = TaskContext.get().partitionId()
        placed = dict.fromkeys((1 << k for k in range(greatest.bit_length())), 0)
        for portion in (p for batch in batches for p in portions(batch)):
            out: dict[str, list] = {c.split()[0]: [] for c in SCHEMA.split(", ")}
            for doc_id, tokens in zip(portion.column(0).to_pylist(), encode(portion.column(1)).to_pylist(), strict=True):
                tokens += end
                at = 0
                for n in binary_lengths(len(tokens) // 4, greatest):
                    row = (doc_id, at, n, len(tokens) // 4, tokens[4 * at : 4 * (at + n)], part, placed[n])
                    for column, value in zip(out.values(), row, strict=True):
                        column.append(value)
                    at += n
                    placed[n] += 1
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
            yield pa.record_batch([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], list(out))

    return run


def cut_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int, greatest: int = GREATEST, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces with their tokens; ``place`` counts the pieces of a length within a task."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_cut(tokenizer_path, end_id, greatest), SCHEMA)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, path: str | None = None, greatest: int = GREATEST) -> DataFrame:
    """Sequences with their tokens, stored by length at ``path``, numbered from 0 with those of one length together.

    The numbers come from how many pieces of each length each task wrote: one row per length and task, no sort of pieces. Up to
    ``MOST_SENT`` such rows, counted first, are sent to every executor; more of them are joined as Spark finds best.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "sequences")
    written = cut_documents(docs, tokenizer_path, end_id, greatest)
    written.write.partitionBy("length").option("compression", "zstd").parquet(path)
    pieces = spark.read.schema(written.schema).parquet(path)
    firsts = materialize(first_numbers(pieces.groupBy("length", "part").agg(F.count("*").alias("n"))), "first-numbers")
    numbered = pieces.join(F.broadcast(firsts) if firsts.count() <= MOST_SENT else firsts, ["length", "part"])
    return numbered.select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "doc_tokens", "tokens",
        (F.col("first") + F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )


def first_numbers(counts: DataFrame, tasks_together: int = TASKS_TOGETHER) -> DataFrame:
    """length, part, first: where the numbers of a task's pieces of a length begin; ``counts`` holds n for each.

    Tasks are added up in blocks and within each block, so no window holds all of them: one has ``tasks_together`` rows, the other one
    per length and block.
    """
    blocked = counts.withColumn("block", F.floor(F.col("part") / tasks_together))
    before = W.orderBy("length", "block").rowsBetween(W.unboundedPreceding, -1)
    sums = blocked.groupBy("length", "block").agg(F.sum("n").alias("n"))
    starts = sums.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = W.partitionBy("length", "block").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return blocked.withColumn("inner", F.coalesce(F.sum("n").over(within), F.lit(0))).join(starts, ["length", "block"]).select(
        "length", "part", (F.col("start") + F.col("inner")).alias("first")
    )
