"""Token ids in files: ids by frequency rank, byte-aligned lengths, control bytes apart from data bytes.

Ids are replaced by their rank in the whole corpus, so frequent ids take one byte. Four lengths of 1 to 4 bytes share a
control byte; the control bytes and the data bytes of a block are two separate columns. A reader looks every control byte up in
a table that says which bytes of four words are there, so a block is decoded by a few array steps.

Files are written by Spark (blocks as rows of binary columns, one folder for each range of ids, a table of ranks), so a
lost task leaves nothing behind and any storage Spark writes will do. Blocks are numbered (``file``, ``first``) in
ascending order of document ids, and each says how many ids of its range lie before it.

Defined results: a null or empty text has the end id alone; null document ids come first; rows of one id are ordered by
their text's hash, repeated rows all stay; an empty table gives no blocks. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabmill.llm.wordwise import encoder, portions
from tabmill.session import scratch_path

#: Ids after which a block is closed; a longer document makes a block of its own.
BLOCK_IDS = 1 << 18
ENCODED = "doc_id long, n_tokens long, ids binary, file int, place long, ids_before long"
BLOCK = "file int, first long, ids_before long, n_ids long, doc_ids binary, no_id binary, lengths binary, control binary, data binary"
DECODED = "doc_id long, file int, before long, n_tokens long, ids binary"

_LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)
#: By control byte: which of the 16 bytes of four words are stored.
_PRESENT = (np.arange(4) < _LENGTHS[:, :, None]).reshape(256, 16)


def encode_words(words: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit words."""
    n = len(words)
    padded = np.zeros(-(-n // 4) * 4, "<u4")
    padded[:n] = words
    code = (padded > 0xFF).astype(np.uint8) + (padded > 0xFFFF) + (padded > 0xFFFFFF)
    control = (code.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    data = padded.view(np.uint8).reshape(-1, 16)[_PRESENT[control]]
    return control.tobytes(), data.tobytes()


def decode_words(control: bytes, data: bytes, n: int) -> np.ndarray:
    out = np.zeros((len(control), 16), np.uint8)
    out[_PRESENT[np.frombuffer(control, np.uint8)]] = np.frombuffer(data, np.uint8)
    return out.reshape(-1).view("<u4")[:n]


def _narrow(n_ids: int) -> str:
    return "<u2" if n_ids <= 1 << 16 else "<u4"


def _tokenize(tokenizer_path: str, end_id: int, kind: str):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, keeps_space=True).encode
        file, place, before = TaskContext.get().partitionId(), 0, 0
        for portion in (p for batch in batches for p in portions(batch)):
            ids = [np.frombuffer(x + end, "<u4") for x in encode(portion.column(1)).to_pylist()]
            counts = np.array([len(x) for x in ids], np.int64)
            starts = before + np.cumsum(counts) - counts
            n = len(ids)
            yield pa.record_batch([
                portion.column(0), pa.array(counts), pa.array([x.astype(kind).tobytes() for x in ids], pa.binary()),
                pa.array(np.full(n, file, np.int32)), pa.array(np.arange(place, place + n)), pa.array(starts),
            ], [c.split()[0] for c in ENCODED.split(", ")])
            place, before = place + n, before + int(counts.sum())

    return run


def encode_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int, vocabulary: int, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Ids of every document in ascending order of document ids, stored at ``path``.

    ``file`` is the range a row lies in and ``place`` its place there; ids take two bytes where the vocabulary allows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    encoded = ranged.mapInArrow(_tokenize(tokenizer_path, end_id, _narrow(vocabulary)), ENCODED)
    encoded.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(encoded.schema).parquet(path)


def _count(kind: str, vocabulary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            joined = b"".join(batch.column(0).to_pylist())
            total += np.bincount(np.frombuffer(joined, kind), minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["id", "n"])

    return run


def count_ids(encoded: DataFrame, vocabulary: int) -> DataFrame:
    """How often each id occurs in all documents; a task sends one row per id."""
    return encoded.select("ids").mapInArrow(_count(_narrow(vocabulary), vocabulary), "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


def ranked_ids(counts: DataFrame, vocabulary: int) -> np.ndarray:
    """Ids by falling frequency, unseen ones last; as long as the vocabulary, whatever the corpus."""
    n = np.zeros(vocabulary, np.int64)
    for row in counts.collect():
        n[row["id"]] = row["n"]
    return np.argsort(-n, kind="stable").astype("<u4")


def _to_blocks(kind: str, ranked: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.empty(len(ranked), "<u4")
        rank[ranked] = np.arange(len(ranked), dtype="<u4")
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            words = rank[np.frombuffer(b"".join(r["ids"] for r in held), kind)]
            control, data = encode_words(words)
            doc_ids = np.array([r["doc_id"] or 0 for r in held], "<i8").tobytes()
            no_id = np.array([r["doc_id"] is None for r in held], np.uint8).tobytes()
            lengths = np.array([r["n_tokens"] for r in held], "<i8").tobytes()
            row = [held[0]["file"], held[0]["place"], held[0]["ids_before"], len(words), doc_ids, no_id, lengths, control, data]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * 5]
            return pa.record_batch([pa.array([v], t) for v, t in zip(row, types, strict=True)], [c.split()[0] for c in BLOCK.split(", ")])

        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                follows = held and (row["file"], row["place"]) == (held[-1]["file"], held[-1]["place"] + 1)
                if held and (not follows or size + row["n_tokens"] > BLOCK_IDS):
                    yield block()
                    held, size = [], 0
                held.append(row)
                size += row["n_tokens"]
        if held:
            yield block()

    return run


def write_files(encoded: DataFrame, ranked: np.ndarray, path: str) -> None:
    """Blocks below ``path``/blocks, one folder for each range; the ids by rank in ``path``/ranks."""
    spark = encoded.sparkSession
    blocks = encoded.mapInArrow(_to_blocks(_narrow(len(ranked)), ranked), BLOCK)
    blocks.write.partitionBy("file").option("compression", "zstd").parquet(f"{path}/blocks")
    table = spark.createDataFrame([(ranked.tobytes(),)], "ids binary")
    table.coalesce(1).write.parquet(f"{path}/ranks")


def _from_blocks(ranked: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                ids = ranked[decode_words(block["control"], block["data"], block["n_ids"])]
                lengths = np.frombuffer(block["lengths"], "<i8")
                ends = np.cumsum(lengths)
                n = len(lengths)
                yield pa.record_batch([
                    pa.array(np.frombuffer(block["doc_ids"], "<i8"), mask=np.frombuffer(block["no_id"], bool)),
                    pa.array(np.full(n, block["file"], np.int32)), pa.array(block["ids_before"] + ends - lengths), pa.array(lengths),
                    pa.array([ids[e - k : e].tobytes() for e, k in zip(ends, lengths, strict=True)], pa.binary()),
                ], [c.split()[0] for c in DECODED.split(", ")])

    return run


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; ids are little-endian, 4 bytes each.

    What lies before a range follows from the sizes in the blocks' heads: one row per range.
    """
    ranked = np.frombuffer(spark.read.schema("ids binary").parquet(f"{path}/ranks").first()["ids"], "<u4")
    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    sizes = blocks.groupBy("file").agg(F.sum("n_ids").alias("n"))
    before = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    firsts = sizes.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    decoded = blocks.mapInArrow(_from_blocks(ranked), DECODED)
    return decoded.join(F.broadcast(firsts), "file").select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids"
    )


def store_corpus(docs: DataFrame, tokenizer_path: str, end_id: int, vocabulary: int, path: str | None = None) -> str:
    """Encode, count, rank and write; returns where the files are."""
    path = path or scratch_path(docs.sparkSession, "token-files")
    encoded = encode_documents(docs, tokenizer_path, end_id, vocabulary, f"{path}/encoded")
    write_files(encoded, ranked_ids(count_ids(encoded, vocabulary), vocabulary), path)
    return path
