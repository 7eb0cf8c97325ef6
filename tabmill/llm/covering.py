"""Near-duplicates by fingerprints of word shingles and covering bit masks.

A fingerprint has 64 bits. With radius r there are 2^(r+1)-1 masks: every bit position gets a non-zero vector of r+1 bits, and
the mask of a non-zero vector v holds the positions whose vector has an odd product with v. The vectors of r differing
positions span less than the whole space, so some v has an even product with all of them: its mask leaves out all
differences, and two fingerprints within the radius agree under it. No pair is missed, whatever the data; with vectors dealt evenly a mask
holds half of the positions, so others rarely meet.

Equal fingerprints are one node. Buckets of a mask with more nodes than ``BLOCK`` are cut in blocks, and each pair of blocks is one
group of bounded size. A group sends on the edges of its components, less than one per node, never its pairs.

Defined results: null, empty and blank texts have fingerprint zero and are linked like others; a null id never is the smallest
of its component, a component of null ids alone has the id null; repeated rows fall in one component; an empty table gives no
rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.llm.components import components
from tabmill.session import materialize

RADIUS = 4
SHINGLE = 4
SEED = 42
#: Nodes of a bucket that are compared as one group; a larger bucket is cut. Results do not depend on it.
BLOCK = 128
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bits set in more than half of the hashes of all word shingles, as a signed number."""
    words = (text or "").encode().translate(_LOWER).split()  # splits at space and the controls 9 to 13
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = ends - np.fromiter(map(len, words), np.int64, len(words))
    if len(words) > shingle:
        starts, ends = starts[: -shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    n, hashed = len(starts), xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    for at in range(0, n, _AT_ONCE):
        cuts = zip(starts[at : at + _AT_ONCE].tolist(), ends[at : at + _AT_ONCE].tolist(), strict=True)
        hashes = np.array([hashed(joined[a:b], seed) for a, b in cuts], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(t.as_py()) for t in batch.column(1)]
        yield pa.record_batch([batch.column(0), pa.array(found, pa.int64()), batch.column(2)], ["doc_id", "fp", "text_hash"])


def masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """The covering masks, one for each non-zero vector, as signed 64-bit numbers."""
    size = 1 << radius + 1
    vector = [1 + i % (size - 1) for i in range(bits)]
    found = [sum(1 << i for i in range(bits) if (vector[i] & v).bit_count() % 2) for v in range(1, size)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def _stars(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) within groups: fps has one group of equal size per row."""
    near = np.bitwise_count(fps[:, :, None] ^ fps[:, None, :]) <= radius
    signed = fps.view(np.int64)
    label = signed.copy()
    while True:
        lower = np.where(near, label[:, None, :], np.iinfo(np.int64).max).min(axis=2)
        if (lower == label).all():
            break
        label = lower
    moved = label != signed
    return signed[moved], label[moved]


def _link(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group; a group may go on in the next batch."""
        held: list[np.ndarray] = []

        def edges(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            """rows: group columns and the fingerprint."""
            if not len(rows):
                return
            starts = np.flatnonzero(np.append(True, (rows[1:, :-1] != rows[:-1, :-1]).any(axis=1)))
            sizes = np.diff(np.append(starts, len(rows)))
            for size in np.unique(sizes[sizes > 1]):
                firsts = starts[sizes == size]
                for some in np.array_split(firsts, -(-len(firsts) * int(size) ** 2 // (1 << 20))):
                    fps = rows[some[:, None] + np.arange(size), -1].copy().view(np.uint64)
                    a, b = _stars(fps, radius)
                    yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            held.append(np.column_stack([c.to_numpy().astype(np.int64, copy=False) for c in batch.columns]))
            rows = np.concatenate(held)
            last = np.flatnonzero((rows[:, :-1] != rows[-1, :-1]).any(axis=1))
            whole = last[-1] + 1 if len(last) else 0
            yield from edges(rows[:whole])
            held = [rows[whole:]]
        if held:
            yield from edges(np.concatenate(held))

    return run


def near_edges(nodes: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges that connect all fingerprints within the radius, from distinct ones in column ``fp``."""
    tables = F.explode(F.array(*[
        F.struct(F.lit(t).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks(radius))
    ]))
    keyed = nodes.select("fp", tables.alias("t")).select("t.mask", "t.key", "fp")
    shared = materialize(keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1"), "mask-buckets")
    n_blocks = F.ceil(F.col("n") / block).cast("int")
    met = keyed.join(shared, ["mask", "key"]).select(
        "mask", "key", "fp", n_blocks.alias("n_blocks"), F.pmod(F.hash("fp"), n_blocks).alias("own")
    )
    paired = met.select("*", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other")).select(
        "mask", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp"
    )
    group = ["mask", "key", "low", "high"]
    return paired.repartition(*group).sortWithinPartitions(*group).mapInArrow(_link(radius), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, text_hash, component_id) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    prints = materialize(rows.mapInArrow(_fingerprints, "doc_id long, fp long, text_hash long"), "fingerprints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    found = components(near_edges(nodes, radius))
    grouped = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    grouped = materialize(grouped, "node-components")
    least = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    named = materialize(grouped.join(least, "component").select("fp", "component_id"), "node-names")
    return prints.join(named, "fp").select("doc_id", "fp", "text_hash", "component_id")


def keep_first(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of every component, the one with the smallest id, whole; rows without id where the component has none.

    Equal texts of one id stay once; different ones of one id that are near-duplicates stay together.
    """
    kept = near_duplicates(docs, radius, id_col, text_col).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = kept.select(F.col("doc_id").alias("_kept"), F.col("text_hash").alias("_hash")).distinct()
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_kept")) & (F.xxhash64(text_col) == F.col("_hash"))
    return docs.join(kept, same, "left_semi").dropDuplicates([id_col, text_col])
