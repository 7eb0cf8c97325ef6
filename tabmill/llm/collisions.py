"""Near-duplicate vectors by collision-counting projections.

Many random one-dimensional projections are sorted. Around every vector (the query) a window of fixed width is opened in each
order, and each vector in it scores a collision with the query; a pair at the limit of similarity collides in a projection with a
known chance, so the count that such pairs reach with the wanted recall follows from the binomial law. Pairs that
reach it are verified by their cosine in double precision, and only verified pairs are links.

Windows over a whole table would collide in a share of all pairs. So each of several tables first deals the vectors to cells
by the signs of projections of its own, as many that a cell has about ``CELL`` vectors of an even table, and windows are
opened within cells. The number of tables follows from the recall wanted for pairs at the limit; closer pairs are found more often. A cell of any
size is handled whole: beyond ``BLOCK`` vectors it is cut, and every pair of blocks is one group of bounded size.

Equal vectors are one node with a weight. A group sends on, per node, how many vectors it is linked with and one edge of
its components, never its pairs; a pair that shares several cells is counted in the first of them.

Defined results: vectors that are null, empty, zero or hold null or non-finite numbers, and vectors without id, are linked with nothing;
vectors of different lengths are never linked; different vectors of one id are nodes of their own; repeated rows are vectors of their own, linked with each other; an empty table gives no rows. Only the
named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.llm.components import components
from tabmill.session import materialize

LEAST_COSINE = 0.9
#: Wanted share of the pairs at the limit that share a cell, and that reach the count there.
CELL_RECALL, COUNT_RECALL = 0.99, 0.998
CELL = 256
BLOCK = 512
PROJECTIONS = 24
#: Half a window in standard deviations of the difference between two vectors at the limit.
HALF_WINDOW = 1.5
SEED = 7
_NAME = "struct<first: long, hash: long>"


def plan(n: int, least: float = LEAST_COSINE, recall: float = CELL_RECALL, cell: int = CELL) -> tuple[int, int]:
    """(signs per cell, tables) for n vectors."""
    signs = min(30, max(0, math.ceil(math.log2(max(n, 1) / cell))))
    same_cell = (1 - math.acos(least) / math.pi) ** signs
    return signs, 1 if signs == 0 else math.ceil(math.log(1 - recall) / math.log(1 - same_cell))


def least_count(projections: int = PROJECTIONS, recall: float = COUNT_RECALL, half_window: float = HALF_WINDOW) -> int:
    """The largest count that a pair at the limit reaches with the recall wanted."""
    hit = math.erf(half_window / math.sqrt(2))
    reached = 0.0
    for count in range(projections, -1, -1):
        reached += math.comb(projections, count) * hit**count * (1 - hit) ** (projections - count)
        if reached >= recall:
            return count
    return 0


@lru_cache(maxsize=8)
def directions(dimension: int, n: int, kind: int) -> np.ndarray:
    return np.random.default_rng([SEED, kind, dimension]).standard_normal((dimension, n))


def collision_counts(values: np.ndarray, half_width: float) -> np.ndarray:
    """How often each vector lies in each query's window; ``values`` has a row per vector and a column per projection."""
    n = len(values)
    counts = np.zeros((n, n), np.int16)
    rows = np.arange(n)
    for column in values.T:
        order = np.argsort(column)
        ordered = column[order]
        edges = np.zeros((n, n + 1), np.int16)
        edges[rows, np.searchsorted(ordered, ordered - half_width, "left")] += 1
        edges[rows, np.searchsorted(ordered, ordered + half_width, "right")] -= 1
        rank = np.empty(n, np.int64)
        rank[order] = rows
        counts += np.cumsum(edges, axis=1, dtype=np.int16)[rank][:, rank]
    return counts


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares of very large or small numbers
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _deal(signs: int, tables: int):
    """A row for every vector and table: the cell, the cells of all tables, the vector's bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch["vector"].value_lengths())
            flat = batch["vector"].flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(sizes)
            for dimension in np.unique(sizes):
                at = np.flatnonzero(sizes == dimension)
                vectors = flat[(ends[at] - dimension)[:, None] + np.arange(dimension)]
                bits = (_unit(vectors) @ directions(int(dimension), signs * tables, 0) > 0).reshape(len(at), tables, signs)
                cells = (bits << np.arange(signs, dtype=np.int64)).sum(axis=2, dtype=np.int64).astype("<i4")
                whole = [c.tobytes() for c in cells]
                data = [v.tobytes() for v in vectors.astype("<f8")]
                for table in range(tables):
                    yield pa.record_batch([
                        pa.array(np.full(len(at), dimension, np.int32)), pa.array(np.full(len(at), table, np.int32)),
                        pa.array(cells[:, table]), batch["node"].take(pa.array(at)), batch["weight"].take(pa.array(at)),
                        pa.array(whole, pa.binary()), pa.array(data, pa.binary()),
                    ], ["dimension", "tab", "cell", "node", "weight", "cells", "data"])

    return run


def _link_group(table: int, split: bool, side: np.ndarray, weights: np.ndarray, cells: np.ndarray,
                vectors: np.ndarray, least: float, projections: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, linked weight, first place of its component) of the nodes of a group that have a link there."""
    unit = _unit(vectors)
    half_width = HALF_WINDOW * math.sqrt(2 - 2 * least)
    passing = collision_counts(unit @ directions(unit.shape[1], projections, 1), half_width) >= least_count(projections)
    a, b = np.nonzero(np.triu(passing, 1))
    if split:
        across = side[a] != side[b]
        a, b = a[across], b[across]
    close = np.empty(len(a), bool)
    for at in range(0, len(a), 1 << 16):
        i, j = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
        close[at : at + (1 << 16)] = (unit[i] * unit[j]).sum(axis=1) >= least
    a, b = a[close], b[close]
    label = np.arange(len(weights))
    while True:
        lower = label.copy()
        np.minimum.at(lower, a, label[b])
        np.minimum.at(lower, b, label[a])
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    counted = ~(cells[a, :table] == cells[b, :table]).any(axis=1)
    linked = np.zeros(len(weights), np.int64)
    np.add.at(linked, a[counted], weights[b[counted]])
    np.add.at(linked, b[counted], weights[a[counted]])
    some = np.zeros(len(weights), bool)
    some[a] = some[b] = True
    return np.flatnonzero(some), linked[some], label[some]


def _link(least: float, projections: int):
    names = ["dimension", "tab", "cell", "low", "high"]

    def groups(rows: pa.Table) -> np.ndarray:
        keys = np.column_stack([rows[c].to_numpy() for c in names])
        return np.append(0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1)

    def link(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if not len(rows):
            return
        starts = groups(rows)
        found = []
        for first, stop in zip(starts, np.append(starts[1:], len(rows)), strict=True):
            if stop - first < 2:
                continue
            group = rows.slice(first, stop - first)
            head = {c: group[c][0].as_py() for c in names}
            vectors = np.frombuffer(b"".join(group["data"].to_pylist()), "<f8").reshape(len(group), head["dimension"])
            cells = np.frombuffer(b"".join(group["cells"].to_pylist()), "<i4").reshape(len(group), -1)
            at, linked, roots = _link_group(
                head["tab"], head["low"] != head["high"], group["own"].to_numpy(), group["weight"].to_numpy(), cells, vectors, least, projections,
            )
            found.append((at + first, linked, roots + first))
        if found:
            at, linked, roots = (pa.array(np.concatenate(x)) for x in zip(*found, strict=True))
            called = rows["node"].combine_chunks()
            yield pa.record_batch([called.take(at), linked, called.take(roots)], ["node", "linked", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group; a group may go on in the next batch."""
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            last = int(groups(rows)[-1]) if len(rows) else 0
            yield from link(rows.slice(0, last))
            held = rows.slice(last)
        if held is not None:
            yield from link(held)

    return run


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = LEAST_COSINE,
    recall: float = CELL_RECALL, cell: int = CELL, block: int = BLOCK, projections: int = PROJECTIONS,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.coalesce(
        F.col("vec_id").isNotNull() & (F.size("vector") > 0) & F.forall("vector", number) & F.exists("vector", lambda x: x != 0), F.lit(False)
    )
    rows = rows.withColumn("usable", usable)
    # different vectors of one id have names of their own; the least name of a component holds its smallest id
    name = F.struct(F.min("vec_id").alias("first"), F.xxhash64("vector").alias("hash"))
    nodes = materialize(rows.where("usable").groupBy("vector").agg(name.alias("node"), F.count("*").alias("weight")), "vector-nodes")
    signs, tables = plan(nodes.count(), least, recall, cell)
    dealt = nodes.mapInArrow(
        _deal(signs, tables), f"dimension int, tab int, cell int, node {_NAME}, weight long, cells binary, data binary"
    )
    place = ["dimension", "tab", "cell"]
    large = materialize(
        dealt.groupBy(*place).agg(F.count("*").alias("n")).where(F.col("n") > block)
        .select(*place, F.ceil(F.col("n") / block).cast("int").alias("blocks")), "large-cells"
    )
    blocks = F.coalesce("blocks", F.lit(1))
    own = dealt.join(large, place, "left").select("*", F.pmod(F.hash("node"), blocks).alias("own"))
    met = own.select("*", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")).select(
        *place, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "weight", "cells", "data"
    )
    group = [*place, "low", "high"]
    linked = materialize(
        met.repartition(*group).sortWithinPartitions(*group).mapInArrow(
            _link(least, projections), f"node {_NAME}, linked long, root {_NAME}"
        ),
        "vector-links",
    )
    counts = linked.groupBy("node").agg(F.sum("linked").alias("linked"))
    joined = components(linked.where("node != root").select("node", "root").distinct())
    named = materialize(
        nodes.join(counts, "node", "left").join(joined, "node", "left").select(
            "vector", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node")["first"].alias("component_id")
        ), "vector-names",
    )
    linked_rows = rows.where("usable").join(named, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked_rows.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
