"""Hard negatives by Fagin's threshold algorithm.

The components of all vectors are brought to integers, and the rows are dealt to blocks. A block sorts its rows once by every dimension. For
an anchor each of these lists is read from its large end where the anchor's component is positive and from its small end
where it is negative; every row met is looked up and scored whole, in integers. After some depth no row that was not met can score more
than the threshold: the anchor's product with the values the lists have come to. A window of scores is done in the block once
the threshold lies strictly below its k-th best score so far, for at equal scores the smaller id counts, or below the least score it admits.

This is done twice: for the best rows of the anchor's own label (its positives), in blocks of one label, and for the best rows of other
labels within a window for each positive, in blocks of all labels. Every block gives at most k rows for each window, and those of
all blocks are ranked by Spark, each window by itself. A label or table of any size is cut in blocks of bounded size, and anchors in groups;
each pair of a group and a block is one group of bounded size, so the work is that of the anchors times the rows at most, less what the
threshold saves.

Defined results: rows with a null id, label or vector, an empty vector, a null or non-finite component take no part, nor do vectors
whose length after scaling is 2^26 or more (their scores would not be exact); vectors of different numbers of components do not
meet; a repeated row is a row of its own, also beside the anchor it repeats; an anchor that stands there twice has its
results twice; a positive with a negative score has no negatives; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabmill.session import materialize

#: Integer steps of one unit; positives of an anchor, negatives of a positive; the window in hundredths of a positive's score.
SCALE, POSITIVES, NEGATIVES, WINDOW = 256, 5, 10, (30, 90)
#: Anchors are the rows whose id this divides.
ANCHOR_EVERY = 100
#: Components of a block, anchors of a group, and rows that are read from every list at first. Results do not depend on them.
BLOCK_CELLS, GROUP, DEPTH = 1 << 19, 256, 16
#: Squared length from which products are not exact in double precision.
LONGEST = float(1 << 52)


def prepared(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(row, id, label, dimension, q) of the rows that take part; ``q``: the integers, as text of doubles of 8 bytes for numpy."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v")
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & F.forall("v", finite))
    # the length is checked before the cast, which would overflow
    scaled = rows.withColumn("v", F.transform("v", lambda x: x * SCALE)).where(
        F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x) < LONGEST
    )
    whole = scaled.select("id", "label", F.size("v").alias("dimension"), F.transform("v", lambda x: F.floor(x)).alias("q"))
    return whole.select(F.monotonically_increasing_id().alias("row"), "*")


class Block:
    """Rows of a block with their order in every dimension."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, q: np.ndarray) -> None:
        self.rows, self.ids, self.labels, self.q = rows, ids, labels, q
        self.order = np.ascontiguousarray(np.argsort(q, axis=0, kind="stable").T)
        self.values = np.take_along_axis(q.T, self.order, axis=1)

    def met(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """Step by step the rows newly met, their scores, and the threshold: no other row scores more."""
        n = len(self.q)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(up) + len(down):
            yield np.arange(n), np.zeros(n), -np.inf
            return
        seen = np.zeros(n, bool)
        at, depth, left = 0, DEPTH, n
        while left:
            to = min(n, at + depth)
            now = seen.copy()
            now[self.order[up, n - to : n - at]] = True
            now[self.order[down, at:to]] = True
            fresh = np.flatnonzero(now & ~seen)
            seen = now
            left -= len(fresh)
            reached = anchor[up] @ self.values[up, n - to] + anchor[down] @ self.values[down, to - 1]
            yield fresh, self.q[fresh] @ anchor, float(reached) if left else -np.inf
            at, depth = to, 2 * depth


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, equal ones by smaller id."""
    if len(scores) > 4 * k:
        chosen = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
        return chosen[np.lexsort((ids[chosen], -scores[chosen]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def search(block: Block, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[float, float]], k: int) -> list[np.ndarray]:
    """For every window (least and greatest score, both admitted) the places of its k best allowed rows, by the threshold algorithm."""
    found = [np.empty(0, np.int64)] * len(windows)
    scores = np.full(len(allowed), np.nan)
    open_ = list(range(len(windows)))
    for fresh, fresh_scores, reached in block.met(anchor):
        scores[fresh] = fresh_scores
        fresh, fresh_scores = fresh[allowed[fresh]], fresh_scores[allowed[fresh]]
        going = []
        for w in open_:
            least, greatest = windows[w]
            inside = fresh[(fresh_scores >= least) & (fresh_scores <= greatest)]
            if len(inside):
                both = np.append(found[w], inside)
                found[w] = both[best(scores[both], block.ids[both], k)]
            enough = scores[found[w][-1]] if len(found[w]) == k else least
            if reached >= max(enough, least):
                going.append(w)
        open_ = going
        if not open_:
            break
    return found


def bounds(positive: int) -> tuple[float, float]:
    """The scores that a negative of a positive may have, both admitted; the first above the second: none."""
    low, high = WINDOW
    return float(-(-low * positive // 100)), float(high * positive // 100)


_CELL = ["dimension", "part", "block", "team"]
_MET = "anchor_row long, place int, id long, score long"


def _meet(k: int, positives: bool):
    """Searches the anchors of a team in a block. Rows come sorted by cell, the block's before the anchors; a cell may go on in the
    next batch."""

    def starts(rows: pa.Table) -> np.ndarray:
        keys = np.column_stack([rows[c].to_numpy() for c in _CELL])
        return np.append(0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1)

    def cell(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        anchors = rows["is_anchor"].to_numpy()
        size = rows["dimension"][0].as_py()
        q = rows["q"].combine_chunks().flatten().to_numpy().reshape(len(rows), size).astype(np.float64)
        own, ids, labels = (rows[c].to_numpy() for c in ("row", "id", "label"))
        inside = ~anchors
        if not inside.any() or not anchors.any():
            return
        block = Block(own[inside], ids[inside], labels[inside], q[inside])
        limits = rows["limits"]
        out: list[tuple[np.ndarray, ...]] = []
        for a in np.flatnonzero(anchors).tolist():
            if positives:
                windows, allowed = [(-np.inf, np.inf)], block.rows != own[a]
            else:
                windows, allowed = [bounds(p) for p in limits[a].as_py()], block.labels != labels[a]
            for place, chosen in enumerate(search(block, q[a], allowed, windows, k)):
                n = len(chosen)
                out.append((np.full(n, own[a]), np.full(n, place, np.int32), block.ids[chosen], (block.q[chosen] @ q[a]).astype(np.int64)))
        if out:
            yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["anchor_row", "place", "id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in (b for b in batches if b.num_rows):
            rows = pa.Table.from_batches([batch])
            begins = starts(rows)
            if held and any(held[0][c][0] != rows[c][0] for c in _CELL):
                yield from cell(pa.concat_tables(held))
                held = []
            for first, stop in zip(begins, [*begins[1:], len(rows)], strict=True):
                held.append(rows.slice(first, stop - first))
                if stop < len(rows):
                    yield from cell(pa.concat_tables(held))
                    held = []
        if held:
            yield from cell(pa.concat_tables(held))

    return run


def _in_cells(rows: DataFrame, anchors: DataFrame, part: str | None, k: int, positives: bool) -> DataFrame:
    """What the anchors find in every block; ``part``: a column that anchors and blocks must share."""
    columns = ["row", "id", "label", "dimension", "q", "part"]
    with_part = lambda df: df.withColumn("part", F.col(part) if part else F.lit(0).cast("long"))
    rows, anchors = with_part(rows), with_part(anchors)
    sizes = rows.groupBy("dimension", "part").agg(F.count("*").alias("n")).withColumn(
        "blocks", F.ceil(F.col("n") * F.least("dimension", F.lit(BLOCK_CELLS)) / BLOCK_CELLS).cast("int")
    )
    teams = anchors.groupBy("dimension", "part").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("teams"))
    plan = materialize(sizes.join(teams, ["dimension", "part"]).drop("n"), "negative-plan")  # parts with an anchor
    deal = lambda n: F.pmod(F.xxhash64("row"), n).cast("int")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    none = F.array().cast("array<long>")
    inside = rows.join(plan, ["dimension", "part"]).select(
        *columns, none.alias("limits"), F.lit(False).alias("is_anchor"), deal(F.col("blocks")).alias("block"), numbers(F.col("teams")).alias("team")
    )
    asking = anchors.join(plan, ["dimension", "part"]).select(
        *columns, "limits", F.lit(True).alias("is_anchor"), numbers(F.col("blocks")).alias("block"), deal(F.col("teams")).alias("team")
    )
    met = inside.unionByName(asking).repartition(*_CELL).sortWithinPartitions(*_CELL, "is_anchor")
    return met.mapInArrow(_meet(k, positives), _MET)


def _ranked(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = W.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = ANCHOR_EVERY,
    n_positives: int = POSITIVES, n_negatives: int = NEGATIVES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every anchor and each of its best rows of
    the same label the best rows of other labels within the window of that score."""
    rows = materialize(prepared(vectors, id_col, vector_col, label_col), "negative-rows")
    anchors = rows.where(F.col("id") % every == 0).withColumn("limits", F.array().cast("array<long>"))
    found = _in_cells(rows, anchors, "label", n_positives, True)
    positives = materialize(_ranked(found, n_positives, "anchor_row").select("anchor_row", "rank", "id", "score"), "positives")
    limits = positives.groupBy("anchor_row").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("all"))  # few
    asking = anchors.drop("limits").join(limits, F.col("row") == F.col("anchor_row")).withColumn("limits", F.col("all.score"))
    met = _in_cells(rows, asking.drop("anchor_row", "all"), None, n_negatives, False)
    negatives = materialize(_ranked(met, n_negatives, "anchor_row", "place"), "negatives").withColumnsRenamed(
        {"id": "negative_id", "score": "negative_score"}
    )
    named = positives.select("anchor_row", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = anchors.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id"))
    return negatives.join(named, ["anchor_row", "place"]).join(names, "anchor_row").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
