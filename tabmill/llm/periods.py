"""Periodic runs of words by a descending-LCP Kruskal.

A run is a stretch of words with smallest period q, at least twice as long, that cannot be extended. Its first suffix and the one q words
later agree in all of the run but q words, which is q at least, and no position between them agrees with them as far. So the
classes of suffixes with a common prefix are built up by falling prefix length: the edges between neighbours of the
suffix array are taken in descending order of their common prefix (LCP), a union-find joins the classes of their ends, and the
positions of a class are kept in order. Two positions that become neighbours in a united class, at a distance within the LCP, seed a
run; those whose left words differ begin one, and every run is begun exactly once. The distance is its smallest period, the LCP plus the
distance its length.

A run of ``least`` words or more needs an LCP of half as many. So only positions whose gram of that many words occurs again in
the document are sorted, and edges below that LCP are left out: no run is lost by it. Suffixes are ranked by doubling that gram,
and common prefixes are read off the ranks. All this is done for a portion of documents at once; ``least`` alone decides what a run is.

Words are ``[^\\x20\\x09-\\x0D]+``. Defined results: null and empty texts, and texts without a word, have no runs and collapse to the
empty text; a null id is an id like any other; repeated rows get equal results; an empty table gives no rows. A document
lies in one task, which holds about a hundred bytes for each of its words. Only the named columns are read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.llm.wordwise import portions

#: Words of a run at least.
LEAST = 12
#: Bytes of text searched at once, more only for a longer document. Only memory depends on it.
PORTION = 1_000_000
SCHEMA = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TURN = np.uint64(0xD1B54A32D192ED03)
_BLOCK = 1024


class Ordered:
    """Positions in ascending order, in blocks, so that an insertion moves a bounded number of them."""

    __slots__ = ("blocks", "lasts", "size")

    def __init__(self, position: int) -> None:
        self.blocks, self.lasts, self.size = [[position]], [position], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def _block(self, position: int) -> int:
        return min(bisect_left(self.lasts, position), len(self.blocks) - 1) if len(self.blocks) > 1 else 0

    def add(self, position: int) -> None:
        k = self._block(position)
        block = self.blocks[k]
        block.insert(bisect_left(block, position), position)
        self.size += 1
        if len(block) > 2 * _BLOCK:
            self.blocks[k : k + 1] = [block[:_BLOCK], block[_BLOCK:]]
            self.lasts[k : k + 1] = [block[_BLOCK - 1], block[-1]]
        else:
            self.lasts[k] = block[-1]

    def around(self, position: int) -> tuple[int | None, int | None]:
        """The neighbours of a position that is here."""
        k = self._block(position)
        block = self.blocks[k]
        at = bisect_left(block, position)
        left = block[at - 1] if at else self.blocks[k - 1][-1] if k else None
        right = block[at + 1] if at + 1 < len(block) else self.blocks[k + 1][0] if k + 1 < len(self.blocks) else None
        return left, right


def _places(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending order of keys, and for each place of it the first place of its key and whether another row has it."""
    order = np.argsort(key, kind="stable")
    begins = np.append(True, key[order][1:] != key[order][:-1])
    first = np.maximum.accumulate(np.where(begins, np.arange(len(key)), 0))
    return order, first, ~(begins & np.append(begins[1:], True))


def _repeated_grams(words: np.ndarray, owner: np.ndarray, gram: int) -> np.ndarray:
    """Positions whose gram occurs again in their document, by a hash; some others may be among them."""
    n = len(words) - gram + 1
    if n < 2:
        return np.empty(0, np.int64)
    mixed = (words.astype(np.uint64) + np.uint64(1)) * _MIX
    mixed ^= mixed >> np.uint64(29)
    key = owner[:n].astype(np.uint64) * _TURN
    for k in range(gram):
        key = key * _MIX + mixed[k : k + n]
        key ^= key >> np.uint64(31)
    at = np.flatnonzero(owner[:n] == owner[gram - 1 :])
    order, _, shared = _places(key[at])
    return np.sort(at[order[shared]])


def common_prefixes(words: np.ndarray, owner: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours of the suffix array whose suffixes agree in ``gram`` words at least: (one, other, words in which they agree)."""
    n = len(words)
    repeated = _repeated_grams(words, owner, gram)
    # what follows a repeated stretch is ranked as well, so that the order is that of the words throughout
    known = np.unique((repeated[:, None] + np.arange(gram + 1)).ravel())
    known = known[known < n]
    ends = np.searchsorted(owner, owner[known], "right")
    columns = [owner[known], *(np.where(known + k < ends, words[np.minimum(known + k, n - 1)], -1) for k in range(gram))]
    order = np.lexsort(columns[::-1])
    begins = np.ones(len(known), bool)
    begins[1:] = np.any([c[order[1:]] != c[order[:-1]] for c in columns], axis=0)
    first = np.maximum.accumulate(np.where(begins, np.arange(len(known)), 0))
    rank = -1 - np.arange(n + 1)  # all others: each like no other
    rank[known[order]] = first
    active = open_ = known[order[~(begins & np.append(begins[1:], True))]] if len(known) else known
    ranks, length = [rank], gram
    while len(open_):
        behind = rank[np.minimum(open_ + length, n)]
        key = rank[open_] * (2 * n + 4) + behind + n + 2
        order, first, shared = _places(key)
        ordered = open_[order]
        group = rank[ordered]
        group_first = np.maximum.accumulate(np.where(np.append(True, group[1:] != group[:-1]), np.arange(len(group)), 0))
        rank = rank.copy()
        rank[ordered] = group + first - group_first
        open_ = ordered[shared]
        ranks.append(rank)
        length *= 2
    suffixes = active[np.argsort(rank[active], kind="stable")]
    a, b = suffixes[:-1], suffixes[1:]
    same = ranks[0][a] == ranks[0][b]
    a, b = a[same], b[same]
    common = np.zeros(len(a), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        agree = ranks[level][np.minimum(a + common, n)] == ranks[level][np.minimum(b + common, n)]
        common += agree * (gram << level)
    going = np.ones(len(a), bool)
    for _ in range(gram - 1):  # the grams that end one word further on
        going &= ranks[0][a + common - gram + 1] == ranks[0][b + common - gram + 1]
        common += going
    return a, b, common


def _new_neighbours(one: np.ndarray, other: np.ndarray, common: np.ndarray) -> np.ndarray:
    """(left, right, LCP) of positions that become neighbours in a class at a distance within the LCP."""
    order = np.argsort(-common, kind="stable")
    positions, ends = np.unique(np.append(one, other), return_inverse=True)
    place = positions.tolist()
    parent = list(range(len(place)))
    classes: list[Ordered | None] = [None] * len(place)
    seeds: list[tuple[int, int, int]] = []
    left_ends, right_ends = ends[: len(one)][order].tolist(), ends[len(one) :][order].tolist()
    for a, b, lcp in zip(left_ends, right_ends, common[order].tolist(), strict=True):
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        large, small = classes[a], classes[b]
        if large is None and small is not None or (large is not None and small is not None and small.size > large.size):
            a, b, large, small = b, a, small, large
        if large is None:
            large = classes[a] = Ordered(place[a])
        parent[b] = a
        if small is None:
            position = place[b]
            large.add(position)
            left, right = large.around(position)
            if left is not None and position - left <= lcp:
                seeds.append((left, position, lcp))
            if right is not None and right - position <= lcp:
                seeds.append((position, right, lcp))
            continue
        moved = list(small)
        classes[b] = None
        for position in moved:
            large.add(position)
        came = set(moved)
        for position in moved:  # once all are in: positions between others have parted them
            left, right = large.around(position)
            if left is not None and left not in came and position - left <= lcp:
                seeds.append((left, position, lcp))
            if right is not None and right not in came and right - position <= lcp:
                seeds.append((position, right, lcp))
    return np.array(seeds, np.int64).reshape(-1, 3)


def find_runs(words: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(document, start, length, period) of all runs, in this order and start before period.

    ``words``: those of all documents, as numbers; ``sizes``: how many each document has.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    firsts = np.cumsum(sizes) - sizes
    left, right, common = _new_neighbours(*common_prefixes(words, owner, max(1, -(-least // 2)))).T
    inner = left > firsts[owner[left]]
    begins = ~inner
    begins[inner] = words[left[inner] - 1] != words[right[inner] - 1]
    begins &= common + right - left >= least
    left, right, common = left[begins], right[begins], common[begins]
    document = owner[left]
    found = np.column_stack([document, left - firsts[document], common + right - left, right - left])
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def _search(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in (p for batch in batches for p in portions(batch, size=PORTION)):
            texts = [t.as_buffer().to_pybytes().split() for t in portion.column(1).cast(pa.binary())]  # at these bytes, no others
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            numbers: dict[bytes, int] = {}
            fresh = count()
            words = np.fromiter((
                number if (number := numbers.get(w)) is not None else numbers.setdefault(w, next(fresh)) for text in texts for w in text
            ), np.int64, sizes.sum())
            found = find_runs(words, sizes, least)
            firsts = np.cumsum(sizes) - sizes
            change = np.zeros(len(words) + 1, np.int64)
            begin = firsts[found[:, 0]] + found[:, 1]
            np.add.at(change, begin + found[:, 3], 1)
            np.add.at(change, begin + found[:, 2], -1)
            kept = np.cumsum(change[:-1]) == 0
            has = np.unique(found[:, 0])
            for k in has.tolist():
                texts[k] = list(compress(texts[k], kept[firsts[k] : firsts[k] + sizes[k]]))
            ends = np.searchsorted(found[:, 0], np.arange(len(texts) + 1))
            runs = pa.StructArray.from_arrays([pa.array(found[:, c]) for c in (1, 2, 3)], fields=list(_RUN))
            yield pa.record_batch([
                portion.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs),
                pa.array([b" ".join(text) for text in texts], pa.binary()).cast(pa.string()),
            ], ["doc_id", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(doc_id, runs, collapsed) of every row: its runs by start and period, in words from 0, and its words joined by spaces
    without those that a run repeats, which are all of a run behind its first period."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_search(least), SCHEMA)
