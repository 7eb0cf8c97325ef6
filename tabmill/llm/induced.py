"""Suffix arrays by induced sorting, in array steps.

Every suffix is smaller or larger than its right neighbour; a smaller one with a larger one before it is leftmost-smaller. The
stretches between leftmost-smaller positions are sorted by inducing, named by rank, and the string of names is sorted by the same
function one level down. From the order of the leftmost-smaller suffixes all others are induced in two passes.

Over small alphabets a pass takes the buckets in order and treats what a bucket holds as one array, so it is linear. The names of
lower levels are too many for a step per bucket; there a pass ranks the chains that lead to the suffixes known, by
doubling along the chains, which gives the same order.
"""

from __future__ import annotations

import numpy as np

#: Alphabets up to this size are sorted bucket by bucket. The order does not depend on it.
FEW_SYMBOLS = 1024


def _smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next. The last symbol is the only least one and counts as smaller."""
    n = len(text)
    differs = np.flatnonzero(text[1:] != text[:-1])
    upcoming = differs[np.searchsorted(differs, np.arange(n - 1))]  # end of the run a position lies in
    return np.append(text[upcoming] < text[upcoming + 1], True)


def _by_buckets(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, size: int) -> np.ndarray:
    """The order of all suffixes from ordered leftmost-smaller ones; if those are ordered by symbol alone, that of stretches."""
    n = len(text)
    order = np.empty(n, np.int64)
    count = np.bincount(text, minlength=size)
    ends = np.cumsum(count)
    starts = ends - count
    n_larger = np.bincount(text[~smaller], minlength=size)
    seed_ends = np.cumsum(np.bincount(text[seeds], minlength=size))
    used = np.flatnonzero(count)

    def before(block: np.ndarray, kind: bool) -> tuple[np.ndarray, np.ndarray]:
        """Positions left of the block's that are of the kind, grouped by symbol, and their symbols."""
        left = block[block > 0] - 1
        left = left[smaller[left] == kind]
        symbols = text[left]
        grouped = np.argsort(symbols, kind="stable")
        return left[grouped], symbols[grouped]

    fill = starts.copy()
    for c in used:
        done = starts[c]
        while done < fill[c]:
            block, done = order[done : fill[c]], fill[c]
            left, symbols = before(block, False)
            sizes = np.bincount(symbols, minlength=size)
            order[(fill - np.cumsum(sizes) + sizes)[symbols] + np.arange(len(left))] = left
            fill += sizes
        first = seed_ends[c - 1] if c else 0
        left, symbols = before(seeds[first : seed_ends[c]], False)
        sizes = np.bincount(symbols, minlength=size)
        order[(fill - np.cumsum(sizes) + sizes)[symbols] + np.arange(len(left))] = left
        fill += sizes

    fill = ends.copy()
    order[0] = n - 1  # the least symbol: alone in its bucket
    for c in used[::-1]:
        if c == text[-1]:
            break
        done = ends[c]
        larger_end = starts[c] + n_larger[c]
        while True:
            whole = done <= fill[c]
            block = order[starts[c] : larger_end][::-1] if whole else order[fill[c] : done][::-1]
            done = fill[c]
            left, symbols = before(block, True)
            sizes = np.bincount(symbols, minlength=size)
            order[(fill - 1 + np.cumsum(sizes) - sizes)[symbols] - np.arange(len(left))] = left
            fill -= sizes
            if whole:
                break
    return order


def _first_places(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By row, the place of the first row of equal key in ascending order, and whether another row has the key."""
    order = np.argsort(key)
    ordered = key[order]
    begins = np.append(True, ordered[1:] != ordered[:-1])
    first = np.maximum.accumulate(np.where(begins, np.arange(len(key)), 0))
    place, shared = np.empty(len(key), np.int64), np.empty(len(key), bool)
    place[order] = first
    shared[order] = ~(begins & np.append(begins[1:], True))
    return place, shared


def _dense(values: np.ndarray) -> np.ndarray:
    """Ranks from 0 without gaps, equal ones for equal values."""
    return np.unique(values, return_inverse=True)[1]


def _along_chains(text: np.ndarray, chained: np.ndarray, known: np.ndarray, known_first: bool) -> np.ndarray:
    """Ranks of the chained suffixes and the known ones among themselves; every chain of right neighbours ends in a known one.

    ``known`` has ranks of known suffixes, and -1 elsewhere. Of one symbol, known suffixes come before all chained ones or
    after them.
    """
    at = np.flatnonzero(chained | (known >= 0))
    nothing = len(at)
    place = np.full(len(text) + 1, nothing)
    place[at] = np.arange(nothing)
    ends = known[at] >= 0
    known_rank = np.where(ends, known[at] + 1, 0)
    rank, shared = _first_places((2 * text[at].astype(np.int64) + (ends != known_first)) * (int(known_rank.max()) + 1) + known_rank)
    follows = np.where(ends, nothing, place[at + 1])
    open_ = np.flatnonzero(shared & (follows < nothing))  # suffixes of one rank: all their chains go on, or none
    while len(open_):
        behind = np.append(rank + 1, 0)[follows[open_]]
        refined, shared = _first_places(rank[open_] * (nothing + 1) + behind)
        whole, _ = _first_places(rank[open_])
        rank[open_] += refined - whole
        follows = np.append(follows, nothing)[follows]
        open_ = open_[shared & (follows[open_] < nothing)]
    out = np.full(len(text), -1)
    out[at] = rank
    return out


def _by_chains(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, seed_ranks: np.ndarray) -> np.ndarray:
    """Ranks of all suffixes, as by buckets but for large alphabets; equal ranks of seeds give equal ranks."""
    known = np.full(len(text), -1)
    known[seeds] = seed_ranks
    known = np.where(smaller, -1, _along_chains(text, ~smaller, known, known_first=False))
    known[-1] = 0
    chained = smaller.copy()
    chained[-1] = False
    return _along_chains(text, chained, known, known_first=True)


def _names(text: np.ndarray, ordered: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Ranks of ordered stretches, equal ones for equal stretches; a stretch ends with the first symbol of the next."""
    length = np.zeros(len(text), np.int64)
    length[seeds[:-1]] = np.diff(seeds)
    a, b = ordered[:-1], ordered[1:]
    equal = np.zeros(len(a), bool)
    left = np.flatnonzero(length[a] == length[b])
    step = 0
    while len(left):
        left = left[text[a[left] + step] == text[b[left] + step]]
        done = length[a[left]] == step
        equal[left[done]] = True
        left = left[~done]
        step += 1
    return np.cumsum(np.append(0, ~equal))


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in ascending order. ``text``: symbols from 0; the last is 0 and occurs nowhere else."""
    n, size = len(text), int(text.max(initial=0)) + 1
    if n < 3:
        return np.arange(n)[::-1].copy()
    smaller = _smaller(text)
    leftmost = np.append(False, smaller[1:] & ~smaller[:-1])
    seeds = np.flatnonzero(leftmost)
    names = np.empty(n, np.int64)
    if size <= FEW_SYMBOLS:
        text = text.astype(np.uint16)
        ordered = _by_buckets(text, smaller, seeds[np.argsort(text[seeds], kind="stable")], size)
        ordered = ordered[leftmost[ordered]]
        names[ordered] = _names(text, ordered, seeds)
    else:
        ranks = _by_chains(text, smaller, seeds, _dense(text[seeds]))
        names[seeds] = _dense(ranks[seeds])
    named = names[seeds]
    if named.max() + 1 < len(seeds):
        ordered = seeds[suffix_array(named)]
    else:
        ordered = seeds[np.argsort(named)]
    if size <= FEW_SYMBOLS:
        return _by_buckets(text, smaller, ordered, size)
    return np.argsort(_by_chains(text, smaller, ordered, np.arange(len(ordered))), kind="stable")


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """By position, in how many bytes its suffix agrees with the one before it in order, counted up to ``most``.

    Positions are taken in text order (permuted), so neighbours in the text read neighbouring bytes; eight bytes are compared
    at once.
    """
    n = len(data)
    padded = np.zeros(n + most + 16, np.uint8)
    padded[:n] = data
    words = np.ndarray((n + most + 8,), "<u8", padded.data, strides=(1,))
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = order[0]
    common = np.zeros(n, np.int64)
    active = np.flatnonzero(before != np.arange(n))
    for at in range(0, most, 8):
        differs = words[active + at] ^ words[before[active] + at]
        same = differs == 0
        ended = active[~same]
        lowest = differs[~same] & (~differs[~same] + np.uint64(1))
        common[ended] = at + (np.bitwise_count(lowest - np.uint64(1)) >> 3)
        active = active[same]
    common[active] = most
    reach = n - np.maximum(np.arange(n), before)
    return np.minimum(np.minimum(common, reach), most)
