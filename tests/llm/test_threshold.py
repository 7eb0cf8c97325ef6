"""Hard negatives against all scores of all rows."""

import math
import random

import numpy as np
import pytest

from tabmill.llm import queries, threshold


def brute(rows, relabel=False, every=100, n_pos=5, n_neg=10):
    """rows: (id, label, vector); every anchor against every row, in Python's integers."""
    whole = []
    for at, (i, label, v) in enumerate(rows):
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole.append((at, i, (label + 1) % 10 if relabel and i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for at, i, label, q in whole:
        if i % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(q, p)), j, m) for k, j, m, p in whole if k != at and len(p) == len(q)))
        for s, j, _ in [x for x in scored if x[2] == label][:n_pos]:
            inside = [(t, n) for t, n, m in scored if m != label and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(i, j, r + 1, n, -s, -t) for r, (t, n) in enumerate(inside[:n_neg])]
    return sorted(out)


def vectors(n, d, labels, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(labels, d))
    out = []
    for i in range(n):
        label = int(rng.integers(0, labels))
        out.append((i, label, np.float32(rng.normal(size=d) * spread + middles[label] * (i % 3 > 0)).tolist()))
    return out


def table(spark, rows):
    return spark.createDataFrame(
        [(i, v, label, "clash", "clash") for i, label, v in rows], "vec_id long, embedding array<float>, label int, row string, rank string"
    ).repartition(4)


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("n, d, labels, block, group, depth", [
    (300, 6, 3, 1 << 19, 256, 16), (300, 6, 3, 60, 2, 1), (700, 3, 40, 200, 3, 4), (250, 16, 1, 999, 1, 2), (400, 1, 5, 17, 2, 1),
])
def test_all_negatives(spark, monkeypatch, n, d, labels, block, group, depth):
    for name, value in (("BLOCK_CELLS", block), ("GROUP", group), ("DEPTH", depth)):
        monkeypatch.setattr(threshold, name, value)
    rows = vectors(n, d, labels, seed=n + d)
    assert found(threshold.hard_negatives(table(spark, rows), every=50)) == brute(rows, every=50)


def test_rows_that_take_no_part_ties_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(threshold, "BLOCK_CELLS", 40)
    rows = vectors(120, 4, 3, seed=9)
    nan, inf = float("nan"), float("inf")
    rows += [(None, 1, [1.0] * 4), (200, None, [1.0] * 4), (201, 1, None), (202, 1, []), (203, 1, [1.0, None, 1.0, 1.0]), (300, 1, [1.0, nan, 0.0, 0.0])]
    rows += [(204, 1, [1.0, inf, 0.0, 0.0]), (205, 1, [1.0, 2.0]), (400, 2, [1.0, 2.0]), (500, 2, [0.0] * 4), (206, 2, [0.0] * 4)]
    rows += [(207 + i % 3, 1, [0.5] * 4) for i in range(60)]  # a group of copies
    rows += [(600, 0, [0.5, 0.25, -0.5, 1.0])] * 2
    assert found(threshold.hard_negatives(table(spark, rows))) == brute(rows)
    assert found(threshold.hard_negatives(table(spark, rows[:0]))) == []
    assert found(threshold.hard_negatives(table(spark, [(100, 1, [1.0])]))) == []


def test_vectors_too_long_for_exact_scores_take_no_part(spark):
    rows = vectors(150, 3, 2, seed=4)
    got = found(threshold.hard_negatives(table(spark, [*rows, (700, 1, [1e30, 1.0, 1.0]), (701, 1, [3e38] * 3)])))
    assert got == brute(rows) and got


def test_reading_stops_at_the_threshold():
    rng = np.random.default_rng(2)
    q = np.floor(rng.normal(size=(4000, 3)) * 100)
    block = threshold.Block(np.arange(4000), np.arange(4000), np.zeros(4000, np.int64), q)
    anchor = np.array([90.0, -5.0, 0.0])
    met, want = [], q @ anchor
    for fresh, scores, reached in block.met(anchor):
        assert (scores == want[fresh]).all()
        met += fresh.tolist()
        unmet = np.setdiff1d(np.arange(4000), met)
        assert not len(unmet) or want[unmet].max() <= reached
    assert sorted(met) == list(range(4000))
    looked = []
    block.met, reader = lambda a: (looked.append(len(x[0])) or x for x in reader(a)), block.met
    got = threshold.search(block, anchor, np.ones(4000, bool), [(-np.inf, np.inf)], 10)[0]
    assert got.tolist() == np.lexsort((np.arange(4000), -want))[:10].tolist() and sum(looked) < 1000


def test_bounds_are_whole_numbers_inside_the_window():
    for p in [*range(0, 500), 10**15 + 7]:
        low, high = threshold.bounds(p)
        assert 100 * low >= 30 * p > 100 * (low - 1) and 100 * high <= 90 * p < 100 * (high + 1)
    assert threshold.bounds(-5)[0] > threshold.bounds(-5)[1]


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = vectors(900, 8, 10, seed=21, spread=0.3) + [(None, 3, [0.1] * 8), (1400, None, [0.1] * 8), (1500, 4, None)]
    rng.shuffle(rows)
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op13_hard_negatives(spark, str(tmp_path))
    assert dict(got.dtypes) == {
        "anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"
    }
    assert found(got) == brute(rows, relabel=True)
