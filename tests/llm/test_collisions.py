"""Links between vectors against brute force."""

import math

import numpy as np
import pytest

from tabmill.llm import collisions

SCHEMA = "vec_id long, embedding array<float>, label int, node string, weight int"


def planted(seed, n=300, dimension=24):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, dimension))
    for size in (2, 3, 10, 60):
        centre = rng.normal(size=dimension)
        rows = np.vstack([rows, centre + rng.normal(size=(size, dimension)) * rng.uniform(0.1, 0.3)])
    return [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(rows)]


def brute(rows):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {}
    parent = {i: i for i, _ in good}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, u) in enumerate(good):
        for j, (b, v) in enumerate(good):
            if i != j and len(u) == len(v) and u @ v / math.sqrt(u @ u) / math.sqrt(v @ v) >= 0.9:
                links[i] = links.get(i, 0) + 1
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    out = [(a, links.get(i, 0), root(a)) for i, (a, _) in enumerate(good)]
    return out


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 0, "clash", 1) for i, v in rows], SCHEMA).repartition(3)
    return collisions.near_vectors(df, **options).collect()


@pytest.mark.parametrize("options", [{}, {"cell": 16, "block": 8}])
def test_recall_and_no_false_link(spark, options):
    rows = planted(1)
    got = {r["vec_id"]: r for r in found(spark, rows, **options)}
    want = brute(rows)
    total = sum(n for _, n, _ in want)
    assert total > 1000 and all(got[i]["n_links"] <= n for i, n, _ in want)
    assert sum(r["n_links"] for r in got.values()) >= 0.98 * total
    assert sum(got[i]["component_id"] == c for i, _, c in want) >= 0.98 * len(want)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_defined_results(spark):
    nan, inf = float("nan"), float("inf")
    rows = planted(2, n=20, dimension=4)
    copy = rows[3][1]
    rows += [(500 + i, copy) for i in range(40)] + [(500, copy)]
    alone = [(900, None), (901, []), (902, [0.0] * 4), (903, [1.0, None, 1.0, 1.0]), (904, [nan] * 4), (905, [inf, 1.0, 1.0, 1.0]), (None, copy)]
    short = [(950, [1.0, 1.0]), (951, [2.0, 2.0]), (952, [1e30, 1e30]), (953, [1e-30, 1e-30]), (954, [-1.0, -1.0])]
    got = found(spark, rows + alone + short)
    assert len(got) == len(rows + alone + short)
    want = brute(rows + alone + short)
    usable = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got if r["vec_id"] is not None and not 900 <= r["vec_id"] <= 905)
    assert usable == sorted(want)
    for r in got:
        if r["vec_id"] is None:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, None, False)
        elif 900 <= r["vec_id"] <= 905:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, r["vec_id"], True)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_collisions_are_counted_around_every_query():
    values = np.random.default_rng(3).normal(size=(40, 7))
    want = (np.abs(values[:, None, :] - values[None, :, :]) <= 0.5).sum(axis=2)
    assert (collisions.collision_counts(values, 0.5) == want).all()


def test_count_keeps_the_recall_wanted():
    rng = np.random.default_rng(4)
    u = rng.normal(size=(3000, 32))
    u /= np.linalg.norm(u, axis=1)[:, None]
    w = rng.normal(size=u.shape)
    w -= (w * u).sum(axis=1)[:, None] * u
    w /= np.linalg.norm(w, axis=1)[:, None]
    v = 0.9 * u + math.sqrt(1 - 0.81) * w
    away = np.abs((u - v) @ collisions.directions(32, collisions.PROJECTIONS, 1))
    hits = (away <= collisions.HALF_WINDOW * math.sqrt(0.2)).sum(axis=1)
    assert (hits >= collisions.least_count()).mean() >= 0.99
    signs, tables = collisions.plan(1_000_000)
    assert 1 - (1 - (1 - math.acos(0.9) / math.pi) ** signs) ** tables >= collisions.CELL_RECALL


def test_different_vectors_of_one_id_are_not_mixed_up(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (0, [-1.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in collisions.near_vectors(df).collect())
    assert got == [(0, 0, 0), (1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]
    df = spark.createDataFrame([(5, [1.0, 0.0]), (5, [0.0, 1.0]), (4, [0.01, 1.0])], "vec_id long, embedding array<float>")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in collisions.near_vectors(df).collect())
    assert got == [(4, 1, 4), (5, 0, 5), (5, 1, 4)]
