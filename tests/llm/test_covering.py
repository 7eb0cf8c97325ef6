"""Fingerprints and groups against brute force."""

import random
import re

import pytest
import xxhash

from tabmill.llm import covering
from tabmill.llm.components import components

SCHEMA = "doc_id long, text string, fp int, component string"


def brute_print(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(edges, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_fingerprints(monkeypatch):
    monkeypatch.setattr(covering, "_AT_ONCE", 3)
    texts = ["", " \t", None, "A", "a b c", "a B c D", "a b c d e a b c d", "É é Z z", "x\x0by\x0cz\x1cq\x85r w", "w " * 50, "  a b"]
    for t in texts:
        assert covering.fingerprint(t) % (1 << 64) == brute_print(t), t


def test_every_pair_within_the_radius_agrees_under_a_mask():
    rng = random.Random(2)
    for radius in (1, 4):
        masks = covering.masks(radius)
        assert len(masks) == (2 << radius) - 1
        for _ in range(3000):
            change = sum(1 << i for i in rng.sample(range(64), radius))
            assert any(change & m % (1 << 64) == 0 for m in masks)


@pytest.mark.parametrize("block", [covering.BLOCK, 2])
def test_linked_fingerprints(spark, block):
    rng = random.Random(3)
    prints = {0}
    for _ in range(12):  # chains, whose ends lie far apart, and dense groups
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 25)):
            prints.add(x)
            x ^= sum(1 << i for i in rng.sample(range(64), rng.randint(1, 5)))
    base = rng.getrandbits(64)
    prints |= {base ^ 1 << i for i in range(64)}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    want = groups([(a, b) for a in signed for b in signed if (a ^ b) % (1 << 64) and ((a ^ b) % (1 << 64)).bit_count() <= 4], signed)
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long").repartition(3)
    found = {r["node"]: r["component"] for r in components(covering.near_edges(nodes, block=block)).collect()}
    assert {p: found.get(p, p) for p in signed} == want


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 400)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (2001, 2000), (2000, 2001)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == groups(edges, {n for e in edges for n in e if e[0] != e[1]})
    assert components(spark.createDataFrame([(1, 1), (None, 2)], "x long, y long")).count() == 0


def test_documents(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    base = rng.choices(words, k=400)
    rows = [(10, " ".join(base)), (11, " ".join(base).upper()), (12, " ".join([*base[:200], "new", *base[201:]]))]
    rows += [(100 + i, " ".join(rng.choices(words, k=200))) for i in range(30)]
    rows += [(200, ""), (201, None), (202, " "), (None, "alone words here now"), (None, " ".join(base)), (10, " ".join(base)), (300, "a " * 30000)]
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], SCHEMA)
    got = covering.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    prints = {p for _, t in rows for p in [brute_print(t)]}
    linked = groups([(a, b) for a in prints for b in prints if a != b and (a ^ b).bit_count() <= 4], prints)
    least = {}
    for i, t in rows:
        if i is not None:
            g = linked[brute_print(t)]
            least[g] = min(least.get(g, i), i)
    want = sorted((str(i), brute_print(t), str(least.get(linked[brute_print(t)]))) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["fp"] % (1 << 64), str(r["component_id"])) for r in got) == want
    kept = covering.keep_first(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == sorted([str(i) for i in set(least.values())] + ["None"])


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert covering.near_duplicates(docs).count() == 0 and covering.keep_first(docs).count() == 0
