"""Runs of words against all periods tried one by one."""

import random
import zlib
from hashlib import sha256

import numpy as np
import pytest

from tabmill.llm import periods, queries


def brute_runs(words, least=12):
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, 2 * q):
                stretch = words[i : i + length]
                if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def texts():
    rng = random.Random(5)
    out = [[], ["a"], ["a"] * 11, ["a"] * 12, ["a"] * 300, list("ab") * 6, list("abc") * 40 + list("x") + list("abc") * 40]
    for letters in (1, 2, 2, 3, 3, 4, 8):
        for n in (13, 40, 120, 260):
            out.append([rng.choice("abcdefgh"[:letters]) for _ in range(n)])
    for _ in range(40):  # periodic stretches within each other
        words = [rng.choice("abcdefghij") for _ in range(rng.randrange(1, 30))]
        for _ in range(4):
            at, n = rng.randrange(len(words)), rng.randrange(1, 20)
            words = words[:at] + words[at : at + n] * rng.randrange(2, 6) + words[at:]
        out.append(words[:400])
    a, b = "a", "ab"
    while len(b) < 350:
        a, b = b, b + a
    return [*out, list(b)]


@pytest.mark.parametrize("least", [2, 5, 12])
def test_all_runs_of_many_documents_at_once(least):
    docs = texts()
    numbers = {}
    words = np.array([numbers.setdefault(w, len(numbers)) for d in docs for w in d], np.int64)
    found = periods.find_runs(words, np.array([len(d) for d in docs]), least)
    want = [(k, *r) for k, d in enumerate(docs) for r in brute_runs(d, least)]
    assert [tuple(r) for r in found.tolist()] == want
    assert periods.find_runs(np.empty(0, np.int64), np.empty(0, np.int64)).shape == (0, 4)


def test_one_word_very_often_and_a_long_period():
    n = 200_000
    assert periods.find_runs(np.zeros(n, np.int64), np.array([n])).tolist() == [[0, 0, n, 1]]
    words = np.tile(np.arange(30_000), 7)[:-5]
    assert periods.find_runs(words, np.array([len(words)])).tolist() == [[0, 0, len(words), 30_000]]


def test_ordered_positions_stay_in_order():
    rng = random.Random(3)
    wanted = rng.sample(range(100_000), 9000)
    held = periods.Ordered(wanted[0])
    for x in wanted[1:]:
        held.add(x)
    ordered = sorted(wanted)
    assert list(held) == ordered and held.size == 9000
    for i in (0, 1, 1023, 1024, 5000, 8999):
        assert held.around(ordered[i]) == (ordered[i - 1] if i else None, ordered[i + 1] if i < 8999 else None)


def table(spark, rows):
    return spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, runs string").repartition(3)


def test_rows_of_a_table(spark):
    rows = [(i, " ".join(w)) for i, w in enumerate(texts())]
    rows += [(None, "x y " * 8), (None, None), (7, None), (7, ""), (7, " \t\n"), (8, " x" * 3 + " é é" * 12), (9, "same " * 20), (9, "same " * 20)]
    got = periods.periodic_runs(table(spark, rows)).collect()
    want = []
    for i, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        runs = brute_runs(words)
        want.append((i, runs, brute_collapsed(words, runs)))
    assert sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got), key=str) == sorted(want, key=str)
    assert periods.periodic_runs(table(spark, [])).collect() == []


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(11)
    rows = [(i, None if i % 61 == 0 else " \n"[i % 2].join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(0, 150)))) for i in range(400)]
    rows += [(400, "to be or not " * 9), (None, "a " * 30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r.asDict() for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    planted = 0
    for i, text in rows:
        words = (text or "").split()
        n = len(words)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            planted += 1
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert got[i] == {
            "doc_id": i, "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
            "exponent_milli": 1000 * best[1] // best[2] if runs else None,
            "runs_sha256": sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            "collapsed_sha256": sha256(brute_collapsed(words, runs).encode()).hexdigest(),
        }
    assert planted > 20 and sum(r["n_runs"] > 0 for r in got.values()) > 10
