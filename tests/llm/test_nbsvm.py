"""The classifier: its descent against the optimum, signal on labels not seen, defined results."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmill.llm import nbsvm
from tabmill.llm.queries import QUERIES


def test_held_out_rule(spark):
    import zlib

    rows = spark.range(50).select(F.col("id"), nbsvm.is_held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in rows)


def test_descent_reaches_the_optimum():
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(12, 5, replace=False)) for _ in range(60)]
    scaled = [rng.normal(size=5) for _ in rows]
    positive = np.array([x.sum() + rng.normal() > 0 for x in scaled])
    penalties = np.full(60, 0.7)
    weights = nbsvm.descend(rows, scaled, positive, 12, penalties, passes=3000)

    def loss(w):
        margins = np.array([(1 if p else -1) * (w[r] @ x) for r, x, p in zip(rows, scaled, positive, strict=True)])
        return w @ w / 2 + (penalties * np.maximum(0, 1 - margins)).sum()

    best = loss(weights)
    for _ in range(300):
        assert loss(weights + rng.normal(size=12) * rng.choice([1e-1, 1e-2, 1e-3])) >= best - 1e-4


def test_log_count_ratios():
    rows = [np.array([0, 1]), np.array([1]), np.array([2])]
    ratio = nbsvm.log_count_ratios(rows, np.array([True, True, False]), 3)
    assert np.allclose(ratio, np.log([2 / 6, 3 / 6, 1 / 6]) - np.log([1 / 4, 1 / 4, 2 / 4]))


def test_curve_is_calibrated():
    rng = np.random.default_rng(2)
    margins = rng.normal(size=4000)
    positive = rng.random(4000) < 1 / (1 + np.exp(-(2 * margins - 0.5)))
    slope, offset = nbsvm.fit_curve(margins, positive)
    assert abs(slope - 2) < 0.2 and abs(offset + 0.5) < 0.2


def test_indicators_do_not_depend_on_the_cut(monkeypatch):
    present = np.zeros(1 << nbsvm.HASH_BITS, bool)
    text = ("Some Words, 12 !! of É\n" * 40).encode()
    whole = nbsvm.indicators(text, present)
    assert not present.any() and (np.diff(whole) > 0).all()
    assert nbsvm.indicators(b"", present).tolist() == []
    assert set(nbsvm.indicators(text[:200], present)) <= set(whole)


def documents(spark, n=240):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices("aeiounrst", k=rng.randint(2, 8))) for _ in range(rng.randint(20, 200))]
        good = i % 4 != 0
        rows.append((i, " ".join(words) + "." if good else "!! ".join(w.upper() for w in words), "clash"))
        labels.append((i, int(good), 0))
    rows += [(9000, None, ""), (9001, "", ""), (None, "a text without id", ""), (1, rows[1][1], "again")]
    labels += [(9001, None, 0), (5, 0, 0), (5, 1, 1), (7, 1, 1), (7777, 1, 1), (None, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, text int")


def test_labels_not_seen_are_predicted(spark):
    docs, labels = documents(spark)
    model = nbsvm.train(docs, labels)
    scored = docs.select("doc_id", nbsvm.is_held_out(F.col("doc_id")).alias("held"), nbsvm.score(F.col("text"), model).alias("p")).collect()
    assert len(scored) == docs.count() and all(0 <= r["p"] <= 1 for r in scored)
    assert all((r["p"] >= 0.5) == (r["doc_id"] % 4 != 0) for r in scored if r["held"] and (r["doc_id"] or 0) < 240)
    sample = nbsvm.training_rows(docs, labels)
    ids = [r["_id"] for r in sample.collect()]
    assert len(ids) == len(set(ids)) and 5 not in ids and not [r for r in sample.where(nbsvm.is_held_out(F.col("_id"))).collect()]
    assert nbsvm.training_rows(docs, labels, n_rows=10).count() == 10


@pytest.mark.parametrize("kind", ["none", "one class", "no documents"])
def test_too_little_to_learn_from(spark, kind):
    docs, labels = documents(spark, 12)
    labels = {"none": labels.limit(0), "one class": labels.where("quality = 1"), "no documents": labels}[kind]
    docs = docs.limit(0) if kind == "no documents" else docs
    model = nbsvm.train(docs, labels)
    scores = {r[0] for r in docs.select(nbsvm.score(F.col("text"), model)).collect()}
    assert len(scores) == (0 if kind == "no documents" else 1)


def test_accuracy_on_the_held_out_rows_of_the_table(spark, sf):
    scored = QUERIES["op2_nb_support_vectors"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.9
