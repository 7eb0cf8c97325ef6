"""Every stage of the pipeline against plain Python, on the rows the stage before it kept."""

import corpus_pipeline
import numpy as np
import pytest
from tokenizers import Tokenizer

from tabmill.llm.covering import fingerprint
from tabmill.llm.queries import END_ID, WORD_BPE
from tabmill.session import materialize
from test_covering import groups
from test_hostrules import counters
from test_suffixes import brute


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf), "stage")
        out.append(docs)
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_all_but_the_last_return_the_columns_of_documents(stages):
    assert len(corpus_pipeline.STAGES) == 5
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_classifier_keeps_rows_as_they_are(stages, spark, sf):
    before, after = rows(stages[0]), rows(stages[1])
    assert all(before[i] == r for i, r in after.items())
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert np.mean([(i in after) == (q == 1) for i, q in quality.items()]) >= 0.95


def test_rules_keep_what_passes(stages):
    before, after = rows(stages[1]), rows(stages[2])
    passing = set()
    for i, r in before.items():
        n, _, _, _, repeated = counters(r["text"])
        if not (n < 50 or 100 * repeated > 50 * n):
            passing.add(i)
    assert set(after) == passing  # no host of this table falls


def test_one_document_of_each_group_stays(stages):
    before, after = rows(stages[2]), rows(stages[3])
    prints = {i: fingerprint(r["text"]) for i, r in before.items()}
    nodes = set(prints.values())
    linked = groups([(a, b) for a in nodes for b in nodes if a != b and ((a ^ b) % (1 << 64)).bit_count() <= 4], nodes)
    first = {}
    for i, p in prints.items():
        first[linked[p]] = min(first.get(linked[p], i), i)
    assert set(after) == set(first.values())


def test_repeats_are_removed_at_whole_characters(stages):
    before, after = rows(stages[3]), rows(stages[4])
    left = {i: kept for i, kept, _ in brute([(i, r["text"]) for i, r in before.items()])}
    assert set(after) == set(before)
    for i, r in after.items():
        text = r["text"].encode()
        assert len(text) - len(left[str(i)]) <= 3 * 2 * 50 and r["n_chars"] == len(r["text"])
        if before[i]["text"].isascii():
            assert text == left[str(i)]


def test_sequences_hold_all_tokens(stages):
    docs, pieces = rows(stages[4]), stages[5].collect()
    library = Tokenizer.from_file(WORD_BPE)
    held = {}
    for p in sorted(pieces, key=lambda p: p["start"]):
        held[p["doc_id"]] = held.get(p["doc_id"], b"") + p["tokens"]
    want = {i: np.array(library.encode(r["text"], add_special_tokens=False).ids + [END_ID], "<u4").tobytes() for i, r in docs.items()}
    assert held == want


def test_run_gives_the_last_stage(spark, sf, stages):
    got = corpus_pipeline.run(spark, sf)
    assert got.dtypes == stages[-1].dtypes
    assert got.select("doc_id", "start", "tokens").exceptAll(stages[-1].select("doc_id", "start", "tokens")).isEmpty()
