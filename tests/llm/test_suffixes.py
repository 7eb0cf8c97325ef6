"""Suffix arrays and the removal of repeats against brute force."""

import random
import uuid

import numpy as np
import pytest

from tabmill.llm import induced, suffixes

SCHEMA = "doc_id long, text string, tie string, row int, kept string"


@pytest.mark.parametrize("few", [induced.FEW_SYMBOLS, 2])
def test_order_and_common_prefixes(monkeypatch, few):
    monkeypatch.setattr(induced, "FEW_SYMBOLS", few)
    rng = random.Random(few)
    for case in range(400):
        text = bytes(rng.randint(97, 96 + rng.choice([1, 2, 5, 20])) for _ in range(rng.randint(0, 50))) * rng.choice([1, 1, 3])
        order = induced.suffix_array(np.append(np.frombuffer(text, np.uint8).astype(np.int64) + 1, 0))
        assert order.tolist() == [len(text), *sorted(range(len(text)), key=lambda i: text[i:])]
        common = induced.common_prefixes(np.append(np.frombuffer(text, np.uint8), np.uint8(0)), order, 12)
        for a, b in zip(order[:-1], order[1:], strict=True):
            same = 0
            while same < 12 and max(a, b) + same < len(text) and text[a + same] == text[b + same]:
                same += 1
            assert common[b] == same


def test_every_string_lies_in_one_segment_and_equal_strings_share_a_hash(monkeypatch):
    monkeypatch.setattr(suffixes, "_HASHED_AT_ONCE", 300)
    rng = random.Random(5)
    texts = [bytes(rng.choices(b"ab", k=n)) for n in (0, 99, 100, 101, 1500)] + [b"x" * 700, b"abc" * 200, b""]
    seen, covered = {}, [np.zeros(max(len(t) - 99, 0), int) for t in texts]
    for found in suffixes.segments(texts):
        for text, hash_, content, start, size, uses in zip(*(x.tolist() for x in found), strict=True):
            covered[text][start : start + size - 99] += 1
            strings = [texts[text][i : i + 100] for i in range(start, start + size - 99)]
            assert uses == 2 or len(set(strings)) == len(strings)
            for s in strings:
                assert seen.setdefault(s, hash_) == hash_
    assert all((c == 1).all() for c in covered)


def brute(rows, length=100):
    """By row: what is left, and the number of runs removed."""
    seen, out = {}, []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    for i in order:
        text = (rows[i][1] or "").encode()
        gone = np.zeros(len(text) + 1, bool)
        for at in range(len(text) - length + 1):
            first = seen.setdefault(text[at : at + length], (rows[i], at))
            if first != (rows[i], at):
                gone[at : at + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0])
        out.append((str(rows[i][0]), bytes(b for b, g in zip(text, gone, strict=False) if not g), runs))
    return sorted(out)


def sentences(rng, n):
    return " ".join("".join(rng.choices("abcdefghié", k=rng.randint(2, 9))) for _ in range(n))


@pytest.mark.parametrize("divided", [suffixes.DIVIDED_FROM, 3])
@pytest.mark.parametrize("at_once", [suffixes.SORTED_AT_ONCE, 500])
def test_against_brute_force(spark, monkeypatch, divided, at_once):
    monkeypatch.setattr(suffixes, "DIVIDED_FROM", divided)
    monkeypatch.setattr(suffixes, "SORTED_AT_ONCE", at_once)
    rng = random.Random(6)
    passage, line = sentences(rng, 60), "This line stands in very many documents and is a little longer than a hundred bytes, as a licence is, say."
    rows = [(0, passage), (1, sentences(rng, 30) + passage + sentences(rng, 10)), (2, passage[50:400] + sentences(rng, 20)), (3, passage)]
    rows += [(10 + i, sentences(rng, 5) + line + sentences(rng, 12)) for i in range(40)]
    rows += [(100, "abcde " * 200), (101, "x" * 1000), (102, sentences(rng, 20) * 3), (103, "é" * 300), (104, "\x00" * 250 + "\x01" * 250)]
    rows += [(200, ""), (201, None), (202, "a" * 99), (203, passage[:99]), (None, passage[100:300]), (300, sentences(rng, 3000))]
    docs = spark.createDataFrame([(i, t, "clash", 1, "clash") for i, t in rows], SCHEMA).repartition(4)
    got = suffixes.remove_repeats(docs).select("row.doc_id", "kept", "spans").collect()
    assert sorted((str(r["doc_id"]), bytes(r["kept"]), len(r["spans"])) for r in got) == brute(rows)


def test_equal_strings_of_divided_segments_share_their_middle(monkeypatch):
    monkeypatch.setattr(suffixes, "_HASHED_AT_ONCE", 400)
    rng = random.Random(10)
    line = bytes(rng.choices(b"abcdef", k=130))
    texts = [bytes(rng.choices(b"abcdef", k=rng.randint(0, 90))) + line + bytes(rng.choices(b"abcdef", k=rng.randint(0, 90))) for _ in range(30)]
    texts += [b"ab" * 120, b"abc" * 90]
    middles, covered = {}, [np.zeros(len(t) - 99, int) for t in texts]
    for piece, start, size, middle in suffixes._divided(texts, 100, suffixes.GRAM):
        for at in range(start, start + size - 99):
            covered[piece][at] += 1
            shared = texts[piece][middle : middle + 91]
            assert len(shared) == 91 and shared in texts[piece][at : at + 100]
            assert middles.setdefault(texts[piece][at : at + 100], shared) == shared
    assert all((c == 1).all() for c in covered)
    assert list(suffixes._divided([], 100, suffixes.GRAM)) == []


def test_pieces_that_share_only_their_middle_are_sorted_apart(spark, monkeypatch, tmp_path):
    """A line of a hundred bytes and more between texts that differ: no group of a task grows with the documents."""
    real = suffixes.repeated_strings

    def noted(pieces, doc_ids, places, length):
        (tmp_path / uuid.uuid4().hex).write_text(str(max(map(len, pieces), default=0) and sum(map(len, pieces))))
        return real(pieces, doc_ids, places, length)

    monkeypatch.setattr(suffixes, "DIVIDED_FROM", 3)
    monkeypatch.setattr(suffixes, "CROWDED_FROM", 20, raising=False)
    monkeypatch.setattr(suffixes, "SORTED_AT_ONCE", 1)
    monkeypatch.setattr(suffixes, "repeated_strings", noted)
    rng = random.Random(11)
    line = "".join(rng.choices("abcdefgh", k=104))
    rows = [(i, "".join(rng.choices("abcdefgh", k=120)) + line + "".join(rng.choices("abcdefgh", k=120))) for i in range(300)]
    docs = spark.createDataFrame([(i, t, "", 0, "") for i, t in rows], SCHEMA).repartition(2)
    got = suffixes.remove_repeats(docs).select("row.doc_id", "kept", "spans").collect()
    assert sorted((str(r["doc_id"]), bytes(r["kept"]), len(r["spans"])) for r in got) == brute(rows)
    assert max(int(f.read_text()) for f in tmp_path.iterdir()) <= 20 * 109


def test_rows_of_one_id(spark):
    rng = random.Random(8)
    text, other = sentences(rng, 40), sentences(rng, 40)
    rows = [(1, text), (1, text), (1, other + text), (2, text)]
    docs = spark.createDataFrame([(i, t, "", 0, "") for i, t in rows], SCHEMA)
    got = [(r["doc_id"], bytes(r["kept"]).decode()) for r in suffixes.remove_repeats(docs).select("row.doc_id", "kept").collect()]
    assert got.count((2, "")) == 1
    copies = sum(t.count(text) for _, t in got)
    assert copies in (1, 2)  # the first by checksum: the longer row once, or the two equal rows, which are one document


def test_whole_characters(spark):
    rng = random.Random(9)
    tail = sentences(rng, 40)
    rows = [(1, "é" + tail + "é"), (2, "ũ" + tail + "ĩ")]  # the two letters before share their second byte
    docs = spark.createDataFrame([(i, t, "", 0, "") for i, t in rows], SCHEMA)
    got = {r["doc_id"]: bytes(r["kept"]).decode() for r in suffixes.remove_repeats(docs, whole_characters=True).select("row.doc_id", "kept").collect()}
    assert got == {1: "é" + tail + "é", 2: "ũĩ"}
    text = "aéb日c".encode()
    assert suffixes.on_characters(text, [(2, 3), (1, 2), (0, 5), (5, 7), (6, 8)]) == [(0, 4), (7, 8)]


def test_empty_table(spark):
    assert suffixes.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
