"""Encoders against the tokenizers library; token files and packing against plain Python."""

import random
import time
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tabmill.llm import binpieces, lexicon, vbyte, wordwise
from tabmill.llm.queries import BYTE_BPE, BYTE_BPE_IDS, END_ID, WORD_BPE

TEXTS = [
    "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a\n b", "a \nb", "a\n\nb", "a\t b", "x\u2003 y", "x\x1cy \x1d z", "It's 'tis we'll !'s 'S don't",
    "<|endoftext|>", "a <|endoftext|> b<|endoftext|>c", "  <|endoftext|>\n", "12 345,6 ½ ²", "日本語 テスト", "é\u0301 ﬁ Ǆ ß İ", "word... (quoted)! a_b --", "\x00 \x7f \x85 b",
    "aaaa" * 3000, "Thstinnt thndhain. Onhalyti the in, erthst orth it\nthon tiontiontion", "\U0001f600\U0001f468\u200d\U0001f469 ok", "ʼn ªº µ",
]


def _random_texts(n, seed):
    rng = random.Random(seed)
    parts = ["the", "thndhain", "É", " ", "  ", "\n", "\t", ".", "'s", "'", "12", "ß", "日", "\u00a0", "!!", "\x1f", "<|endoftext|>", "X"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(n)]


ALL = TEXTS + _random_texts(300, 5)


@pytest.fixture(scope="module")
def byte_ids():
    return [Tokenizer.from_file(BYTE_BPE).encode(t, add_special_tokens=False).ids for t in ALL]


def _lists(encoded):
    return [np.frombuffer(x, "<u4").tolist() for x in encoded.to_pylist()]


@pytest.mark.parametrize("kept", [250_000, 1])
def test_pieces_give_the_ids_of_whole_texts(byte_ids, kept, monkeypatch):
    monkeypatch.setattr(wordwise, "KEPT_PIECES", kept)
    encoder = wordwise.PieceEncoder(BYTE_BPE, keeps_space=True)
    for _ in range(3):
        assert _lists(encoder.encode(pa.array(ALL))) == byte_ids
    word = Tokenizer.from_file(WORD_BPE)
    assert _lists(wordwise.PieceEncoder(WORD_BPE, keeps_space=False).encode(pa.array(ALL))) == [word.encode(t, add_special_tokens=False).ids for t in ALL]


def test_marks_behind_a_letter_that_is_lower_cased_to_two():
    texts = [before + "İ" + marks + after for before in ("", "abc", "x ") for marks in (".", ",", ":", "...", ")", "--") for after in ("", " b", "\nb")]
    for path, keeps_space in ((WORD_BPE, False), (BYTE_BPE, True)):
        library = Tokenizer.from_file(path)
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert _lists(wordwise.PieceEncoder(path, keeps_space=keeps_space).encode(pa.array(texts))) == want
    two = {chr(c) for c in range(0x250) if chr(c).isalpha() and len(chr(c).lower()) > 1}
    assert two == {"İ"} and not any(map(wordwise.is_word, two))


def test_portions_keep_every_row(monkeypatch):
    monkeypatch.setattr(wordwise, "PORTION_BYTES", 7)
    batch = pa.record_batch([pa.array(range(5)), pa.array(["aaaa", None, "b" * 30, "", "cc"])], ["id", "text"])
    cut = list(wordwise.portions(batch))
    assert [r for p in cut for r in p.column(0).to_pylist()] == list(range(5))
    assert [t for p in cut for t in p.column(1).to_pylist()] == ["aaaa", "", "b" * 30, "", "cc"]
    assert list(wordwise.portions(batch.slice(0, 0))) == []


@pytest.mark.parametrize("pieces", [[], ["the", "thndhain", "X", "\n\nthe", "12", "a<|endoftext|>"]])
def test_transducer_and_merges_give_the_ids_of_the_library(byte_ids, pieces):
    codec = lexicon.Codec(BYTE_BPE, lexicon.Automaton(lexicon.build(pieces, BYTE_BPE)))
    encoded = codec.encode(pa.array(ALL))
    assert _lists(encoded) == byte_ids
    library = Tokenizer.from_file(BYTE_BPE)
    for ids, got in zip(byte_ids, encoded.to_pylist(), strict=True):
        assert codec.decode(got) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("word", [
    "etaoin" * 2000, "a" * 10_007, "internationalization" * 300, "".join(chr(97 + i * i % 26) for i in range(9000)), "é\u4e2d" * 700,
])
def test_words_beyond_any_length_have_the_ids_of_the_library(word):
    library = Tokenizer.from_file(BYTE_BPE)
    texts = [word, f"so {word} on", word[:511], word[:513]]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert _lists(lexicon.Codec(BYTE_BPE).encode(pa.array(texts))) == want


def test_a_megabyte_of_letters_takes_seconds():
    began = time.perf_counter()
    word = ("thequickbrownfoxjumps" * 50_000)[: 1 << 20]
    ids = lexicon.Codec(BYTE_BPE).encode(pa.array([word]))[0].as_py()
    assert time.perf_counter() - began < 15 and lexicon.Codec(BYTE_BPE).decode(ids) == word


def test_ids_are_cut_from_the_map(tmp_path):
    words = {b"tap": [1, 2, 3], b"top": [4], b"stop": [5, 70_000]}
    path = tmp_path / "lexicon.bin"
    path.write_bytes(lexicon.compile_words(words, {w: np.array(i, "<u4").tobytes() for w, i in words.items()}).astype("<i8").tobytes())
    automaton = lexicon.Automaton(np.memmap(path, "<i8", "r"))
    assert [np.frombuffer(x, "<u4").tolist() for x in automaton.lookup(list(words))] == list(words.values())


def test_byte_letters_cover_every_byte():
    assert sorted(lexicon.byte_letters().values()) == list(range(256))


def test_automaton_is_minimal_and_knows_its_words():
    words = [w.encode() for w in ["", "tap", "taps", "top", "tops", "tip", "stop", "stops"]]
    ids = {w: np.array([i, i + 1], "<u4").tobytes() for i, w in enumerate(words)}
    numbers = lexicon.compile_words([w for w in words if w], ids)
    automaton = lexicon.Automaton(numbers)
    assert [automaton.lookup([w])[0] for w in words[1:]] == [ids[w] for w in words[1:]]
    assert automaton.lookup([b"", b"ta", b"tapss", b"x", b"st"]) == [None] * 5
    suffixes = {frozenset(w[len(p):] for w in words[1:] if w.startswith(p)) for p in {w[:i] for w in words[1:] for i in range(len(w) + 1)}}
    assert int(numbers[1]) == len(suffixes)  # states are the different sets of continuations


def _docs(spark, extra=()):
    rows = [(i, t, 0) for i, t in enumerate(ALL)] + [(None, None, 1), (3, "again", 1), (3, "again", 1), *extra]
    return spark.createDataFrame(rows, "doc_id long, text string, part int").repartition(3), rows


def test_digests_of_all_rows(spark):
    docs, rows = _docs(spark)
    library = Tokenizer.from_file(BYTE_BPE)
    want = []
    for doc_id, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(decoded.encode()).hexdigest()))
    got = [tuple(r) for r in lexicon.digest_documents(docs, BYTE_BPE, n_pieces=20).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    decoded = lexicon.decode_documents(lexicon.encode_documents(docs, BYTE_BPE, n_pieces=20), BYTE_BPE).collect()
    assert sorted((r["text"] for r in decoded)) == sorted(t or "" for _, t, _ in rows)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lexicon.digest_documents(empty, BYTE_BPE).count() == 0
    assert vbyte.read_files(spark, vbyte.store_corpus(empty, BYTE_BPE, END_ID, BYTE_BPE_IDS)).count() == 0
    assert binpieces.pack(empty, WORD_BPE, END_ID).count() == 0


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_words_come_back(n):
    rng = np.random.default_rng(n)
    words = (rng.integers(0, 1 << 32, n, np.uint64) >> rng.integers(0, 32, n).astype(np.uint64)).astype("<u4")
    control, data = vbyte.encode_words(words)
    assert len(control) == -(-n // 4)
    assert vbyte.decode_words(control, data, n).tolist() == words.tolist()


@pytest.mark.parametrize("block", [1 << 18, 3])
def test_token_files(spark, monkeypatch, block):
    monkeypatch.setattr(vbyte, "BLOCK_IDS", block)
    docs, rows = _docs(spark)
    library = Tokenizer.from_file(BYTE_BPE)
    got = vbyte.read_files(spark, vbyte.store_corpus(docs, BYTE_BPE, END_ID, BYTE_BPE_IDS)).collect()
    ids = {i: [library.encode(t or "", add_special_tokens=False).ids + [END_ID] for d, t, _ in rows if d == i] for i in {r[0] for r in rows}}
    at = 0
    for row in sorted(got, key=lambda r: r["start"]):
        assert row["start"] == at
        found = np.frombuffer(row["ids"], "<u4").tolist()
        assert found in ids[row["doc_id"]] and row["n_tokens"] == len(found)
        ids[row["doc_id"]].remove(found)
        at += len(found)
    assert not any(ids.values())
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order[0] is None and order[1:] == sorted(order[1:])


@pytest.mark.parametrize(("n", "lengths"), [(1, [1]), (4096, [4096]), (8193, [4096, 4096, 1]), (4095, [1 << k for k in reversed(range(12))])])
def test_binary_lengths(n, lengths):
    assert binpieces.binary_lengths(n) == lengths


def test_packing(spark):
    docs, rows = _docs(spark, extra=[(9000, "long text " * 5000, 2)])
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = binpieces.pack(docs, WORD_BPE, END_ID).collect()
    assert sorted(p["sequence_id"] for p in pieces) == list(range(len(pieces)))
    by_length = [p["length"] for p in sorted(pieces, key=lambda p: p["sequence_id"])]
    assert by_length == sorted(by_length)
    whole = {}
    for p in sorted(pieces, key=lambda p: p["start"]):
        assert p["length"] in [1 << k for k in range(13)] and p["offset"] == 0 and len(p["tokens"]) == 4 * p["length"]
        whole.setdefault(p["doc_id"], []).append(p)
    for doc_id, text, _ in rows:
        if doc_id == 3:
            continue  # three rows share this id
        want = np.array(library.encode(text or "", add_special_tokens=False).ids + [END_ID], "<u4").tobytes()
        assert b"".join(p["tokens"] for p in whole[doc_id]) == want
        assert zlib.crc32(whole[doc_id][0]["tokens"]) == zlib.crc32(want[: len(whole[doc_id][0]["tokens"])])
        assert {p["doc_tokens"] for p in whole[doc_id]} == {len(want) // 4}


@pytest.mark.parametrize("together", [1, 3, 4096])
def test_first_numbers_of_lengths_and_tasks(spark, together):
    rng = random.Random(6)
    counts = [(1 << k, part, rng.randrange(1, 50)) for k in range(5) for part in range(20) if rng.random() < 0.7]
    rng.shuffle(counts)
    found = binpieces.first_numbers(spark.createDataFrame(counts, "length int, part int, n long"), together).collect()
    expected, at = {}, 0
    for length, part, n in sorted(counts):
        expected[length, part] = at
        at += n
    assert {(r["length"], r["part"]): r["first"] for r in found} == expected


def test_packing_with_more_tasks_than_are_sent(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "some words " * (i % 40)) for i in range(200)], "doc_id long, text string").repartition(6)
    sent = sorted(map(tuple, binpieces.pack(docs, WORD_BPE, END_ID).select("doc_id", "start", "length", "sequence_id").collect()))
    monkeypatch.setattr(binpieces, "MOST_SENT", 0)
    joined = binpieces.pack(docs, WORD_BPE, END_ID)
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()
    found = sorted(map(tuple, joined.select("doc_id", "start", "length", "sequence_id").collect()))
    assert [r[:3] for r in found] == [r[:3] for r in sent]
    assert sorted(r[3] for r in found) == sorted(r[3] for r in sent) == list(range(len(sent)))
