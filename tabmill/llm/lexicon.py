"""Byte-pair encoding with a lexicon of frequent words as a minimal acyclic transducer.

All documents are counted for their pieces; the most frequent ones, cut into words, are compiled with their ids into the smallest
automaton that accepts them. States with equal continuations are one state, so suffixes are shared; each arc adds a number, and
the numbers along a word add up to its place in the lexicon, which leads to its ids. The automaton is one file of
numbers, sent to executors as a Spark file and mapped into memory there. Words outside it are merged exactly, many at a
time, pair by pair in order of rank. The size of the lexicon decides the speed, never the ids.

Defined results: null and empty texts have no ids and decode to the empty text; the strings of added tokens inside texts
become those tokens, as in the library; repeated rows and null ids pass through; an empty table gives no rows and an empty
lexicon. Only the named columns are read.
"""

from __future__ import annotations

import heapq
import json
import uuid
from array import array
from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmill.llm.wordwise import MARKS, encode_texts, is_word, pieces_with_space, portions, whole
from tabmill.session import materialize, shared_root

#: Pieces that go into the lexicon, the most frequent of all documents first.
LEXICON_PIECES = 1 << 17
#: Bytes of a word that the automaton takes; longer ones are merged.
LONGEST_WORD = 48
#: Bytes from which a word is merged alone, by neighbours and a heap, in time that grows little faster than its length.
LONG_MERGE = 512
#: Bytes of text that a worker cuts and encodes at once; only its memory depends on it.
PORTION = 3_000_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: printable bytes stand for themselves, the others follow from 256."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """Merge rules of a byte-level vocabulary, applied to many words at once."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.token_bytes = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(letters[c] for c in token)
        for token, i in self.added.items():
            self.token_bytes[i] = token.encode()
        self.byte_id = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte_id[byte] = vocab[letter]
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.none = len(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.rank = np.append(order, self.none)
        self.made = np.array([vocab[a + b] for a, b in pairs] + [0], np.int64)
        self.by_pair: dict[int, int] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.rank[at], self.none)

    def _equal_length(self, tokens: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, ids) of words of one length; every step merges one pair in each word that still has one."""
        rows, ranks = np.arange(len(tokens)), self._ranks(tokens[:, :-1], tokens[:, 1:])
        while len(rows):
            n, width = tokens.shape
            best = ranks.argmin(axis=1) if width > 1 else np.zeros(n, np.int64)
            low = ranks[np.arange(n), best] if width > 1 else np.full(n, self.none)
            open_ = low < self.none
            if not open_.all():
                yield rows[~open_], tokens[~open_]
                rows, tokens, ranks, best, low = rows[open_], tokens[open_], ranks[open_], best[open_], low[open_]
                n = len(rows)
            if not n:
                return
            each = np.arange(n)
            tokens[each, best] = self.made[low]
            keep = np.ones((n, width), bool)
            keep[each, best + 1] = False
            tokens = tokens[keep].reshape(n, width - 1)
            ranks = ranks[keep[:, 1:]].reshape(n, width - 2)
            for at in (best - 1, best):
                if width > 2:
                    has = (at >= 0) & (at < width - 2)
                    r, a = each[has], at[has]
                    ranks[r, a] = self._ranks(tokens[r, a], tokens[r, a + 1])

    def _long(self, word: bytes) -> bytes:
        """Ids of one long word. Tokens are linked to their neighbours; the pairs there are at first come sorted, those that
        merges make from a heap. A pair whose tokens have changed since is passed over."""
        if not self.by_pair:
            self.by_pair = dict(zip(self.keys[:-1].tolist(), self.rank[:-1].tolist(), strict=True))
        first = self.byte_id[np.frombuffer(word, np.uint8)]
        ranks = self._ranks(first[:-1], first[1:])
        at = np.flatnonzero(ranks < self.none)
        sorted_pairs = iter(np.sort(ranks[at] << 32 | at).tolist())
        tokens, n = array("q", first.tobytes()), len(first)
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        rank_of, made, none = self.by_pair.get, self.made.tolist(), self.none
        heap: list[int] = []
        ready = next(sorted_pairs, None)
        while ready is not None or heap:
            if heap and (ready is None or heap[0] < ready):
                pair = heapq.heappop(heap)
            else:
                pair, ready = ready, next(sorted_pairs, None)
            rank, here = pair >> 32, pair & 0xFFFFFFFF
            right = after[here]
            if tokens[here] < 0 or right >= n or rank_of(tokens[here] << 32 | tokens[right], none) != rank:
                continue
            token = tokens[here] = made[rank]
            tokens[right] = -1
            right = after[here] = after[right]
            if right < n:
                before[right] = here
                new = rank_of(token << 32 | tokens[right])
                if new is not None:
                    heapq.heappush(heap, new << 32 | here)
            left = before[here]
            if left >= 0:
                new = rank_of(tokens[left] << 32 | token)
                if new is not None:
                    heapq.heappush(heap, new << 32 | left)
        ids = np.frombuffer(tokens, np.int64)
        return ids[ids >= 0].astype("<u4").tobytes()

    def encode(self, words: list[bytes], at_once: int = 1 << 20) -> list[bytes]:
        """Ids of every word, little-endian, 4 bytes each."""
        out = [b""] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for i in np.flatnonzero(lengths >= LONG_MERGE).tolist():
            out[i] = self._long(words[i])
        for n in np.unique(lengths[(lengths > 0) & (lengths < LONG_MERGE)]):
            same = np.flatnonzero(lengths == n)
            for chosen in np.array_split(same, -(-len(same) * int(n) // at_once)):
                text = np.frombuffer(b"".join([words[i] for i in chosen]), np.uint8)
                for rows, ids in self._equal_length(self.byte_id[text].reshape(len(chosen), n)):
                    data, width = ids.astype("<u4").tobytes(), 4 * ids.shape[1]
                    for k, i in enumerate(chosen[rows]):
                        out[i] = data[k * width : (k + 1) * width]
        return out


# --- the automaton ---------------------------------------------------------------------------------------------------


def compile_words(words: Iterable[bytes], ids: dict[bytes, bytes]) -> np.ndarray:
    """The minimal automaton as one array of numbers.

    Words are added in order. What follows the common prefix with the word before can no longer change, so its states are
    replaced by equal ones met before, from the end backwards.
    """
    ordered = sorted(set(words))
    registry: dict[tuple, int] = {}
    finals: list[bool] = []
    arcs: list[tuple] = []
    reach: list[int] = []
    path: list[list] = [[False, []]]  # open states along the current word: final, arcs (byte, state)

    def close(state: list) -> int:
        signature = (state[0], tuple(state[1]))
        known = registry.get(signature)
        if known is None:
            known = registry[signature] = len(arcs)
            finals.append(state[0])
            arcs.append(signature[1])
            reach.append(state[0] + sum(reach[t] for _, t in state[1]))
        return known

    last = b""
    for word in [*ordered, None]:
        same = 0
        if word is not None:
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
        for depth in range(len(last), same, -1):
            closed = close(path.pop())
            path[-1][1].append((last[depth - 1], closed))
        if word is None:
            break
        path += [[False, []] for _ in range(len(word) - same)]
        path[-1][0] = True
        last = word
    root = close(path[0])

    keys, targets, adds = [], [], []
    for state, leaving in enumerate(arcs):
        passed = int(finals[state])
        for byte, target in leaving:
            keys.append(state << 8 | byte)
            targets.append(target)
            adds.append(passed)
            passed += reach[target]
    known_ids = [np.frombuffer(ids[w], "<u4") for w in ordered]
    ends = np.cumsum([0, *map(len, known_ids)])
    flat = np.concatenate([*known_ids, np.zeros(sum(map(len, known_ids)) % 2, "<u4")])  # two ids in each number
    head = [len(keys), len(arcs), len(ordered), len(flat), root]
    return np.concatenate([np.asarray(x, np.int64) for x in (head, keys, targets, adds, finals, ends)] + [flat.view("<i8")])


class Automaton:
    """Looks many words up at once, one byte of each word in a step."""

    def __init__(self, numbers: np.ndarray) -> None:
        n_arcs, n_states, n_words, n_ids, self.root = map(int, numbers[:5])
        sizes = [n_arcs, n_arcs, n_arcs, n_states, n_words + 1, n_ids // 2]
        self.keys, self.targets, self.adds, self.finals, self.ends, ids = np.split(numbers[5:], np.cumsum(sizes)[:-1])
        self.ids = memoryview(ids).cast("B")

    def places(self, words: list[bytes]) -> np.ndarray:
        """Place of each word in the lexicon, -1 for the others."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lengths) - lengths
        text = np.frombuffer(b"".join(words), np.uint8)
        state, place = np.full(len(words), self.root), np.zeros(len(words), np.int64)
        out = np.full(len(words), -1)
        active = np.flatnonzero((lengths > 0) & (lengths <= LONGEST_WORD) & (len(self.keys) > 0))
        step = 0
        while len(active):
            key = state[active] << 8 | text[starts[active] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            active, at = active[found], at[found]
            state[active] = self.targets[at]
            place[active] += self.adds[at]
            step += 1
            ended = lengths[active] == step
            done = active[ended]
            out[done] = np.where(self.finals[state[done]] > 0, place[done], -1)
            active = active[~ended]
        return out

    def lookup(self, words: list[bytes]) -> list[bytes | None]:
        """Ids of the words it has, cut from the map."""
        places = self.places(words)
        ends = self.ends
        first, last = (4 * ends[np.maximum(places, 0)]).tolist(), (4 * ends[np.minimum(places + 1, len(ends) - 1)]).tolist()
        ids = self.ids
        return [bytes(ids[a:b]) if p >= 0 else None for p, a, b in zip(places.tolist(), first, last, strict=True)]


class Codec:
    """Texts to ids and back."""

    def __init__(self, path: str, automaton: Automaton | None = None) -> None:
        from tokenizers import pre_tokenizers

        self.merges = Merges(path)
        self.automaton = automaton
        self.split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str

    def words(self, piece: str) -> list[bytes]:
        """A piece, as it stands in the text, cut into words; letters with at most a space before them are one word."""
        word = piece.rstrip(MARKS)
        if is_word(word[1:] if word[:1] == " " else word):
            return [word.encode(), piece[len(word):].encode()] if len(word) < len(piece) else [word.encode()]
        return [piece[a:b].encode() for _, (a, b) in self.split(piece)]

    def encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        found = self.automaton.lookup(words) if self.automaton else [None] * len(words)
        unseen = [w for w, ids in zip(words, found, strict=True) if ids is None]
        return dict(zip(words, found, strict=True)) | dict(zip(unseen, self.merges.encode(unseen), strict=True))

    def _sections(self, piece: str) -> list[bytes | int]:
        """Words and ids of added tokens of a piece."""
        for token, i in self.merges.added.items():
            if token in piece:
                parts = [self._sections(p) if p else [] for p in piece.split(token)]
                return list(chain(parts[0], *([i, *p] for p in parts[1:])))
        return self.words(piece)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        sections = [self._sections(p) for p in pieces]
        words = list({w for s in sections for w in s if not isinstance(w, int)})
        ids = self.encode_words(words)
        ids |= {i: i.to_bytes(4, "little") for i in self.merges.added.values()}
        return [ids[s[0]] if len(s) == 1 else b"".join([ids[w] for w in s]) for s in sections]

    def encode(self, texts: pa.Array) -> pa.Array:
        """Ids of every text, little-endian, 4 bytes each; every distinct piece is encoded once."""
        return encode_texts(pieces_with_space(texts), lambda pieces: self.encode_pieces(list(map(whole, pieces))))

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.merges.token_bytes.__getitem__, array("I", ids))).decode("utf-8", "replace")


# --- on Spark ----------------------------------------------------------------------------------------------------------


def _count_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for portion in (p for batch in batches for p in portions(batch, text=0, size=PORTION)):
        counts = pc.value_counts(pieces_with_space(portion.column(0)).flatten())
        yield pa.record_batch([counts.field("values"), counts.field("counts")], ["piece", "n"])


def frequent_pieces(docs: DataFrame, text_col: str = "text", n: int = LEXICON_PIECES) -> list[str]:
    """The most frequent pieces of all documents, n at most: those at or above the least count that leaves no more.

    Tasks count before the shuffle. Counts are put in steps of an eighth of a doubling to find that count, so the driver
    gets a row per step and then n pieces at most, whatever the corpus.
    """
    pieces = docs.select(F.col(text_col).alias("text")).mapInArrow(_count_pieces, "piece string, n long")
    counts = materialize(
        pieces.groupBy("piece").agg(F.sum("n").alias("n")).withColumn("step", F.floor(8 * F.log2("n")).cast("int")), "piece-counts"
    )
    left, least = n, None
    for row in counts.groupBy("step").count().orderBy(F.desc("step")).collect():
        left -= row["count"]
        if left < 0:
            break
        least = row["step"]
    return [] if least is None else [r["piece"] for r in counts.where(F.col("step") >= least).select("piece").collect()]


def build(pieces: Iterable[str], tokenizer_path: str) -> np.ndarray:
    """The automaton of the words that the pieces consist of."""
    codec = Codec(tokenizer_path)
    words = {w for p in pieces for w in codec._sections(whole(p)) if not isinstance(w, int) and len(w) <= LONGEST_WORD}
    return compile_words(words, codec.encode_words(list(words)))


def publish(spark: SparkSession, numbers: np.ndarray) -> str:
    """Write the automaton to the shared folder and name it a file of every executor, also of those that start later."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/{name}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(numbers.astype("<i8").tobytes()))
    finally:
        out.close()
    spark.sparkContext.addFile(path.toString())
    return name


_CODECS: dict[tuple[str, str], Codec] = {}


def _codec(tokenizer_path: str, name: str = "") -> Codec:
    """One for each worker process; of several lexicons it keeps the latest."""
    if (tokenizer_path, name) not in _CODECS:
        for old in [k for k in _CODECS if k[1] and name]:
            del _CODECS[old]
        automaton = Automaton(np.memmap(SparkFiles.get(name), "<i8", "r")) if name else None
        _CODECS[tokenizer_path, name] = Codec(tokenizer_path, automaton)
    return _CODECS[tokenizer_path, name]


def _encode(tokenizer_path: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(tokenizer_path, name)
        for portion in (p for batch in batches for p in portions(batch, size=PORTION)):
            yield pa.record_batch([portion.column(0), codec.encode(portion.column(1)).cast(pa.binary())], ["doc_id", "ids"])

    return run


def encode_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", n_pieces: int = LEXICON_PIECES
) -> DataFrame:
    """(doc_id, ids): the ids the library gives, little-endian, 4 bytes each."""
    name = publish(docs.sparkSession, build(frequent_pieces(docs, text_col, n_pieces), tokenizer_path))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_encode(tokenizer_path, name), "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """The same rows with ``text``, decoded from ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _codec(tokenizer_path).decode
        for batch in batches:
            ids = batch.column(1)
            yield pa.record_batch([batch.column(0), ids, pa.array(map(decode, ids.to_pylist()), pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def digest_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", n_pieces: int = LEXICON_PIECES
) -> DataFrame:
    """Per row the number of ids, a digest of the ids as decimal numbers, and one of the text decoded from them.

    Encoding and decoding take place in one step, so a task needs one Python worker.
    """
    name = publish(docs.sparkSession, build(frequent_pieces(docs, text_col, n_pieces), tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, decimal = _codec(tokenizer_path, name), {}
        for portion in (p for batch in batches for p in portions(batch, size=PORTION)):
            columns: tuple[list, list, list] = ([], [], [])
            for scalar in codec.encode(portion.column(1)):
                ids = scalar.as_py()
                numbers = array("I", ids)
                decimal |= {i: str(i) for i in set(numbers) if i not in decimal}
                columns[0].append(len(numbers))
                columns[1].append(sha256(",".join(map(decimal.__getitem__, numbers)).encode()).hexdigest())
                columns[2].append(sha256(codec.decode(ids).encode()).hexdigest())
            yield pa.record_batch([portion.column(0), *map(pa.array, columns)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
