"""Whole texts through a public tokenizer, piece by piece.

The tokenizers here never let a token span the change from text to white space, so a text may be cut there and each piece
be encoded alone. Most pieces repeat: of a portion of texts each distinct piece is encoded once, and a worker keeps the ids
of pieces while its memory has room. Cutting, finding the distinct pieces and putting ids together are Arrow steps.

A piece is written without the space it begins with. One that begins with a line end has none, and one that begins with two
line ends stands as it is behind them.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space as Unicode has it; Python's own notion also takes in four control characters.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: The same for Arrow: white space before a space or a line end.
SPACE_RUN = "[" + re.sub(r"\\[xu]([0-9a-f]+)", r"\\x{\1}", SPACE) + "][ \\n]"
_PIECE = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
AS_IS = "\n\n"
#: Marks that never share a token with the letters before them.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Pieces of each of two generations that a worker keeps encoded, about 160 bytes each, and bytes of text it takes at once.
#: Only memory and speed depend on them.
KEPT_PIECES = 350_000
PORTION_BYTES = 12_000_000
WORDS_AT_ONCE = 20


def whole(piece: str) -> str:
    """A piece as it stands in the text."""
    if piece.startswith(AS_IS):
        return piece[len(AS_IS):]
    return piece if piece.startswith("\n") else " " + piece


def is_word(text: str) -> bool:
    """Letters only, of those every version of Unicode calls letters, none of which is lower-cased to a letter and a mark."""
    return text.isalpha() and (text.isascii() or max(text) < "\u0250" and "\u0130" not in text)


def pieces_with_space(texts: pa.Array) -> pa.ListArray:
    """The pieces of every text; together, as they stand, they are the text. Runs of white space are cut by a pattern."""
    runs = pc.match_substring_regex(texts, SPACE_RUN)
    if pc.any(runs).as_py():
        cut = [[AS_IS + p for p in _PIECE.findall(t)] if run else None for t, run in zip(texts.to_pylist(), runs.to_pylist(), strict=True)]
        easy = pieces_with_space(texts.filter(pc.invert(runs)))
        hard = pa.array([c for c in cut if c is not None], pa.list_(pa.string()))
        at = np.cumsum(~np.asarray(runs)) - 1
        at[np.asarray(runs)] = len(easy) + np.arange(len(hard))
        return pa.concat_arrays([easy, hard]).take(pa.array(at))
    marked = pc.binary_join_element_wise(AS_IS, pc.replace_substring(texts, "\n", " \n"), "")
    return pc.split_pattern(marked, " ")


def words_without_space(texts: pa.Array) -> pa.ListArray:
    return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")


def encode_texts(cut: pa.ListArray, encode_distinct: Callable[[list[str]], list[bytes]]) -> pa.Array:
    """Ids of every text as binary, from its pieces and what encodes distinct pieces."""
    coded = cut.flatten().dictionary_encode()
    values = pa.array(encode_distinct(coded.dictionary.to_pylist()), pa.large_binary()).take(coded.indices)
    ends = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    offsets = np.asarray(cut.offsets)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(cut), [None, pa.py_buffer(ends[offsets - offsets[0]].tobytes()), values.buffers()[2]]
    )


def portions(batch: pa.RecordBatch, text: int = 1, size: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of bounded size, null texts as empty ones; a longer text makes a slice of its own."""
    filled = pc.fill_null(batch.column(text), "")
    batch = batch.set_column(text, batch.schema.names[text], filled)
    ends = np.cumsum(np.asarray(pc.binary_length(filled), np.int64))
    first = 0
    while first < len(ends):
        last = np.searchsorted(ends, (ends[first - 1] if first else 0) + (size or PORTION_BYTES), "right")
        yield batch.slice(first, max(1, last - first))
        first = max(first + 1, last)


class PieceEncoder:
    """Encodes texts to little-endian ids, 4 bytes each. ``keeps_space``: white space is part of the tokens."""

    def __init__(self, path: str, keeps_space: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cut, self.form, self.bare, self.between = (
            (pieces_with_space, whole, AS_IS, "\n") if keeps_space else (words_without_space, str, "", " | ")
        )
        (self.mark,) = self.tokenizer.encode(self.between, add_special_tokens=False).ids
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encode_new(self, pieces: Iterable[str]) -> None:
        """Take pieces over from the older generation or encode them."""
        known, older = self.known, self.older
        new = []
        for piece in dict.fromkeys(pieces):
            if piece not in known:
                ids = older.get(piece)
                if ids is None:
                    new.append(piece)
                else:
                    known[piece] = ids
        words = [p for p in new if is_word(p)]
        known |= zip(words, self._encode_words(words), strict=True)
        others = [p for p in new if p not in known]
        done = self.tokenizer.encode_batch_fast(list(map(self.form, others)), add_special_tokens=False)
        for piece, encoded in zip(others, done, strict=True):
            known[piece] = array("I", encoded.ids).tobytes()

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters. Some are encoded as one text, with a token between them that no such word has."""
        forms = list(map(self.form, words))
        texts = [self.between.join(forms[i : i + WORDS_AT_ONCE]) for i in range(0, len(forms), WORDS_AT_ONCE)]
        flat = array("I")
        for encoded in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            flat.extend(encoded.ids)
            flat.append(self.mark)
        ends = np.flatnonzero(np.frombuffer(flat, "<u4") == self.mark).tolist() if words else []
        data = flat.tobytes()
        return [data[4 * a : 4 * b] for a, b in zip([0, *(e + 1 for e in ends[:-1])], ends, strict=True)] if words else []

    def _distinct(self, pieces: list[str]) -> list[bytes]:
        if len(self.known) > KEPT_PIECES:
            self.older, self.known = self.known, {}
        ended = {}  # words with marks behind them, which are tokens of their own
        for piece in pieces:
            word = piece.rstrip(MARKS)
            if len(word) < len(piece) and is_word(word):
                ended[piece] = word, self.bare + piece[len(word):]
        self._encode_new(chain((p for p in pieces if p not in ended), chain.from_iterable(ended.values())))
        known = self.known
        return [known[ended[p][0]] + known[ended[p][1]] if p in ended else known[p] for p in pieces]

    def encode(self, texts: pa.Array) -> pa.Array:
        return encode_texts(self.cut(texts), self._distinct)


_ENCODERS: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, keeps_space: bool) -> PieceEncoder:
    """One for each worker process."""
    if (path, keeps_space) not in _ENCODERS:
        _ENCODERS[path, keeps_space] = PieceEncoder(path, keeps_space)
    return _ENCODERS[path, keeps_space]
