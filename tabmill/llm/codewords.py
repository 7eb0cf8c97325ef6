"""Language identification by error-correcting output codes.

Every language has a codeword of bits, far from all others. For each bit a binary n-gram classifier tells the languages with 1 there
from those with 0: the log ratio of the smoothed shares of hashed byte n-grams in the two groups, every language of a group weighing alike. A
text's margin in a bit is the sum of the ratios of its n-grams over the root of their number; a logistic curve turns margins
into log odds. Decoding is weighted by loss: a codeword loses, in every bit, the logistic loss of the log odds for its own value, times
how reliable the bit has proved; the language with the least loss is chosen. The score is its share of exp(-loss) over all
languages, and a text is ambiguous where the runner-up loses hardly more.

N-grams are counted over all training texts by tasks, and the counts are added up by Spark; the model has one number for each bit and
hashed n-gram, whatever the table holds. Curves and reliabilities come from at most ``CURVE_ROWS`` different training rows, chosen
by hashes of their ids among a tenth that is not counted. The languages, a row each, are read by the driver: their number sets the
length of the codewords. Texts are read as letters: A-Z in lower case, everything else in ASCII a space, bytes beyond as they are.

Defined results: null texts and texts without a letter are ``und`` with score 0 and not ambiguous; with one language learned every
other text has it, with score 1; with none all texts are ``und``. Rows with a null language or id teach nothing; repeated rows count
as often as they stand there; null ids are predicted like others and are not held out; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmill.llm.nbsvm import fit_curve
from tabmill.session import discard, materialize

UNKNOWN = "und"
#: Lengths of the n-grams, and bits of their hashes.
GRAMS = (2, 3, 4)
HASH_BITS = 15
SMOOTHING = 0.5
#: Different training rows that set the curves at most, and the share (one in so many) that is kept from the counts for them.
CURVE_ROWS, CURVE_SHARE = 4096, 10
#: Up to so many languages all splits are bits; beyond it, bits for each doubling of the languages, and tries to find them.
ALL_SPLITS, BITS_A_DOUBLING, TRIES = 6, 8, 200
#: A text is ambiguous if the score of its language is below this share.
CLEAR = 0.8
SEED = 5
_AT_ONCE = 1 << 20

_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)
_MIX = np.uint32(0x9E3779B1)


def codebook(n: int) -> np.ndarray:
    """Codewords of n languages as rows of -1 and 1; no bit is equal for all languages, or equal or opposite to another bit.

    Few languages get every split of them in two, by which any two codewords differ in half the bits at least. For more, the best of
    several random books is taken: the one whose closest two codewords are farthest apart.
    """
    if n < 2:
        return np.ones((n, 0))
    if n <= ALL_SPLITS:
        splits = [s for k in range(1, n) for s in combinations(range(n), k) if 0 in s]
        book = np.full((n, len(splits)), -1.0)
        for bit, chosen in enumerate(splits):
            book[list(chosen), bit] = 1
        return book
    rng = np.random.default_rng(SEED)
    length = max(2 ** (ALL_SPLITS - 1) - 1, BITS_A_DOUBLING * math.ceil(math.log2(n)))
    best, best_distance = None, -1.0
    for _ in range(TRIES):
        book = np.ones((n, length))
        taken: set[bytes] = set()
        for bit in range(length):
            while True:
                split = rng.permutation(np.where(np.arange(n) < n // 2, 1.0, -1.0))
                split *= split[0]
                if split.tobytes() not in taken:
                    break
            taken.add(split.tobytes())
            book[:, bit] = split
        apart = (length - book @ book.T) / 2 + length * np.eye(n)
        if apart.min() > best_distance:
            best, best_distance = book, apart.min()
    return best


def gram_counts(text: bytes, bits: int = HASH_BITS) -> np.ndarray:
    """How often each hashed n-gram stands in a text; runs of spaces count as one, and a text begins and ends with one."""
    counts = np.zeros(1 << bits, np.int64)
    last = np.frombuffer(b" ", np.uint8)
    first = True
    for at in range(0, len(text) + 1, _AT_ONCE):
        data = _LETTERS[np.frombuffer(text[at : at + _AT_ONCE], np.uint8)]
        if at + _AT_ONCE > len(text):
            data = np.append(data, np.uint8(32))
        data = np.concatenate([last, data])
        kept = np.ones(len(data), bool)
        kept[1:] = (data[1:] != 32) | (data[:-1] != 32)
        data = data[kept]
        wide = data.astype(np.uint32)
        for n in GRAMS:
            # n-grams that end in this cut: those within what was carried over have been counted
            begin = 0 if first else max(0, len(last) - n + 1)
            packed = np.full(max(len(data) - n + 1 - begin, 0), n, np.uint32)
            for k in range(n):
                packed = (packed << np.uint32(8)) ^ wide[begin + k : begin + k + len(packed)]
            mixed = packed * _MIX
            counts += np.bincount((mixed ^ (mixed >> np.uint32(15))) * _MIX >> np.uint32(32 - bits), minlength=1 << bits)
        last, first = data[-(max(GRAMS) - 1) :], False
    return counts


@dataclass
class Model:
    """``weights``: one row of log ratios per bit; ``curves``: slope and offset per bit; ``trust``: how much a bit's loss weighs."""

    languages: list[str]
    book: np.ndarray
    weights: np.ndarray
    curves: np.ndarray
    trust: np.ndarray

    def margins(self, text: bytes) -> np.ndarray:
        counts = gram_counts(text, int(self.weights.shape[1]).bit_length() - 1)
        return self.weights @ counts / math.sqrt(max(counts.sum(), 1))

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Weighted loss of every codeword, by row of margins."""
        odds = np.clip(margins * self.curves[:, 0] + self.curves[:, 1], -50, 50)
        return (np.log1p(np.exp(-odds[..., None, :] * self.book)) * self.trust).sum(axis=-1)

    def decode(self, text: str) -> tuple[str, float, bool]:
        """(language, score, ambiguous)"""
        if not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, False
        loss = self.losses(self.margins(text.encode()))
        share = np.exp(loss.min() - loss)
        best = int(loss.argmin())
        score = float(1 / share.sum())
        return self.languages[best], score, score < CLEAR


def bit_weights(counts: np.ndarray, book: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log ratios per bit from the counts of every language (rows)."""
    shares = counts + smoothing
    shares = shares / shares.sum(axis=1, keepdims=True)
    return np.array([np.log(shares[bit > 0].mean(axis=0) / shares[bit < 0].mean(axis=0)) for bit in book.T]).reshape(-1, counts.shape[1])


def fit_curves(margins: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(curves, trust) from margins of rows whose codewords are known; a bit without both values keeps its margins as log odds."""
    curves, trust = [], []
    for margin, code in zip(margins.T, codes.T, strict=True):
        positive = code > 0
        curve = fit_curve(margin, positive) if 0 < positive.sum() < len(positive) else (1.0, 0.0)
        errors = ((margin * curve[0] + curve[1] > 0) != positive).sum()
        curves.append(curve)
        trust.append(math.log((len(positive) - errors + 1) / (errors + 1)))
    trust = np.maximum(np.array(trust), 0.0)
    return np.array(curves).reshape(-1, 2), trust / trust.mean() if trust.any() else np.ones(len(trust))


# --- on Spark ----------------------------------------------------------------------------------------------------------


def is_held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: the checksum of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _count(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = gram_counts(text.as_buffer().to_pybytes(), bits)
                if language in held:
                    held[language] += found
                else:
                    held[language] = found
        for language, counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.record_batch([pa.array([language] * len(at)), pa.array(at, pa.int32()), pa.array(counts[at])], ["lang", "gram", "n"])

    return run


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", bits: int = HASH_BITS) -> Model:
    """The model, from rows that are not held out."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~is_held_out(F.col(id_col))).select(
        F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("lang"), F.coalesce(text_col, F.lit("")).cast("binary").alias("text"),
        F.xxhash64(F.col(id_col).cast("string")).alias("_hash"),
    )
    for_curves = F.pmod("_hash", F.lit(CURVE_SHARE)) == 0
    found = rows.groupBy("lang").agg(F.count_if(for_curves).alias("n")).orderBy("lang").collect()
    languages = [r["lang"] for r in found]
    book, size = codebook(len(languages)), 1 << bits
    if not book.shape[1]:
        return Model(languages, book, np.zeros((0, size)), np.zeros((0, 2)), np.zeros(0))
    counted = rows.where(~for_curves).select("lang", "text").mapInArrow(_count(bits), "lang string, gram int, n long")
    summed = materialize(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-grams")
    counts = np.zeros((len(languages), size))
    number = {language: k for k, language in enumerate(languages)}
    grams = summed.groupBy("lang").agg(F.collect_list("gram").alias("gram"), F.collect_list("n").alias("n"))  # hashes at most
    for r in grams.toLocalIterator():
        counts[number[r["lang"]], r["gram"]] = r["n"]
    discard(summed)
    model = Model(languages, book, bit_weights(counts, book), np.ones((book.shape[1], 2)) * [1.0, 0.0], np.ones(book.shape[1]))

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [model.margins(t.as_buffer().to_pybytes()).tolist() for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(got, pa.list_(pa.float64()))], ["lang", "margins"])

    # a share of the hashes that holds somewhat fewer rows than wanted, so that no task orders more
    share = min(1.0, 0.9 * CURVE_ROWS / max(1, sum(r["n"] for r in found)))
    key = ["_hash", "_id", "lang", "_text"]
    chosen = rows.where(for_curves & (F.pmod(F.xxhash64("_hash"), F.lit(1 << 20)) < int(share * (1 << 20)))).withColumn("_text", F.xxhash64("text"))
    chosen = chosen.dropDuplicates(key).orderBy(*key).limit(CURVE_ROWS)
    rows = chosen.select("lang", "text").mapInArrow(margins, "lang string, margins array<double>").collect()
    if rows:
        order = sorted(rows)
        model.curves, model.trust = fit_curves(np.array([r["margins"] for r in order]), book[[number[r["lang"]] for r in order]])
    return model


def predict(text: Column, model: Model) -> Column:
    """A struct of language, score and whether the text is ambiguous."""

    @F.arrow_udf("lang_pred string, score double, ambiguous boolean")
    def decoded(texts: pa.Array) -> pa.Array:
        found = [model.decode(t or "") for t in texts.to_pylist()]
        columns = zip(*found, strict=True) if found else ((), (), ())
        types = (pa.string(), pa.float64(), pa.bool_())
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["lang_pred", "score", "ambiguous"])

    return decoded(text)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) of every row."""
    model = train(docs, id_col, text_col, lang_col)
    found = docs.select(
        F.col(id_col).alias("doc_id"), is_held_out(F.col(id_col)).alias("held_out"), predict(F.col(text_col), model).alias("found")
    )
    return found.select("doc_id", "held_out", "found.*")
