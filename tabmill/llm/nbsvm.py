"""Text quality by naive Bayes support vectors.

Features are indicators of n-grams, hashed: of bytes, of the shape of the text (letters, capitals, digits, marks, spaces), and of words
that repeat the word before. Each indicator is scaled by the log ratio of its smoothed counts in the two classes, rows are
brought to unit scale by the number of their indicators, and a linear model with hinge loss is fitted by dual coordinate descent.
A logistic curve fitted to margins of training rows left out of the descent turns margins into scores. Nothing but the text is an input of a score.

The model is fitted on at most ``FIT_ROWS`` labelled rows, those with the smallest hashes of their ids, in one task whose input
is bounded by that number; every text of the table is scored, as a whole.

Defined results: a null text is an empty one and is scored like any other; labels that are null or contradict each other for one id
are left out, repeated ones count once; without labels, or with labels of one class, every score is the smoothed share of label 1; repeated rows
and null ids are scored; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows the model is fitted on at most.
FIT_ROWS = 8_192
HASH_BITS = 18
SMOOTHING = 1.0
#: Weight of an error in the hinge loss, passes over the rows.
PENALTY, PASSES = 1.0, 30
SEED = 11
_AT_ONCE = 1 << 22

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def _shape_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("a") : ord("z") + 1] = ord("a")
    table[ord("A") : ord("Z") + 1] = ord("A")
    table[ord("0") : ord("9") + 1] = ord("0")
    table[128:] = ord("a")
    return table


_SHAPE = _shape_table()
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - HASH_BITS)


def _grams(symbols: np.ndarray, n: int, kind: int) -> np.ndarray:
    if len(symbols) < n:
        return np.empty(0, np.int64)
    packed = np.zeros(len(symbols) - n + 1, np.uint64)
    for k in range(n):
        packed = (packed << np.uint64(8)) | symbols[k : len(symbols) - n + 1 + k]
    return ((packed * _MIX + np.uint64(kind * 0xD1B54A32D192ED03 % (1 << 64))) * _MIX >> _SHIFT).astype(np.int64)


def _repeats(data: np.ndarray) -> np.ndarray:
    """For each word, whether it is the word before."""
    space = _SPACE[data]
    inside = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    starts, ends = inside[::2], inside[1::2]
    sums = np.append(np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(len(data))))
    words = (sums[ends] - sums[starts]) * _powers(len(data), inverse=True)[starts] if len(starts) else np.empty(0, np.uint64)
    return (words[1:] == words[:-1]).astype(np.uint8)


_POWER = {False: np.uint64(0x9E3779B97F4A7C15), True: np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))}
_KEPT_POWERS: dict[bool, np.ndarray] = {}


def _powers(n: int, inverse: bool = False) -> np.ndarray:
    kept = _KEPT_POWERS.get(inverse)
    if kept is None or len(kept) < n:
        steps = np.full(max(n, 1 << 17), _POWER[inverse])
        steps[0] = 1
        kept = _KEPT_POWERS[inverse] = np.cumprod(steps)
    return kept[:n]


def indicators(text: bytes, present: np.ndarray) -> np.ndarray:
    """Hashes of all n-grams of the text, each once, ascending. ``present``: a cleared array of flags, cleared again."""
    data = np.frombuffer(text, np.uint8)
    for at in range(0, max(len(data), 1), _AT_ONCE):  # n-grams that end in the next cut are seen there
        some = data[max(0, at - 8) : at + _AT_ONCE]
        present[_grams(some, 3, 1)] = True
        shape = _SHAPE[some]
        letter = (shape == ord("a")) | (shape == ord("A"))
        kept = np.ones(len(shape), bool)
        kept[1:] = ~(letter[1:] & (shape[1:] == shape[:-1]))
        shape = shape[kept]
        for n in (4, 6):
            present[_grams(shape, n, n)] = True
        present[_grams(_repeats(some), 3, 9)] = True
    found = np.flatnonzero(present)
    present[found] = False
    return found.astype(np.int32)


# --- the model ---------------------------------------------------------------------------------------------------------


def log_count_ratios(rows: list[np.ndarray], positive: np.ndarray, size: int, smoothing: float = SMOOTHING) -> np.ndarray:
    """By feature, the log of its share among the positive rows' indicators over that among the others'."""
    ratio = np.zeros(size)
    for sign, chosen in ((1, positive), (-1, ~positive)):
        counts = smoothing + np.bincount(np.concatenate([rows[i] for i in np.flatnonzero(chosen)]), minlength=size)
        ratio += sign * np.log(counts / counts.sum())
    return ratio


def descend(rows: list[np.ndarray], scaled: list[np.ndarray], positive: np.ndarray, size: int, penalties: np.ndarray,
            passes: int = PASSES, seed: int = SEED) -> np.ndarray:
    """Weights that minimise half their squared norm plus the penalised hinge losses, by coordinate descent on the dual.

    The dual variable of one row after another moves to its best value between 0 and the row's penalty, all others fixed.
    """
    weights, dual = np.zeros(size), np.zeros(len(rows))
    sign = np.where(positive, 1.0, -1.0)
    square = np.array([max(x @ x, 1e-12) for x in scaled])
    rng = np.random.default_rng(seed)
    for _ in range(passes):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            at, x = rows[i], scaled[i]
            gradient = sign[i] * (weights[at] @ x) - 1
            new = min(max(dual[i] - gradient / square[i], 0.0), penalties[i])
            if new != dual[i]:
                weights[at] += (new - dual[i]) * sign[i] * x
                moved = max(moved, abs(new - dual[i]) * square[i])
                dual[i] = new
        if moved < 1e-3:
            break
    return weights


def fit_curve(margins: np.ndarray, positive: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps on the likelihood with smoothed targets."""
    n1, n0 = positive.sum(), (~positive).sum()
    target = np.where(positive, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([margins, np.ones(len(margins))])
    beta = np.array([0.0, np.log((n1 + 1) / (n0 + 1))])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-9 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p))
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(texts: list[bytes], positive: np.ndarray, bits: int = HASH_BITS) -> tuple[np.ndarray, float, float]:
    """(weight of each indicator, slope, offset). A fifth of the rows is left out of the descent and sets the curve."""
    size = 1 << bits
    n1, n = int(positive.sum()), len(positive)
    if n1 in (0, n):
        return np.zeros(size, np.float32), 0.0, float(np.log((n1 + 1) / (n - n1 + 1)))
    present = np.zeros(size, bool)
    rows = [indicators(t, present) for t in texts]

    def model(chosen: np.ndarray) -> np.ndarray:
        own, labels = [rows[i] for i in chosen], positive[chosen]
        ratio = log_count_ratios(own, labels, size)
        scaled = [ratio[r] / np.sqrt(max(len(r), 1)) for r in own]
        share = labels.mean()
        penalties = PENALTY * np.where(labels, 0.5 / share, 0.5 / (1 - share))  # classes weigh alike
        return descend(own, scaled, labels, size, penalties) * ratio

    order = np.random.default_rng(SEED).permutation(n)
    held, rest = order[: n // 5], order[n // 5 :]
    if len(held) and 0 < positive[rest].sum() < len(rest):
        weights = model(rest)
        slope, offset = fit_curve(np.array([margin(rows[i], weights) for i in held]), positive[held])
    else:
        weights, held = model(order), order
        slope, offset = fit_curve(np.array([margin(rows[i], weights) for i in held]), positive[held])
    return weights.astype(np.float32), slope, offset


def margin(row: np.ndarray, weights: np.ndarray) -> float:
    return float(weights[row].sum(dtype=np.float64) / np.sqrt(max(len(row), 1)))


# --- on Spark ----------------------------------------------------------------------------------------------------------


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels no model sees: the checksum of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "quality", n_rows: int = FIT_ROWS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, positive) of at most ``n_rows`` labelled documents that are not held out, one for each id."""
    known = (
        labels.where(~is_held_out(F.col(id_col))).where(F.col(label).isin(0, 1))
        .groupBy(F.col(id_col).alias("_id")).agg(F.min(label).alias("least"), F.max(label).alias("most")).where("least = most")
        .orderBy(F.xxhash64("_id"), "_id").limit(n_rows)
    )
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    found = rows.join(F.broadcast(known), "_id")  # n_rows ids
    return found.groupBy("_id", "most").agg(F.max("text").alias("text")).select(
        "_id", F.col("text").cast("binary").alias("text"), (F.col("most") == 1).alias("positive")
    )


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    table = pa.Table.from_batches(rows).sort_by("_id")
    weights, slope, offset = fit(table["text"].to_pylist(), table["positive"].to_numpy())
    yield pa.record_batch([pa.array([weights.tobytes()], pa.binary()), pa.array([slope]), pa.array([offset])], ["weights", "slope", "offset"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", n_rows: int = FIT_ROWS,
          id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, float, float]:
    """The model, fitted in one task on at most ``n_rows`` texts; it has the same size for any table."""
    rows = training_rows(docs, labels, label, n_rows, id_col, text_col)
    found = rows.repartition(1).mapInArrow(_fit_task, "weights binary, slope double, offset double").first()
    if found is None:
        return np.zeros(1 << HASH_BITS, np.float32), 0.0, 0.0
    return np.frombuffer(found["weights"], np.float32), found["slope"], found["offset"]


def score(text: Column, model: tuple[np.ndarray, float, float]) -> Column:
    """The chance that a whole text has label 1."""
    weights, slope, offset = model

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        present = np.zeros(len(weights), bool)
        margins = np.array([margin(indicators(t, present), weights) for t in pc.fill_null(texts, b"").to_pylist()])
        return pa.array(1 / (1 + np.exp(-np.clip(slope * margins + offset, -500, 500))))

    return scored(F.coalesce(text, F.lit("")).cast("binary"))
