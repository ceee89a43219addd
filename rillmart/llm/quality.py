"""Quality classifier: Naive Bayes support vectors over n-gram indicators.

A text's indicators are hashed n-grams of three readings of it: its characters, its shape (runs of
upper and lower case letters, digits, white space and signs) and its repeats (which words equal the
word before).  Each indicator is scaled by its log-count ratio between the classes, texts are
scaled by the root of their number of indicators, and a linear model with hinge loss is fitted by
dual coordinate descent.  Fitting takes at most ``SAMPLE`` texts of each class to the driver, as
indicators; scoring runs over all texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import add_columns, texts_of, unaligned_u64
from .sampling import first_ids, fold, labelled_ids, texts_by_id

SAMPLE = 1500             # texts of each class that the model is fitted on
BITS, EPOCHS, COST = 17, 12, 1.0
CHARACTERS, SHAPES, REPEATS = 4, 6, 3     # lengths of the n-grams
FOLDS, HELD_OUT = 3, 1
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
STRETCH = 1 << 20

_SHAPE = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57
               else 32 if b in (9, 10, 11, 12, 13, 32) else b for b in range(256))


def _grams(data: bytes, n: int, salt: int) -> np.ndarray:
    padded = np.frombuffer(data + bytes(8), np.uint8)
    loads = unaligned_u64(padded)[:max(len(data) - n + 1, 0)]
    with np.errstate(over="ignore"):
        mixed = (loads & np.uint64((1 << 8 * n) - 1)) + np.uint64(salt << 56)
        return ((mixed * MULTIPLIER) >> np.uint64(64 - BITS)).astype(np.int32)


def indicators(text: bytes) -> np.ndarray:
    """Which of the 2 ** ``BITS`` hashed n-grams occur, as a mask."""
    mask = np.zeros(1 << BITS, bool)
    shape = text.translate(_SHAPE)
    for k in range(0, len(text), STRETCH):       # stretches overlap by one n-gram
        mask[_grams(text[k:k + STRETCH + CHARACTERS - 1], CHARACTERS, 1)] = True
        mask[_grams(shape[k:k + STRETCH + SHAPES - 1], SHAPES, 2)] = True
    words = text.split()
    repeats = bytes([97 + (a == b) for a, b in zip(words, words[1:])])
    mask[_grams(repeats, REPEATS, 3)] = True
    return mask


def fit(rows: list[tuple[int, np.ndarray]], bits: int = BITS, epochs: int = EPOCHS,
        cost: float = COST) -> tuple[np.ndarray, float]:
    """(weights, bias) from (label, places of indicators).

    Without both classes the weights are zero and the bias says which class was seen.
    """
    sign = np.array([1 if y else -1 for y, _ in rows])
    if not len(rows) or abs(sign.sum()) == len(rows):
        return np.zeros(1 << bits), float(np.sign(sign.sum())) if len(rows) else 0.0
    counts = {s: np.ones(1 << bits) for s in (1, -1)}
    for s, (_, places) in zip(sign.tolist(), rows):
        counts[s][places] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[-1] / counts[-1].sum())
    values = [ratio[p] / max(len(p), 1) ** 0.5 for _, p in rows]
    norms = np.array([v @ v + 1 for v in values])
    weights, bias, alpha = np.zeros(1 << bits), 0.0, np.zeros(len(rows))
    # The rarer class counts as much as the other.
    bound = np.where(sign > 0, cost * len(rows) / (2 * (sign > 0).sum()), cost * len(rows) / (2 * (sign < 0).sum()))
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            places, x, y = rows[i][1], values[i], sign[i]
            gradient = y * (weights[places] @ x + bias) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), bound[i])
            step = (new - alpha[i]) * y
            if step:
                alpha[i] = new
                weights[places] += step * x
                bias += step
    return weights * ratio, bias


def _places(columns):
    for (column,) in columns:
        yield [pa.array([np.flatnonzero(indicators(t)).astype("<i4").tobytes() for t in texts_of(column)],
                        pa.binary())]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Fit on labelled rows outside the held-out fold, at most ``sample`` of each class."""
    ids = labelled_ids(labels, id_col, label_col, fold(F.col("id"), FOLDS) != HELD_OUT)
    rows = []
    for label in (0, 1):
        chosen = first_ids(ids.where(F.col("label") == label).select("id"), sample)
        texts = texts_by_id(docs, chosen, id_col, text_col)
        rows += [(label, r["id"], np.frombuffer(r["places"], "<i4")) for r in
                 add_columns(texts, {"places": T.BinaryType()}, _places, "text").select("id", "places").collect()]
    rows.sort(key=lambda r: (r[0], r[1]))
    return fit([(y, p) for y, _, p in rows])


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` in 0 to 1 and ``predicted``, 1 from a score of 0.5 on.

    Null counts as empty; a text without n-grams has the bias's score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(columns):
        weights, bias = shared.value
        for (column,) in columns:
            margins = []
            for text in texts_of(column):
                mask = indicators(text)
                margins.append(weights[mask].sum() / max(mask.sum(), 1) ** 0.5 + bias)
            scores = 1 / (1 + np.exp(-np.clip(2 * np.array(margins), -700, 700)))
            yield [pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32), pa.int32())]

    return add_columns(docs, {"score": T.DoubleType(), "predicted": T.IntegerType()}, compute, text_col)
