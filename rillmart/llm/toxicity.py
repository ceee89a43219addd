"""Toxicity by non-negative positive-unlabelled learning.

The training set is confirmed toxic texts and a sample of all texts, whatever they are; other labels
are not used as negatives.  The risk of a linear model under logistic loss is estimated from both:
with class prior ``p``, R = p R+(toxic) + max(0, R-(all) - p R-(toxic)), where R+ and R- are the mean losses of calling a
set's texts toxic or clean.  When the second part falls below zero the step goes against it, so the
model cannot gain by fitting toxic texts out of the unlabelled ones.  A model weighs words
and word beginnings, known by their hashes; its vocabulary is those whose share of toxic texts differs from that of all texts by at least
``DEVIATIONS`` standard deviations.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import add_columns, texts_of
from .decontam import words_of
from .sampling import first_ids, fold, labelled_ids, texts_by_id

TOXIC_SAMPLE, ALL_SAMPLE = 1500, 4000      # texts that the model is fitted on
VOCABULARY, MIN_TEXTS, DEVIATIONS = 20_000, 5, 5.0
PREFIXES = (4, 5, 6, 7)
RARE = 0.01                # share of texts up to which a word tells texts apart
STEPS, RATE, DECAY = 400, 0.1, 1e-4
FOLDS, HELD_OUT = 5, 0
# Hashes in ascending order, their weights, the bias.
Model = tuple[np.ndarray, np.ndarray, float]


def features(text: bytes) -> np.ndarray:
    """Hashes of a text's words and, marked, of the first ``PREFIXES`` bytes of longer ones."""
    from xxhash import xxh3_64_intdigest

    words = set(words_of(text))
    found = words.union(*[{b"^" + w[:n] for w in words if len(w) > n} for n in PREFIXES])
    return np.unique(np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found)))


def _counts(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(features, number of texts of each)."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *texts]), return_counts=True)


def _at(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each is known, places of the known ones)."""
    if not len(known):
        return np.zeros(len(wanted), bool), np.zeros(0, np.int64)
    places = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    there = known[places] == wanted
    return there, places[there]


def _apart(texts: list[np.ndarray], known: np.ndarray, seen: np.ndarray, total: int) -> list[np.ndarray]:
    """``texts`` without later near copies, which would make their own words look telling: those
    that share two of their first three rare features, by hash, with an earlier text."""
    kept, met = [], set()
    for text in texts:
        rare = text[seen[_at(known, text)[1]] <= max(RARE * total, 2)][:3].tolist()
        keys = set(itertools.combinations(rare, 2)) or {tuple(text.tolist())}
        if not keys & met:
            kept.append(text)
        met |= keys
    return kept


def _telling(toxic: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Features whose document shares differ clearly between the sets."""
    (words, counts), (all_words, all_counts) = _counts(toxic), _counts(unlabelled)
    either = np.union1d(words[counts >= MIN_TEXTS], all_words[all_counts >= MIN_TEXTS])
    a, b = np.zeros(len(either)), np.zeros(len(either))
    for into, (w, c) in ((a, (words, counts)), (b, (all_words, all_counts))):
        there, places = _at(w, either)
        into[there] = c[places]
    n, m = len(toxic), len(unlabelled)
    share = (a + b) / (n + m)
    spread = np.sqrt(share * (1 - share) * (1 / n + 1 / m))
    z = np.abs(a / n - b / m) / np.maximum(spread, 1e-12)
    best = np.argsort(-z, kind="stable")[:VOCABULARY]
    return np.sort(either[best[(z[best] >= DEVIATIONS) & (spread[best] > 0)]])


def fit(toxic: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = STEPS) -> Model:
    """Feature weights and bias from the features of each text.

    Without toxic texts nothing is toxic; without any text the score is one half everywhere.
    """
    if not toxic or not unlabelled:
        return np.zeros(0, np.uint64), np.zeros(0), -5.0 if unlabelled else 5.0 if toxic else 0.0
    known, seen = _counts([*toxic, *unlabelled])
    total = len(toxic) + len(unlabelled)
    toxic, unlabelled = (_apart(t, known, seen, total) for t in (toxic, unlabelled))
    chosen = _telling(toxic, unlabelled)
    sets = []
    for texts in (toxic, unlabelled):
        places = [_at(chosen, t)[1] for t in texts]
        sets.append((np.repeat(np.arange(len(places)), [len(p) for p in places]), np.concatenate(places), len(texts)))
    weights, bias = np.zeros(len(chosen)), float(np.log(prior / (1 - prior)))
    moments = [np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)]

    def margin(rows):
        row, column, n = rows
        return np.bincount(row, weights[column], minlength=n) + bias

    def gradient(rows, slope):
        row, column, n = rows
        g = np.bincount(column, slope[row] / n, minlength=len(chosen))
        return np.append(g, slope.sum() / n)

    for step in range(1, steps + 1):
        p, u = (1 / (1 + np.exp(-np.clip(margin(s), -50, 50))) for s in sets)
        eps = 1e-12
        rest = -np.log(1 - u + eps).mean() + prior * np.log(1 - p + eps).mean()
        negative = gradient(sets[1], u) - prior * gradient(sets[0], p)
        g = prior * gradient(sets[0], p - 1) + negative if rest >= 0 else -negative
        g[:-1] += DECAY * weights
        moments[0] = 0.9 * moments[0] + 0.1 * g
        moments[1] = 0.999 * moments[1] + 0.001 * g * g
        move = RATE * (moments[0] / (1 - 0.9 ** step)) / (np.sqrt(moments[1] / (1 - 0.999 ** step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - float(move[-1])
    return chosen, weights, bias


def margin_of(text: bytes, model: Model) -> float:
    known, weights, bias = model
    return bias + float(weights[_at(known, features(text))[1]].sum())


def _features(columns):
    for (column,) in columns:
        yield [pa.array([features(t).tobytes() for t in texts_of(column)], pa.binary())]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", toxic_sample: int = TOXIC_SAMPLE, all_sample: int = ALL_SAMPLE) -> Model:
    """Fit on at most ``toxic_sample`` toxic texts outside the held-out fold and ``all_sample`` of
    all texts.  The prior is the share of toxic rows among the labels outside that fold."""
    ids = labelled_ids(labels, id_col, label_col, fold(F.col("id"), FOLDS) != HELD_OUT)
    toxic, known = ids.agg(F.sum("label"), F.count("*")).first()
    prior = min(max((toxic or 0) / max(known, 1), 1e-3), 0.9)
    samples = []
    for chosen in (first_ids(ids.where("label = 1").select("id"), toxic_sample),
                   first_ids(docs.select(F.col(f"`{id_col}`").alias("id")), all_sample)):
        texts = texts_by_id(docs, chosen, id_col, text_col)
        rows = add_columns(texts, {"features": T.BinaryType()}, _features, "text").select("id", "features")
        samples.append([np.frombuffer(r["features"], np.uint64) for r in
                        sorted(rows.toLocalIterator(), key=lambda r: r["id"])])
    return fit(*samples, prior)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` in 0 to 1 and ``predicted``, 1 from a score of 0.5 on.

    Null counts as empty; a text without known words has the bias's score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(columns):
        for (column,) in columns:
            margins = np.array([margin_of(t, shared.value) for t in texts_of(column)])
            scores = 1 / (1 + np.exp(-np.clip(margins, -700, 700)))
            yield [pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32), pa.int32())]

    return add_columns(docs, {"score": T.DoubleType(), "predicted": T.IntegerType()}, compute, text_col)


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that a model fitted on them does not call toxic, with its columns.

    Null counts as empty.  Rows with null or repeated ids are scored like others; of rows that
    repeat an id one text is learnt from.  Without toxic labels all rows stay.
    """
    out = score(docs, train(docs, labels, **options), options.get("text_col", "text"))
    return out.where(F.col(f"`{out.columns[-1]}`") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
