"""Classifiers: accuracy on rows they were not fitted on, and odd inputs."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillmart.llm import quality, sampling, toxicity
from rillmart.llm.queries import QUERIES
from tests.llm.helpers import EMPTY, ODD, docs

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("name, label, positive, negative", [
    ("op5_quality", "quality", 0.95, 0.95), ("op8_toxicity", "toxic", 0.8, 0.97)])
def test_held_out_accuracy(spark, name, label, positive, negative):
    rows = QUERIES[name](spark, SF).where("held_out").join(
        spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").select(label, "predicted", "score").collect()
    for value, least in ((1, positive), (0, negative)):
        of = [r.predicted == value for r in rows if r[label] == value]
        assert of and sum(of) / len(of) >= least, (value, sum(of), len(of))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_folds(spark):
    got = spark.range(50).select("id", sampling.fold(F.col("id"), 3).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 3 for r in got)


def test_labels_that_disagree_or_repeat(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (2, 1), (3, None), (None, 1), (4, 0), (5, 7)],
                                   "doc_id long, toxic int")
    got = sampling.labelled_ids(labels, "doc_id", "toxic", F.lit(True)).where("id IS NOT NULL")
    assert {tuple(r) for r in got.collect()} == {(2, 1), (4, 0)}


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_tables(spark, module, label):
    table = docs(spark, ODD)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 12)], f"doc_id long, {label} int")
    for known in (labels, labels.limit(0), labels.where(f"{label} = 1")):
        out = module.score(table, module.train(table, known))
        assert out.columns == [*table.columns, "score", "predicted"]
        assert all(0 <= r.score <= 1 for r in out.collect()) and out.count() == len(ODD)
    assert module.score(docs(spark, EMPTY), module.train(docs(spark, EMPTY), labels)).count() == 0


def test_coordinate_descent_separates():
    rng = np.random.default_rng(1)
    rows = [(y, np.unique(np.append(rng.integers(100, 2000, 20), 5 if y else 7))) for y in (0, 1) * 50]
    weights, bias = quality.fit(rows)
    assert all((weights[p].sum() / len(p) ** 0.5 + bias > 0) == y for y, p in rows)


def test_positive_unlabelled_learning():
    rng = np.random.default_rng(2)
    clean = lambda: b" ".join(b"w%d" % k for k in rng.integers(0, 300, 20))
    toxic = [clean() + b" bad" for _ in range(100)]
    unlabelled = [clean() for _ in range(450)] + [clean() + b" bad" for _ in range(50)]
    model = toxicity.fit([toxicity.features(t) for t in toxic], [toxicity.features(t) for t in unlabelled], 0.1)
    assert toxicity.margin_of(b"w1 bad w2", model) > 0 > toxicity.margin_of(b"w1 w2", model)


def test_hinge_loss_against_projected_gradient():
    """The dual solved as a whole on dense rows gives the same weights as coordinate descent."""
    rng = np.random.default_rng(3)
    rows = [(y, np.unique(rng.integers(0 if y else 12, 52 if y else 64, 9))) for y in (0, 1, 0, 1, 1) * 9]
    weights, bias = quality.fit(rows, bits=6, epochs=4000)
    y = np.array([1 if label else -1 for label, _ in rows])
    seen = np.zeros((len(rows), 64))
    for k, (_, places) in enumerate(rows):
        seen[k, places] = 1
    share = {s: (1 + seen[y == s].sum(0)) / (1 + seen[y == s].sum(0)).sum() for s in (1, -1)}
    ratio = np.log(share[1] / share[-1])
    x = np.hstack([seen * ratio / np.sqrt(seen.sum(1, keepdims=True)), np.ones((len(rows), 1))])
    bound = np.where(y > 0, 1 / (y > 0).sum(), 1 / (y < 0).sum()) * quality.COST * len(rows) / 2
    q, alpha = (x @ x.T) * np.outer(y, y), np.zeros(len(rows))
    step = 1 / np.linalg.eigvalsh(q)[-1]
    for _ in range(200_000):
        alpha = np.clip(alpha - step * (q @ alpha - 1), 0, bound)
    plain = (alpha * y) @ x
    assert np.allclose(np.append(weights, bias), np.append(plain[:-1] * ratio, plain[-1]), atol=1e-2)


@pytest.mark.parametrize("prior", [0.1, 0.8])
def test_risk_against_numeric_gradients(prior):
    """The same steps along differences of the risk itself, on dense rows; a prior that is too
    high makes the second part negative, so that the step turns round."""
    rng = np.random.default_rng(4)
    clean = lambda: b" ".join(b"w%d" % k for k in rng.integers(0, 300, 20))
    toxic = [toxicity.features(clean() + b" bad") for _ in range(100)]
    unlabelled = [toxicity.features(clean() + b" bad" * (k % 10 == 0)) for k in range(400)]
    chosen, weights, bias = toxicity.fit(toxic, unlabelled, prior, steps=40)
    sets = [np.array([np.isin(chosen, t) for t in texts], float) for texts in (toxic, unlabelled)]
    turned = 0

    def parts(at):
        a, b = (x @ at[:-1] + at[-1] for x in sets)
        return prior * np.logaddexp(0, -a).mean(), np.logaddexp(0, b).mean() - prior * np.logaddexp(0, a).mean()

    at, first, second = np.append(np.zeros(len(chosen)), np.log(prior / (1 - prior))), 0, 0
    for step in range(1, 41):
        negative = parts(at)[1] < 0
        turned += negative
        risk = (lambda z: -parts(z)[1]) if negative else (lambda z: sum(parts(z)))
        g = np.array([(risk(at + d) - risk(at - d)) / 2e-5 for d in np.eye(len(at)) * 1e-5])
        g[:-1] += toxicity.DECAY * at[:-1]
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        at = at - toxicity.RATE * first / (1 - 0.9 ** step) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    assert len(chosen) and np.allclose(at, np.append(weights, bias), atol=1e-3)
    assert bool(turned) == (prior > 0.5)
