"""Hard negatives against comparing every anchor with every row."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from rillmart.llm import covertree

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("rank", T.StringType()),
                       T.StructField("a.b", T.IntegerType())])


def whole(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def brute(rows, every=10, positives=5, negatives=10, low=30, high=90):
    held = sorted({(i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, label in rows
                   if i is not None and label is not None and whole(v)})
    out = []
    for i, label, q in held:
        if i % every:
            continue
        others = [(-sum(a * b for a, b in zip(q, v)), j, other) for j, other, v in held if j != i]
        near = sorted(o for o in others if o[2] == label)[:positives]
        for score, j, _ in near:
            hits = sorted(o for o in others if o[2] != label and low * -score <= 100 * -o[0] <= high * -score)
            out += [(i, j, k + 1, o[1], -score, -o[0]) for k, o in enumerate(hits[:negatives])]
    return sorted(out)


def mined(spark, rows, every=10):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    out = covertree.hard_negatives(table, F.col("vec_id") % every == 0)
    return sorted(tuple(r) for r in out.collect())


def vectors(n, width, seed=3):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    out = []
    for i in range(n):
        label = rnd.randrange(5)
        out.append((i, [c * .3 + rnd.gauss(0, .2) for c in centres[label]], label))
    return out


@pytest.mark.parametrize("sizes", [(60, 30, 2, 8), (8192, 1024, 16, 64)])
def test_all_rows_are_compared(spark, monkeypatch, sizes):
    for name, size in zip(("SHARD_ROWS", "BLOCK_ROWS", "FANOUT", "LEAF_ROWS"), sizes):
        monkeypatch.setattr(covertree, name, size)
    rows = vectors(400, 6)
    # A third of all rows is one vector, of two labels, with ties in every window.
    rows += [(1000 + k, rows[7][1], k % 2) for k in range(200)]
    assert mined(spark, rows) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(40, 3) + [
        (None, [1.0, 1.0, 1.0], 1), (50, None, 1), (60, [1.0, None, 1.0], 1), (70, [nan, 1.0, 1.0], 1),
        (80, [inf, 1.0, 1.0], 1), (90, [1.0, 1.0, 1.0], None), (100, [], 1), (110, [0.0, 0.0, 0.0], 2),
        (120, [-1.0, -1.0], 1), (120, [-1.0, -1.0], 1), (120, [2.0, 1.0, 0.5], 1), (130, [1e6, 1e6, -1e6], 3),
        (131, [1e6, 1e6, 1e5], 3), (132, [1e6, 1e5, -1e6], 2), (133, [9e5, 1e6, -1e6], 2)]
    assert mined(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0], 1)]) == []


def test_nodes_are_skipped_and_cover_their_points():
    rnd = np.random.default_rng(1)
    centres = rnd.normal(0, 5000, (40, 8))
    points = np.floor(np.repeat(centres, 50, 0) + rnd.normal(0, 20, (2000, 8)))
    tree = covertree.CoverTree(points, np.arange(2000), np.zeros(2000, np.int64))
    size = np.sqrt((tree.points ** 2).sum(1)).max()
    even = np.column_stack([tree.points, np.sqrt(np.maximum(size ** 2 - (tree.points ** 2).sum(1), 0))])
    for k in range(len(tree.start)):
        c = tree.centres[k]
        middle = np.append(c, math.sqrt(max(size ** 2 - (c * c).sum(), 0)))
        far = np.sqrt(((even[tree.start[k]:tree.stop[k]] - middle) ** 2).sum(1)).max()
        assert far <= tree.radius[k] * (1 + 1e-6) + 1e-3
    seen = []
    tree.scores = lambda at, q, exact: seen.append(len(at)) or covertree.CoverTree.scores(tree, at, q, exact)
    query = points[:1]
    least, greatest = tree.bounds(query)
    best = covertree.descend(tree, query[0], least[0], greatest[0], -1, 0, True, [(-np.inf, np.inf)], 5, True)
    assert [s for s, _ in best[0]] == sorted((points @ query[0]).astype(int), reverse=True)[:5]
    assert sum(seen) < 1200


def together(tree, points, who, same, windows, k):
    """Results of a block of queries by (query, window), sizes of its products."""
    sizes = []
    tree.products = lambda at, q: sizes.append((len(at), len(q))) or covertree.CoverTree.products(tree, at, q)
    edges = np.array(windows, float)
    found = covertree.descend_together(tree, points[who], who, who % 3, same, edges[:, :, 0], edges[:, :, 1], k)
    best = {(q, w): [] for q in range(len(who)) for w in range(edges.shape[1])}
    for q, w, s, i in sorted(zip(*(c.tolist() for c in found)), key=lambda f: (-f[2], f[3])):
        best[q, w].append((s, i))
    return best, sizes


@pytest.mark.parametrize("same", [True, False])
@pytest.mark.parametrize("held", [1, 1 << 18])
@pytest.mark.parametrize("spreads", [(5000, 20), (0, 300)])
def test_anchors_descend_together(monkeypatch, same, held, spreads):
    """They find what each finds alone; in clusters they skip nodes, elsewhere they share products."""
    monkeypatch.setattr(covertree, "PRODUCTS", held)
    rnd = np.random.default_rng(4)
    points = np.floor(np.repeat(rnd.normal(0, spreads[0], (40, 8)), 50, 0) + rnd.normal(0, spreads[1], (2000, 8)))
    points[::9] = points[9]          # more equal points than a leaf holds otherwise
    ids = np.arange(2000)
    tree, who = covertree.CoverTree(points, ids, ids % 3), ids[::20]
    scores = points[who] @ points.T
    top = np.sort(scores, 1)[:, -3:].tolist()
    windows = [[(-np.inf, np.inf)] * 3 if same else [covertree.share(int(s), 30, 90) for s in row] for row in top]
    best, sizes = together(tree, points, who, same, windows, 7)
    for q, me in enumerate(who.tolist()):
        fit = [(int(s), i) for i, s in enumerate(scores[q].tolist()) if i != me and (i % 3 == me % 3) == same]
        for w, (low, high) in enumerate(windows[q]):
            assert best[q, w] == sorted((f for f in fit if low <= f[0] <= high), key=lambda f: (-f[0], f[1]))[:7]
    work = sum(a * b for a, b in sizes)
    if spreads[0]:
        assert work < 0.6 * scores.size
    else:
        # Alone, each anchor multiplied points out in some ten steps of its own.
        assert held == 1 or len(sizes) < 4 * len(who)
        assert work < 3 * scores.size
