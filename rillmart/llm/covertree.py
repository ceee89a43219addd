"""Hard negatives by inner product, searched for in cover trees.

Rows are dealt to shards by their id; a shard has about ``SHARD_ROWS`` rows, however many there are.
Each shard builds one cover tree over its vectors, to which a component is added that gives all of
them the same length, so that a large inner product is a small distance.  A node's children are a
net of its points, taken farthest first until the node's covering radius has halved (or there are
``FANOUT`` of them), and each child covers the points nearest to it with a radius of its own.

With |q| the length of an anchor's vector and c, r a node's centre and radius, each inner product
below the node lies in c.q -+ |q|r.  An anchor descends into the node of the greatest upper bound
first; nodes whose range misses all its windows, or lies below what the windows already hold, are
skipped, and the points of the leaves it reaches are multiplied out exactly.  The anchors of a block
descend together: a leaf is one matrix product with the anchors that reach it.

The anchors go to every shard in blocks, twice: for the best positives, whose scores give the
windows, and for the best negatives of each window.  Every shard answers with its own best few, so
that what is ranked at the end is bounded by anchors x shards.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored

SHARD_ROWS = 8192             # rows of one tree, about
BLOCK_ROWS = 1024             # anchors of one block, about
FANOUT, LEAF_ROWS = 16, 64    # children of a node and points of a leaf, at most (equal points aside)
AT_ONCE = 16                  # nodes an anchor opens in one step, at first
TOGETHER = 256                # points of several leaves in one product, at most
PRODUCTS = 1 << 18            # of points and anchors that are held at once, about
EXACT = 2.0 ** 53             # products up to here are exact in doubles

ROW = "id long, label long, vector binary, anchor boolean, shard int"
QUERY = "number long, id long, label long, vector binary, positives array<struct<score:long,id:long>>"


def _pack(scale: float):
    """Rows with a quantised vector: floor(scale * x) of each component, as doubles."""
    def pack(batches):
        for batch in batches:
            lists = batch.column("vector")
            flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            ends = np.cumsum(pc.list_value_length(lists).to_numpy())
            vectors = [v.tobytes() for v in np.split(flat, ends[:-1])] if len(ends) else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(vectors, pa.binary()),
                 batch.column("anchor"), batch.column("shard")], [c.split()[0] for c in ROW.split(", ")])
    return pack


def matrix(vectors: list[bytes], width: int = 0) -> np.ndarray:
    """Packed vectors as rows; shorter ones are filled up with zeros."""
    parts = [np.frombuffer(v, np.float64) for v in vectors]
    out = np.zeros((len(parts), max([width, *map(len, parts)])))
    for row, part in zip(out, parts):
        row[:len(part)] = part
    return out


class CoverTree:
    """Points in the order of the tree, and its nodes breadth first."""

    FIELDS = ("points", "ids", "labels", "centres", "radius", "child", "children", "start", "stop", "only")

    def __init__(self, points: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        # Division keeps the squares of large components finite.
        unit = np.abs(points).max(initial=1.0)
        small = points / unit
        square = (small * small).sum(1)
        even = np.column_stack([small, np.sqrt(np.maximum(square.max(initial=0.0) - square, 0))])
        order, nodes = np.arange(len(points)), [(0, len(points), 0)]
        centre, radius, child, children = [], [], [], []
        for start, stop, c in nodes:          # grows while it is walked through
            here = order[start:stop]
            near = np.sqrt(((even[here] - even[c]) ** 2).sum(1))
            centre.append(c)
            radius.append(near.max() * unit)
            child.append(len(nodes))
            half, net, owner = near.max() / 2, [c], np.zeros(len(here), np.int64)
            if stop - start > LEAF_ROWS and half > 0:
                while len(net) < FANOUT and near.max() > half:
                    far = here[near.argmax()]
                    to_far = np.sqrt(((even[here] - even[far]) ** 2).sum(1))
                    closer = to_far < near
                    near[closer], owner[closer] = to_far[closer], len(net)
                    net.append(far)
                order[start:stop] = here[np.argsort(owner, kind="stable")]
                cuts = start + np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(net)))])
                nodes += zip(cuts[:-1].tolist(), cuts[1:].tolist(), net)
            children.append(len(nodes) - child[-1])
        self.centres, self.radius = points[centre], np.array(radius)
        self.child, self.children = np.array(child), np.array(children)
        self.start, self.stop = np.array([n[0] for n in nodes]), np.array([n[1] for n in nodes])
        self.points, self.ids, self.labels = points[order], ids[order], labels[order]
        # 1 where all points of a node have the label of its first one.
        runs = np.concatenate([[0], np.cumsum(self.labels[1:] != self.labels[:-1])])
        self.only = runs[self.stop - 1] == runs[self.start]

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f: getattr(self, f) for f in self.FIELDS})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> CoverTree:
        tree, held = cls.__new__(cls), np.load(io.BytesIO(data))
        for field in cls.FIELDS:
            setattr(tree, field, held[field])
        return tree

    def scores(self, at: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
        if exact:
            return (self.points[at] @ query).astype(np.int64)
        q = [int(x) for x in query]
        return np.array([sum(int(a) * b for a, b in zip(p, q)) for p in self.points[at]], object)

    def products(self, at: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """Inner products of some points (rows) with queries (columns)."""
        return self.points[at] @ queries.T

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, greatest) inner product of each query below each node."""
        size = np.sqrt((queries * queries).sum(1))[:, None]
        middle = queries @ self.centres.T
        reach = size * self.radius + 1e-9 * size * (np.abs(self.points).sum(1).max() + 1)
        return middle - reach, middle + reach


def spread(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """All numbers of the ranges."""
    size = stop - start
    return np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())


def descend(tree: CoverTree, query: np.ndarray, least: np.ndarray, greatest: np.ndarray, own: int, label: int,
            same: bool, windows: list[tuple[float, float]], k: int, exact: bool) -> list[list[tuple[int, int]]]:
    """The ``k`` best (score, id) of each window, greater scores and then lesser ids first.

    Only points of the same label (or only those of others) count, and none with the query's id.
    """
    lows, highs = np.array([w[0] for w in windows], object), np.array([w[1] for w in windows], object)
    floors, tops = lows.astype(float), highs.astype(float)
    best = [[] for _ in windows]
    open_nodes = np.zeros(1, np.int64)
    while True:
        up, down = greatest[open_nodes], least[open_nodes]
        wanted = ((up[:, None] >= floors) & (down[:, None] <= tops)).any(1)
        # A node of one label has nothing for a query that looks for the others, and the reverse.
        first = tree.labels[tree.start[open_nodes]]
        wanted &= ~tree.only[open_nodes] | ((first == label) == same)
        open_nodes, up = open_nodes[wanted], up[wanted]
        if not len(open_nodes):
            return best
        turn = np.argsort(-up, kind="stable")
        now, open_nodes = open_nodes[turn[:AT_ONCE]], open_nodes[turn[AT_ONCE:]]
        inner = now[tree.children[now] > 0]
        open_nodes = np.concatenate([open_nodes, spread(tree.child[inner], tree.child[inner] + tree.children[inner])])
        leaves = now[tree.children[now] == 0]
        if not len(leaves):
            continue
        at = spread(tree.start[leaves], tree.stop[leaves])
        at = at[((tree.labels[at] == label) == same) & (tree.ids[at] != own)]
        scores = tree.scores(at, query, exact)
        for w in range(len(best)):
            inside = np.flatnonzero((scores >= lows[w]) & (scores <= highs[w]) & (scores >= floors[w]))
            if len(inside):
                found = best[w] + list(zip(scores[inside].tolist(), tree.ids[at[inside]].tolist()))
                best[w] = sorted(found, key=lambda f: (-f[0], f[1]))[:k]
                if len(best[w]) == k:
                    last = float(best[w][-1][0])
                    floors[w] = last if exact else max(floors[w], last - abs(last) * 1e-9 - 1)


def descend_together(tree: CoverTree, queries: np.ndarray, own: np.ndarray, labels: np.ndarray, same: bool,
                     lows: np.ndarray, highs: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """What ``descend`` finds for each query, as (query, window, score, id), where doubles are exact.

    ``lows`` and ``highs`` have a row for each query and a column for each window.
    """
    width = lows.shape[1]
    least, greatest = tree.bounds(queries)
    # A node of one label has nothing for a query that looks for the others, and the reverse.
    useful = ~tree.only | ((tree.labels[tree.start] == labels[:, None]) == same)
    inner, leaves = np.flatnonzero(tree.children), np.flatnonzero(tree.children == 0)
    open_nodes, floors, at_once = np.zeros(least.shape, bool), lows.copy(), AT_ONCE
    open_nodes[:, 0] = True
    best = [np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)]      # query and window, score, id
    waiting, held = [], 0                                                   # query, score, id

    def settle():
        asked, scores, ids = (np.concatenate(c) for c in zip(*waiting))
        parts = [best]
        for w in range(width):
            inside = np.flatnonzero((scores >= floors[asked, w]) & (scores <= highs[asked, w]))
            parts.append([asked[inside] * width + w, scores[inside], ids[inside]])
        group, scores, ids = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((ids, -scores, group))
        group = group[order]
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])[:len(group)])
        rank = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
        best[:] = group[rank < k], scores[order[rank < k]], ids[order[rank < k]]
        floors.flat[group[rank == k - 1]] = scores[order[rank == k - 1]]
        waiting.clear()

    while True:
        wanted = np.zeros(least.shape, bool)
        for w in range(width):
            wanted |= (greatest >= floors[:, w, None]) & (least <= highs[:, w, None])
        open_nodes &= wanted & useful
        if not open_nodes.any():
            return best[0] // width, best[0] % width, best[1].astype(np.int64), best[2]
        now = open_nodes.copy()
        if at_once < now.shape[1]:
            up = np.where(open_nodes, greatest, -np.inf)
            now &= up >= np.partition(up, -at_once, axis=1)[:, -at_once, None]
        open_nodes &= ~now
        for node in inner[now[:, inner].any(0)]:
            open_nodes[:, tree.child[node]:tree.child[node] + tree.children[node]] |= now[:, node, None]
        reached = leaves[now[:, leaves].any(0)]
        bottom, top = floors.min(1), highs.max(1)
        for group in gathered(tree, reached[np.argsort(tree.start[reached])], now):
            here = np.flatnonzero(now[:, group].any(1))
            rows = spread(tree.start[group], tree.stop[group])
            leaf = np.repeat(group, tree.stop[group] - tree.start[group])
            step = max(PRODUCTS // len(here), 1)
            for at, of in ((rows[j:j + step], leaf[j:j + step]) for j in range(0, len(rows), step)):
                scores, ids = tree.products(at, queries[here]), tree.ids[at]
                inside = (scores >= bottom[here]) & (scores <= top[here])
                inside &= ((tree.labels[at, None] == labels[here]) == same) & (ids[:, None] != own[here])
                row, by = np.nonzero(inside)
                if len(group) > 1:
                    meant = now[here[by], of[row]]
                    row, by = row[meant], by[meant]
                waiting.append((here[by], scores[row, by], ids[row]))
                held += len(row)
                if held > PRODUCTS:
                    settle()
                    bottom, held = floors.min(1), 0
        if waiting:
            settle()
            held = 0
        # What is left now may count; many small steps would cost more than they skip.
        at_once *= 16 if len(reached) else 1


def gathered(tree: CoverTree, leaves: np.ndarray, now: np.ndarray):
    """Leaves in groups for one product each, where at least a quarter of it is asked for."""
    sizes = (tree.stop - tree.start)[leaves]
    asked = now[:, leaves].T
    group, rows, pairs, who = [], 0, 0, None
    for leaf, size, mine in zip(leaves.tolist(), sizes.tolist(), asked):
        count = size * int(np.count_nonzero(mine))
        if group:
            both = who | mine
            if rows + size > TOGETHER or 4 * (pairs + count) < (rows + size) * np.count_nonzero(both):
                yield np.array(group)
                group, rows, pairs = [], 0, 0
        who = both if group else mine
        group, rows, pairs = [*group, leaf], rows + size, pairs + count
    if group:
        yield np.array(group)


def _build(batches):
    for batch in batches:
        shards, trees = [], []
        for shard, rows in zip(batch.column(0).to_pylist(), batch.column(1)):
            # Repeated rows count once.
            held = sorted({(r["id"], r["label"], r["vector"]) for r in rows.as_py()})
            ids, labels = (np.array([h[k] for h in held], np.int64) for k in (0, 1))
            shards.append(shard)
            trees.append(CoverTree(matrix([h[2] for h in held]), ids, labels).dump())
        yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(trees, pa.binary())], ["shard", "tree"])


def share(score: int, low: int, high: int) -> tuple[int, int]:
    """The whole numbers n with low * score <= 100 * n <= high * score, as (first, last)."""
    return -(-low * score // 100), high * score // 100


def _search(positives: int, negatives: int, low: int, high: int):
    """Best rows of a shard for each query: its positives or, where it has positives, its negatives."""
    def search(batches):
        held, tree = None, None
        for batch in batches:
            for shard, data, queries in zip(*(batch.column(c) for c in ("shard", "tree", "queries"))):
                if data.is_valid:
                    held, tree = shard.as_py(), CoverTree.load(data.as_py())
                    continue
                if shard.as_py() != held:     # no row has that shard
                    continue
                rows, out = queries.as_py(), []
                width = tree.points.shape[1]
                vectors = matrix([r["vector"] for r in rows], width)[:, :width]
                longest = np.sqrt((tree.points ** 2).sum(1)).max()
                exact = np.sqrt((vectors ** 2).sum(1)) * longest < EXACT
                number, own, labels = (np.array([r[c] for r in rows], np.int64) for c in ("number", "id", "label"))
                # All queries of a turn look for the same: positives, or negatives.
                same = rows[0]["positives"] is None
                k = positives if same else negatives
                windows = [[(-np.inf, np.inf)] if same else [share(p["score"], low, high) for p in r["positives"]]
                           for r in rows]
                if exact.any():
                    at, wide = np.flatnonzero(exact), max(map(len, windows))
                    # What fills up the list of windows holds no score.
                    edges = np.array([windows[q] + [(np.inf, -np.inf)] * (wide - len(windows[q])) for q in at], float)
                    query, window, score, found = descend_together(
                        tree, vectors[at], own[at], labels[at], same, edges[:, :, 0], edges[:, :, 1], k)
                    out.append((number[at[query]], window, found, score))
                for q in np.flatnonzero(~exact).tolist():
                    least, greatest = tree.bounds(vectors[q:q + 1])
                    best = descend(tree, vectors[q], least[0], greatest[0], rows[q]["id"], rows[q]["label"], same,
                                   windows[q], k, False)
                    hits = [(rows[q]["number"], w, i, s) for w, some in enumerate(best) for s, i in some]
                    out.append(tuple(np.array([h[c] for h in hits], np.int64) for c in range(4)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)],
                                                 ["number", "positive", "id", "score"])
    return search


def hard_negatives(rows: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   scale: float = 256.0) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for the rows that
    ``anchors`` holds for, and each of their ``positives`` best rows of the same label, the
    ``negatives`` best rows of other labels that score from ``low`` to ``high`` percent of it.

    A score is the inner product of floor(scale * x) of all components, an integer that must fit a
    long.  Greater scores come first, ties by lesser id.  Rows whose id, label, vector or any
    component is null, or a component not finite, take no part.  Ids and labels are integers.
    Repeated rows count once; rows that share an id but not the rest are rows of their own, and none
    is a partner of its own id.  A shorter vector is filled up with zeros.  Other columns are not read.
    """
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    plain = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
                        F.coalesce(anchors, F.lit(False)).alias("anchor")) \
        .where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(whole)
    shards = plain.count() // SHARD_ROWS + 1
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    packed = stored(plain.withColumn("shard", shard).mapInArrow(_pack(scale), ROW), "vectors")
    members = packed.groupBy("shard").agg(F.collect_list(F.struct("id", "label", "vector")).alias("rows"))
    trees = stored(members.mapInArrow(_build, "shard int, tree binary"), "cover-trees")
    asked = stored(packed.where("anchor").select("id", "label", "vector").distinct()
                   .withColumn("number", F.monotonically_increasing_id()), "anchors")
    blocks = asked.count() // BLOCK_ROWS + 1

    def best(queries: DataFrame, k: int, name: str) -> DataFrame:
        block = F.pmod(F.xxhash64("number"), F.lit(blocks)).alias("block")
        dealt = queries.groupBy(block).agg(F.collect_list(F.struct(*[c.split()[0] for c in QUERY.split(", ")]))
                                           .alias("queries")).select(
            F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
            F.lit(None).cast("binary").alias("tree"), "queries", F.lit(1).alias("turn"))
        held = trees.select("shard", "tree", F.lit(None).cast(dealt.schema["queries"].dataType).alias("queries"),
                            F.lit(0).alias("turn"))
        found = held.unionAll(dealt).repartition("shard").sortWithinPartitions("shard", "turn").mapInArrow(
            _search(positives, negatives, low, high), "number long, positive long, id long, score long")
        order = Window.partitionBy("number", "positive").orderBy(F.desc("score"), "id")
        return stored(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), name)

    shape = "array<struct<score:long,id:long>>"
    first = best(asked.withColumn("positives", F.lit(None).cast(shape)), positives, "positives")
    paired = first.groupBy("number").agg(F.array_sort(F.collect_list(F.struct("rank", "score", "id"))).alias("_p")) \
        .select("number", F.transform("_p", lambda p: F.struct(p["score"].alias("score"), p["id"].alias("id"))).alias("positives"))
    queries = stored(asked.join(paired, "number"), "windows")
    second = best(queries, negatives, "negatives").withColumnRenamed("id", "negative_id")
    named = second.join(queries.select("number", F.col("id").alias("anchor_id"), "positives"), "number")
    positive = F.element_at("positives", (F.col("positive") + 1).cast("int"))
    return named.select("anchor_id", positive["id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                        "negative_id", positive["score"].alias("positive_score"), F.col("score").alias("negative_score"))
