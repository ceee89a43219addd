"""A Merkle manifest of a table, with every row's proof found by pointer jumping.

Rows are leaves of one binary tree for each value of a column; the trees' roots (subroots) are the
leaves of one more tree.  A node is named by (tree, level, place), and its parent is
(tree, level + 1, place / 2): over a subroot the path goes on along the top tree, one node a level.

1. Ranking.  Leaves are range-partitioned by (tree, id) and numbered inside their partition; a
   table of one row for each partition and tree carries the offsets.  A tree with most of the rows
   is spread like any other.
2. Building.  ``BLOCK`` neighbouring nodes of one level meet in one row and send up the node
   ``BLOCK_LEVELS`` higher.  Every node that has a parent leaves a segment: the side and the digest
   of its sibling.
3. Jumping.  A segment that reaches 2^k levels up is joined with that of the node it ends in, which
   doubles its reach.  Only nodes on levels that are multiples of the reach are still needed, so the
   tables shrink; the leaves take the doubled segments that start on level 1, 2, 4, ... one after
   another until they stand at the root.

Digests are SHA-256, as hex text where they are hashed or shown and as raw bytes in segments.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rillmart.operators.joins import attach_marks

from .common import free_name, stored

BLOCK_LEVELS = 9
BLOCK = 1 << BLOCK_LEVELS
# A segment is one letter a level, and 32 bytes for each letter but the last of these.
LEFT, RIGHT, ALONE = "l", "r", "-"
DIGEST = 32
# A node without ``sides`` is the highest of its block; ``path`` is then its own digest.
NODES = "tree string, level int, place long, n long, sides string, path binary"


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 of the columns in turn: ``-`` if null, else UTF-8 byte count, ``:`` and the value."""
    def field(c: Column) -> Column:
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256)


def fold(digest: Column, sides: Column, path: Column) -> Column:
    """The root that ``digest`` and its siblings, from the leaf up, hash to."""
    def step(state: Column, side: Column) -> Column:
        sibling = F.lower(F.hex(F.substring(path, state["at"] + 1, F.lit(DIGEST))))
        pair = (F.when(side == LEFT, F.concat(sibling, state["digest"]))
                .when(side == RIGHT, F.concat(state["digest"], sibling)).otherwise(state["digest"]))
        return F.struct(F.sha2(pair.cast("binary"), 256).alias("digest"),
                        (state["at"] + F.when(side == ALONE, 0).otherwise(DIGEST)).alias("at"))
    letters = F.filter(F.split(sides, ""), lambda c: c != "")
    start = F.struct(digest.alias("digest"), F.lit(0).alias("at"))
    return F.aggregate(letters, start, step)["digest"]


def proof_digest(path: Column) -> Column:
    """SHA-256 of a proof's digests as hex text, from the leaf up."""
    return F.sha2(F.lower(F.hex(path)).cast("binary"), 256)


def _ranked(rows: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``place``, from 0 in each tree by ``order``, and ``n``, the rows of the tree."""
    number = F.monotonically_increasing_id()
    table = stored(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
                   .withColumns({"part": F.shiftright(number, 33), "at": number}), name)
    runs = table.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    # A tree has one row for each partition here.
    whole = Window.partitionBy("tree")
    before = F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = runs.select("tree", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
                         F.sum("rows").over(whole).alias("n"))
    return attach_marks(table, shifts, ["tree", "part"]).withColumn(
        "place", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _parent(*digests: bytes) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def _climb_block(tree: str, level: int, block: int, n: int, digests: list[bytes]) -> list[tuple]:
    """The segments of a block's nodes, and the node above it all."""
    out, first = [], block << BLOCK_LEVELS
    for _ in range(BLOCK_LEVELS):
        if n == 1:
            break
        count = len(digests)
        for k in range(count):
            other = k ^ 1
            side = ALONE if other == count else LEFT if k & 1 else RIGHT
            out.append((tree, level, first + k, None, side, b"" if other == count else digests[other]))
        digests = [_parent(*digests[k:k + 2]) for k in range(0, count, 2)]
        level, first, n = level + 1, first >> 1, n + 1 >> 1
    out.append((tree, level, first, n, None, digests[0]))
    return out


def _climb(batches):
    names = [c.split()[0] for c in NODES.split(", ")]
    types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    for batch in batches:
        for row in batch.to_pylist():
            nodes = _climb_block(row["tree"], row["level"], row["block"], row["n"],
                                 [d["path"] for d in row["nodes"]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*nodes), types)], names)


def _grow(leaves: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(segments of all nodes below a root, roots) of trees given by their ranked leaves."""
    # The columns of NODES, from (tree, level, place, n, path).
    tops = leaves.select("tree", "level", "place", "n", "path")
    segments, roots = [], [tops.where("n = 1")]
    live = tops.where("n > 1")
    while not live.isEmpty():
        blocks = live.groupBy("tree", "level", F.shiftright("place", BLOCK_LEVELS).alias("block"), "n").agg(
            F.array_sort(F.collect_list(F.struct("place", "path"))).alias("nodes"))
        nodes = stored(blocks.mapInArrow(_climb, NODES), name)
        segments.append(nodes.where("sides IS NOT NULL").drop("n"))
        above = nodes.where("sides IS NULL").drop("sides")
        roots.append(above.where("n = 1"))
        live = above.where("n > 1")
    union = functools.partial(functools.reduce, DataFrame.unionByName)
    none = leaves.select("tree", "level", "place", F.lit("").alias("sides"), "path").where("false")
    return union(segments) if segments else none, union(roots)


def _join_up(rows: DataFrame, ends: DataFrame, reach: int) -> DataFrame:
    """``rows`` with their segment prolonged by that of the node ``reach`` levels higher, if any."""
    place = F.shiftright("place", reach)
    above = ends.select(F.col("tree").alias("_tree"), F.col("level").alias("_level"), F.col("place").alias("_place"),
                        F.col("sides").alias("_sides"), F.col("path").alias("_path"))
    met = rows.join(above, (F.col("tree") == F.col("_tree")) & (F.col("level") + reach == F.col("_level"))
                    & (place == F.col("_place")), "left")
    return met.withColumns({
        "sides": F.concat("sides", F.coalesce("_sides", F.lit(""))),
        "path": F.concat("path", F.coalesce("_path", F.lit(b"")))}).drop(
            "_tree", "_level", "_place", "_sides", "_path")


def manifest(docs: DataFrame, id_col: str = "doc_id", tree_col: str = "lang",
             columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
             carry: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``tree_col``, ``leaf``, ``place``, ``subroot``, ``root``
    and its proof (``sides``, ``path``); ``fold`` leads from leaf and proof to the root.

    A leaf is the digest of ``columns``.  In each tree leaves ascend by id (null first), rows of one
    id by their leaf.  A null in ``tree_col`` has a tree of its own, which comes first; trees follow
    each other by their UTF-8 bytes.  Only ``columns`` are read; ``carry`` names further columns to
    compute from ``docs`` and hand on.  A name that is taken gets underscores in front.  An empty
    table has an empty manifest and no root.
    """
    extra, tree = dict(carry or {}), F.col(f"`{tree_col}`")
    given = [id_col, tree_col, *extra]
    inner = [f"c{k}" for k in range(len(given))]
    values = [F.col(f"`{id_col}`"), tree, *extra.values()]
    leaves = stored(docs.select(
        *[v.alias(c) for v, c in zip(values, inner)],
        F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit("")).alias("tree"),
        leaf_digest(*[F.col(f"`{c}`") for c in columns]).alias("leaf"),
        F.monotonically_increasing_id().alias("row")), "leaves")
    ranked = stored(_ranked(leaves, "sorted-leaves", ["c0", "leaf", "row"]).drop("row").withColumns(
        {"level": F.lit(0), "path": F.unhex("leaf")}), "ranked-leaves")
    inner_segments, roots = _grow(ranked, "nodes")

    subroots = roots.select("tree", F.col("level").alias("height"), F.col("path").alias("digest"))
    listed = _ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "height", "digest"),
                     "subroots", ["name"])
    top = stored(listed.withColumns({"level": F.lit(0), "path": F.col("digest")}), "top-leaves")
    top_segments, top_roots = _grow(top, "top-nodes")
    last = top_roots.first()
    root, top_height = (bytes(last.path).hex(), last.level) if last else (None, 0)

    segments = [inner_segments.select("tree", "level", "place", "sides", "path")]
    if top_height:
        steps = top.select(F.col("name").alias("_tree"), "height", F.col("place").alias("rank"), F.explode(
            F.sequence(F.lit(0), F.lit(top_height - 1))).alias("step"))
        on = (F.col("step") == F.col("level")) & (F.expr("shiftright(rank, step)") == F.col("place"))
        segments.append(steps.join(top_segments, on).select(
            F.col("_tree").alias("tree"), (F.col("height") + F.col("step")).cast("int").alias("level"),
            F.lit(0).cast("long").alias("place"), "sides", "path"))
    hops = stored(functools.reduce(DataFrame.unionByName, segments), "segments")
    height = (top.agg(F.max("height")).first()[0] or 0) + top_height

    proofs = _join_up(ranked.withColumns({"sides": F.lit(""), "path": F.lit(b"")}), hops.where("level = 0"), 0)
    reach = 1
    while reach < height:
        proofs = _join_up(proofs, hops.where(F.col("level") == reach), reach)
        start = F.col("level") % (2 * reach)
        hops = stored(_join_up(hops.where((start == 0) & (F.col("level") > 0)),
                               hops.where(start == reach), reach), "hops")
        reach *= 2
    out = proofs.join(top.select(F.col("name").alias("_tree"), F.hex("digest").alias("subroot")),
                      F.col("tree") == F.col("_tree"))
    made = {"leaf": F.col("leaf"), "place": F.col("place"), "subroot": F.lower("subroot"),
            "root": F.lit(root).cast("string"), "sides": F.col("sides"), "path": F.col("path")}
    names = list(given)
    for name in made:
        names.append(free_name(names, name))
    return out.select(*inner, *made.values()).toDF(*names)
