"""Connected components of a graph given as edges, by alternating large and small stars.

Every step is an aggregate to a node's least neighbour and a join back to the edges; no node's
neighbours are ever gathered.  Each round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rillmart.operators.joins import attach_marks

from .common import discard, stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (large: the greater ones, small: the lesser) tied to its least one."""
    sides = edges
    if large:
        sides = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = sides.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("a"), F.least("a", "m").alias("m"))
    tied = attach_marks(sides, least, ["a"])
    if large:
        return tied.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.select(F.explode(F.array(
        F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
        F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), whose root is its component's least node.

    Loops and repeated edges do no harm; an edge with a null end is ignored.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(edges.distinct(), "edges")
    state = None
    while (found := _state(now)) != state:
        state, before = found, now
        after_large = _stars(now, True).where("a <> b").distinct()
        now = stored(_stars(after_large, False).where("a <> b").distinct(), "edges")
        discard(before)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
