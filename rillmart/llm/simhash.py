"""Near duplicates by SimHash, linked by tiled exact comparison.

Fingerprints are compared, not texts, and each distinct fingerprint once.  Two that differ in at
most ``radius`` bits agree on at least ``BLOCKS - radius`` of ``BLOCKS`` blocks of bits, so each
fingerprint is filed under every choice of that many blocks.  A file of more than ``TILE`` entries
is cut into tiles of one population count each; a pair of tiles is compared only if the counts
differ by no more than the radius, since a bit more or less is a bit that differs.  Comparing is
exclusive-or and bit counts over whole tiles in numpy.  A task holds two tiles at a time; a tile
pair yields a spanning forest of its links, at most one row for each entry.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from rillmart.operators.joins import attach_marks

from .common import add_columns, free, new_names, stored, texts_of
from .components import components

SHINGLE, RADIUS, SEED = 3, 3, 42
BLOCKS, TILE, CHUNK = 5, 1024, 1 << 16


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash over word shingles with repeats, A-Z in lower case.

    Fewer words than a shingle are one shingle; a text without words has fingerprint zero.
    """
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(len(words) - shingle + 1, 1)
    stops = ends[-n:].tolist()
    starts = [0] + (ends[:n - 1] + 1).tolist()
    ones = np.zeros(64, np.int64)
    for k in range(0, n, CHUNK):
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED)
                           for a, b in zip(starts[k:k + CHUNK], stops[k:k + CHUNK])], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with ``simhash`` (signed 64 bits); null counts as empty."""
    def compute(columns):
        for (column,) in columns:
            yield [pa.array([simhash(t, shingle) for t in texts_of(column)], pa.int64())]
    return add_columns(docs, {"simhash": T.LongType()}, compute, text_col)


def _masks(radius: int) -> list[int]:
    """For each choice of ``BLOCKS - radius`` blocks, the bits in them, as signed integers."""
    edge = [round(64 * k / BLOCKS) for k in range(BLOCKS + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(edge, edge[1:])]
    masks = [functools.reduce(int.__or__, c) for c in itertools.combinations(block, BLOCKS - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(value, root) for every value that is linked to a lesser one, by tiles of 256."""
    n = len(values)
    if n == 2:
        near = int(np.bitwise_count(values[0] ^ values[1])) <= radius
        return [(int(values.view(np.int64).max()), int(values.view(np.int64).min()))] if near else []
    counts = np.bitwise_count(values)
    order = np.argsort(counts, kind="stable")
    values, counts = values[order], counts[order].astype(np.int64)
    root, step = np.arange(n), 256
    for a in range(0, n, step):
        tile = values[a:a + step]
        for b in range(a, n, step):
            if counts[b] - counts[min(a + step, n) - 1] > radius:
                break                     # all further tiles have larger counts still
            i, j = np.nonzero(np.bitwise_count(tile[:, None] ^ values[None, b:b + step]) <= radius)
            i, j = i + a, j + b
            while len(i):
                x, y = root[i], root[j]
                apart = x != y
                i, j, x, y = i[apart], j[apart], x[apart], y[apart]
                np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
                while (root[root] != root).any():
                    root = root[root]
    signed = values.view(np.int64)
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, root, signed)
    moved = least[root] != signed
    return list(zip(signed[moved].tolist(), least[root][moved].tolist()))


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of ``simhash`` within ``radius`` bits.

    ``prints`` holds distinct fingerprints; radius must be less than ``BLOCKS``.
    """
    filed = prints.select("simhash", F.bit_count("simhash").alias("ones"), F.posexplode(F.array(
        *[F.col("simhash").bitwiseAND(F.lit(m)) for m in _masks(radius)])).alias("choice", "key"))
    sizes = filed.groupBy("choice", "key", "ones").count().groupBy("choice", "key").agg(
        F.sum("count").alias("size"),
        F.collect_list(F.struct("ones", F.ceil(F.col("count") / TILE).cast("int").alias("tiles"))).alias("by"))
    found = attach_marks(filed, sizes.where("size > 1"), ["choice", "key"])
    # A tile is ``ones << 32 | place``; small files have the one tile -1.
    own = F.get(F.filter("by", lambda g: g.ones == F.col("ones")), 0)
    tile = (F.shiftleft(F.col("ones").cast("long"), 32)
            + F.pmod(F.xxhash64("simhash"), own.tiles.cast("long")))
    others = F.flatten(F.transform(
        F.filter("by", lambda g: F.abs(g.ones - F.col("ones")) <= radius),
        lambda g: F.transform(F.sequence(F.lit(0), g.tiles - 1),
                              lambda k: F.shiftleft(g.ones.cast("long"), 32) + k)))
    pairs = F.when(F.col("size") <= TILE, F.array(F.struct(F.lit(-1).cast("long").alias("s"), F.lit(-1).cast("long").alias("t")))) \
        .otherwise(F.transform(others, lambda t: F.struct(F.least(tile, t).alias("s"), F.greatest(tile, t).alias("t"))))
    unit = ["choice", "key", "s", "t"]
    rows = found.select("choice", "key", "simhash", F.explode(pairs).alias("p")) \
        .select("choice", "key", "p.s", "p.t", "simhash")

    def compare(batches):
        held_key, held = None, []

        def flush():
            values = np.concatenate(held)
            return _forest(values.view(np.uint64), radius) if len(values) > 1 else []

        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(4)])
            values = batch.column(4).to_numpy()
            if not len(values):
                continue
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            out = []
            bounds = [0, *cuts.tolist(), len(values)]
            for a, b in zip(bounds, bounds[1:]):
                key = keys[:, a].tolist()
                if key != held_key:
                    if held:
                        out += flush()
                    held_key, held = key, []
                held.append(values[a:b])
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[k] for e in out], pa.int64()) for k in (0, 1)], ["a", "b"])
        if held:
            out = flush()
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[k] for e in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return rows.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(prints: DataFrame, id_col: str = "doc_id", print_col: str = "simhash",
                    radius: int = RADIUS) -> DataFrame:
    """``prints`` with ``component_id`` and ``kept``.

    Rows are linked when their fingerprints differ in at most ``radius`` bits; a component is what
    links connect, and its id is the least id in it (null if there is none).  Exactly one row of
    each component is kept: one with that id.  Rows with a null id belong to components like any
    other.  An empty table gives an empty table; names that are taken get underscores in front.
    """
    own = prints.columns
    inner = prints.toDF(*[f"c{k}" for k in range(len(own))])
    key, value = (f"c{own.index(c)}" for c in (id_col, print_col))
    table = stored(inner.withColumn("row", F.monotonically_increasing_id()), "simhash")
    groups = table.groupBy(F.col(value).alias("simhash")).agg(
        F.min(key).alias("least"), F.coalesce(F.min_by("row", key), F.min("row")).alias("stays"))
    groups = stored(groups, "simhash-groups")
    linked = components(links(groups.select("simhash"), radius))
    rooted = groups.join(linked, groups.simhash == linked.node).select("root", "simhash", "least", "stays")
    best = rooted.groupBy("root").agg(
        F.min("least").alias("least"),
        F.coalesce(F.min_by("stays", "least"), F.min("stays")).alias("stays"))
    merged = rooted.select("root", "simhash").join(best, "root").select("simhash", "least", "stays")
    free(prints.sparkSession)
    alone = groups.join(linked, groups.simhash == linked.node, "left_anti")
    into = alone.select("simhash", "least", "stays").unionAll(merged)
    out = table.join(into, F.col(value) == F.col("simhash"))
    return out.select(*inner.columns, "least", F.col("row") == F.col("stays")) \
        .toDF(*own, *new_names(prints, "component_id", "kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         radius: int = RADIUS) -> DataFrame:
    """One row of each group of near duplicates, with the columns of ``docs``.

    Null and empty texts have one fingerprint and so form a group.  Ids may be null or repeat;
    columns may have the operator's names.  An empty table gives none.
    """
    out = fingerprints(docs, text_col)
    out = near_duplicates(out, id_col, out.columns[-1], radius)
    return out.where(F.col(f"`{out.columns[-1]}`")).select(*[F.col(f"`{c}`") for c in docs.columns])
