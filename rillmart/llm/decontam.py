"""Benchmark decontamination by Wu-Manber multi-pattern search.

A text's words (lower-cased A-Z, digits and everything beyond ASCII) are written one space apart,
texts one zero byte apart.  The patterns are the benchmark's windows in the same form.  For each
pattern length in words a searcher has a shift table over hashed blocks of bytes: how far the
search may jump because no pattern has that block nearer its end; where the shift is zero, the
block's bucket lists the patterns that end (their first ``m`` bytes) in it, and bytes are compared
directly.  Many cursors walk the buffer side by side in numpy, each over its own stretch, so
neither a long text nor a popular passage changes how the work is laid out.

Patterns are compiled in shards of at most ``SHARD_WINDOWS`` windows.  Each shard is one broadcast
of bounded size and the documents stream through the shards one after another.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import add_columns, texts_of, unaligned_u64

WINDOW = 13
SHARD_WINDOWS = 100_000
LANE = 512                # bytes of the buffer that one cursor walks
TABLE_BITS = 18
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
# Bytes of words become lower case, all others a space: words are [0-9a-z] and bytes above 0x7F.
CANONICAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122
                  else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(CANONICAL).split()


def windows_of(words: list[bytes], window: int = WINDOW) -> set[bytes]:
    """An item's windows, as patterns: words between single spaces."""
    if not words:
        return set()
    last = max(len(words) - window, 0)
    return {b" " + b" ".join(words[i:i + window]) + b" " for i in range(last + 1)}


class Searcher:
    """Shift and bucket tables for patterns of ``words`` words each."""

    def __init__(self, words: int, patterns: list[bytes]):
        self.words, self.patterns = words, patterns
        self.m = min(4096, min(map(len, patterns)))
        self.block = min(8, self.m)
        self.mask = np.uint64((1 << (8 * self.block)) - 1)
        span = self.m - self.block
        self.shift = np.full(1 << TABLE_BITS, span + 1, np.uint16)
        heads = np.frombuffer(b"".join(p[:self.m] for p in patterns) + bytes(8), np.uint8)
        blocks = self.hash(unaligned_u64(heads))
        starts = np.arange(len(patterns)) * self.m
        for at in range(span + 1):                  # the nearest to the end is written last
            self.shift[blocks[starts + at]] = span - at
        self.bucket: dict[int, list[int]] = defaultdict(list)
        for k, h in enumerate(blocks[starts + span].tolist()):
            self.bucket[h].append(k)
        self.bucket = dict(self.bucket)

    def hash(self, values: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((values & self.mask) * MULTIPLIER) >> np.uint64(64 - TABLE_BITS)

    def find(self, text: bytes, data: np.ndarray) -> tuple[list[int], list[int]]:
        """(start, pattern number) of every occurrence; ``text`` ends with eight zero bytes."""
        loads = unaligned_u64(data)
        span, last = self.m - self.block, len(data) - 8 - self.m
        at = np.arange(0, max(last + 1, 0), LANE)
        stop = np.minimum(at + LANE, last + 1)
        places, patterns = [], []
        while len(at):
            hashed = self.hash(loads[at + span])
            jump = self.shift[hashed].astype(np.int64)
            for start, h in zip(at[jump == 0].tolist(), hashed[jump == 0].tolist()):
                for k in self.bucket[h]:
                    if text.startswith(self.patterns[k], start):
                        places.append(start)
                        patterns.append(k)
            at += np.maximum(jump, 1)
            if (at >= stop).any():
                live = at < stop
                at, stop = at[live], stop[live]
        return places, patterns


def compile_shard(rows: list[tuple[str, list[bytes]]]) -> list[tuple[Searcher, list[list[str]]]]:
    """A searcher for each number of words, with the items of each of its patterns."""
    items: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
    for item, patterns in rows:
        for p in patterns:
            items[p.count(b" ") - 1][p].add(item)
    return [(Searcher(n, list(of)), [sorted(v) for v in of.values()]) for n, of in sorted(items.items())]


def search(texts: list[bytes], searchers) -> list[tuple[int, np.ndarray, set[str]]]:
    """For each text: its number of words, which words are hit, which items occur."""
    words = [words_of(t) for t in texts]
    parts = [b" " + b" ".join(w) + b" " if w else b"" for w in words]
    text = b"\0".join(parts) + bytes(9)
    data = np.frombuffer(text, np.uint8)
    begins = np.cumsum([0] + [len(p) + 1 for p in parts])[:-1]
    spaces = np.flatnonzero(data == 32)
    first = np.searchsorted(spaces, begins)
    marks = np.zeros(len(spaces) + 1, np.int32)
    found: list[set[str]] = [set() for _ in texts]
    for searcher, items in searchers:
        places, patterns = searcher.find(text, data)
        if not places:
            continue
        places = np.array(places)
        word = np.searchsorted(spaces, places)
        np.add.at(marks, word, 1)
        np.add.at(marks, word + searcher.words, -1)
        for doc, k in zip((np.searchsorted(begins, places, "right") - 1).tolist(), patterns):
            found[doc].update(items[k])
    hit = np.cumsum(marks) > 0
    return [(len(w), hit[f:f + len(w)], s) for w, f, s in zip(words, first.tolist(), found)]


def _scan(shard):
    def compute(columns):
        searchers = shard.value
        for texts, *before in columns:
            out = [[], [], [], []]
            earlier = zip(*(c.to_pylist() for c in before)) if before else None
            for n, hit, items in search(texts_of(texts), searchers):
                bits, known = next(earlier) if earlier else (None, ())
                if bits:
                    hit = hit | (np.unpackbits(np.frombuffer(bits, np.uint8), count=n) > 0)
                row = (n, int(hit.sum()), np.packbits(hit).tobytes() if hit.any() else None,
                       sorted(items.union(known)))
                for values, value in zip(out, row):
                    values.append(value)
            yield [pa.array(v, t) for v, t in zip(out, (
                pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.string())))]
    return compute


ADDED = {"n_words": T.LongType(), "n_hit": T.LongType(), "hit_bits": T.BinaryType(),
         "items": T.ArrayType(T.StringType())}


def mark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", window: int = WINDOW, shard_windows: int = SHARD_WINDOWS) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``hit_bits`` (a bit for each word, null if none is hit) and ``items``.

    A null text has no words; an item without words has no windows; an item without an id counts
    under the empty id, and rows that repeat an id are one item.  ``items`` are ids as text, sorted.
    New columns whose names are taken get underscores in front.  An empty benchmark hits nothing.
    """
    sc = docs.sparkSession.sparkContext

    def cut(batches):
        for batch in batches:
            ids = [i or "" for i in batch.column(0).to_pylist()]
            sets = [windows_of(words_of(t), window) for t in texts_of(batch.column(1))]
            rows = [(i, p) for i, s in zip(ids, sets) for p in sorted(s)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                              pa.array([r[1] for r in rows], pa.binary())], ["item", "pattern"])

    patterns = benchmark.select(F.col(f"`{item_col}`").cast("string"), F.col(f"`{item_text_col}`")) \
        .mapInArrow(cut, "item string, pattern binary").distinct()
    shards = patterns.groupBy().count().first()[0] // shard_windows + 1
    sharded = patterns.withColumn("shard", F.pmod(F.xxhash64("pattern"), F.lit(shards)))
    for k in range(shards):
        # At most about ``shard_windows`` rows, whatever the benchmark's size.
        rows = sharded.where(F.col("shard") == k).select("item", "pattern").toArrow()
        items, found = rows.column(0).to_pylist(), rows.column(1).to_pylist()
        compiled = sc.broadcast(compile_shard([(i, [p]) for i, p in zip(items, found)]))
        if k == 0:
            out = add_columns(docs, ADDED, _scan(compiled), text_col)
        else:
            bits, known = out.columns[-2:]
            names = out.columns[:-4]
            next_out = add_columns(out, ADDED, _scan(compiled), text_col, bits, known)
            out = next_out.select(*[F.col(f"`{c}`") for c in names + next_out.columns[-4:]]) \
                .toDF(*out.columns)
    return out


def contaminated(n_hit, n_words):
    """At least one word in twenty is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with its columns.

    Null and empty texts have no words and stay, as does everything if the benchmark is empty.
    Rows are judged one by one: null and repeated ids do not matter, nor do clashing column names.
    """
    marked = mark(docs, benchmark, **options)
    n_words, n_hit = (F.col(f"`{c}`") for c in marked.columns[-4:-2])
    return marked.where(~contaminated(n_hit, n_words)).select(
        *[F.col(f"`{c}`") for c in docs.columns])
