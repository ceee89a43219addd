"""Substring dedup on bytes by external induced sorting of suffixes.

A window is 200 bytes of one text.  Every window is looked for exactly once:

1. Anchors.  Of the 16-byte grams of a window the one with the least hash is its anchor, so equal
   windows have equal anchors at equal offsets.  Offsets are cut into classes; windows that follow
   each other with one anchor and class are a run, and all of them hold the same stretch of bytes
   around the anchor.  Its hash is the run's key.  Keys that occur once are dropped.
2. Passages.  The bytes of a run's windows are a passage.  Equal passages meet as partial aggregates and
   go on as one with a count; their places find them again by key and a 128-bit digest.  A key with more than ``HOT_BYTES`` of different passages has its runs
   cut again into narrower classes, whose stretches are longer; the narrowest is the window itself.
3. Sorting.  Passages are dealt to shards by key.  A shard writes them one after another, sorts the
   suffixes by induction (``induced``) with their common prefixes, and marks windows that share all
   their bytes with a neighbour.  Windows of a passage that has copies are marked too.
4. Removal.  The marked windows of each text are joined to it.

A complete window stands in exactly one passage, so no window is found equal to itself.
"""

from __future__ import annotations

import functools
import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from rillmart.operators.joins import attach_marks

from . import induced
from .common import add_columns, discard, free, free_name, stored, texts_of

WINDOW, GRAM = 200, 16
CLASSES = (93, 24, 6, 1)      # widths of the classes of offsets, for ever hotter keys
HOT_BYTES = 1 << 20           # of different passages under a key
SHARD_BYTES = 1 << 20         # of a shard, about
STRETCH = 1 << 18             # bytes hashed together
_UP = 0x9E3779B97F4A7C15
_DOWN = pow(_UP, -1, 1 << 64)
_PLACE = np.uint64((1 << 24) - 1)
PASSAGE = "key long, digest binary, passage binary, offset int, row long, starts array<long>"


def _powers(base: int, n: int) -> np.ndarray:
    out, done = np.ones(n, np.uint64), 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return _powers(_UP, STRETCH + WINDOW), _powers(_DOWN, STRETCH + WINDOW)


def _mix(h: np.ndarray) -> np.ndarray:
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0x9E3779B97F4A7C15)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(32))


def stretch_of(offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the bytes begin and end, from the anchor, that all windows of an offset's class hold."""
    first = offsets // width * width
    last = np.minimum(first + width - 1, WINDOW - GRAM)
    return -first, WINDOW - last


def _hashed_runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first window, end, offset of the anchor in the first window, key) of the runs of texts that
    stand one after another and end at ``ends``; ``STRETCH`` bytes and a window at most."""
    up, down = _tables()
    n, grams = len(data), len(data) - GRAM + 1
    if n < WINDOW:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        least = _mix((sums[GRAM:] - sums[:grams]) * down[:grams]) & ~_PLACE | np.arange(grams, dtype=np.uint64)
        size, width = 1, WINDOW - GRAM + 1
        while size < width:
            step = min(size, width - size)
            least, size = np.minimum(least[:-step], least[step:]), size + step
        anchor = (least & _PLACE).astype(np.int64)
        windows = np.arange(len(anchor))
        offset = anchor - windows
        kind = offset // CLASSES[0]
        end_of = np.repeat(ends, np.diff(ends, prepend=0))[:len(anchor)]
        whole = windows + WINDOW <= end_of
        turn = (anchor[1:] != anchor[:-1]) | (kind[1:] != kind[:-1]) | (end_of[1:] != end_of[:-1]) | (whole[1:] != whole[:-1])
        start = np.flatnonzero(np.concatenate([[True], turn]))
        stop = np.append(start[1:], len(anchor))
        start, stop = start[whole[start]], stop[whole[start]]
        begin, end = stretch_of(offset[start], CLASSES[0])
        begin, end = anchor[start] + begin, anchor[start] + end
        key = _mix((sums[end] - sums[begin]) * down[begin] + kind[start].astype(np.uint64))
    return start, stop, offset[start], key.view(np.int64)


def runs(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, first window, end, offset of the anchor in the first window, key) of all runs; a text
    shorter than a window has none.  Texts are hashed together, long ones in stretches."""
    parts, at = [], 0
    while at < len(texts):
        if len(texts[at]) >= STRETCH:
            for place in range(0, len(texts[at]) - WINDOW + 1, STRETCH):
                data = np.frombuffer(texts[at][place:place + STRETCH + WINDOW - 1], np.uint8)
                start, stop, offset, key = _hashed_runs(data, np.array([len(data)]))
                parts.append((np.full(len(start), at), start + place, stop + place, offset, key))
            at += 1
            continue
        last, size = at, 0
        while last < len(texts) and size + len(texts[last]) < STRETCH:
            size, last = size + len(texts[last]), last + 1
        ends = np.cumsum([len(t) for t in texts[at:last]])
        start, stop, offset, key = _hashed_runs(np.frombuffer(b"".join(texts[at:last]), np.uint8), ends)
        text = np.searchsorted(ends, start, "right")
        first = np.concatenate([[0], ends])[text]
        parts.append((text + at, start - first, stop - first, offset, key))
        at = last
    parts.append(tuple(np.zeros(0, np.int64) for _ in range(5)))
    return tuple(np.concatenate(c).astype(np.int64) for c in zip(*parts))


def _occurrences(batches):
    for batch in batches:
        text, _, _, _, key = runs(texts_of(batch.column(1)))
        order = np.lexsort((key, text))
        text, key = text[order], key[order]
        first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (key[1:] != key[:-1])])[:len(key)])
        rows = batch.column(0).to_numpy()[text[first]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[first]), pa.array(rows), pa.array(np.diff(np.append(first, len(key))))], ["key", "row", "n"])


def _rows(found: dict, row: int, out: list) -> None:
    out += [(key, hashlib.blake2b(passage, digest_size=16).digest(), passage, offset, row, starts)
            for (key, passage), (offset, starts) in found.items()]


def _table(out: list) -> pa.RecordBatch:
    types = [pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(types)],
                                      [c.split()[0] for c in PASSAGE.split(", ")])


def _passages(batches):
    """Each text's different passages under the keys listed for it, with the places of each."""
    for batch in batches:
        out, texts, found, now = [], texts_of(batch.column(1)), {}, -1
        rows, listed = batch.column(0).to_pylist(), batch.column(2)
        for text, a, b, o, k in zip(*(c.tolist() for c in runs(texts))):
            if text != now:
                _rows(found, rows[now], out)
                found, now, wanted, whole = {}, text, set(listed[text].values.to_pylist()), texts[text]
            if k in wanted:
                found.setdefault((k, whole[a:b + WINDOW - 1]), (o, []))[1].append(a)
        _rows(found, rows[now] if rows else 0, out)
        yield _table(out)


def _cut(width: int):
    """Passages as those of narrower classes."""
    def cut(batches):
        from xxhash import xxh3_64_intdigest

        for batch in batches:
            out = []
            for _, _, passage, offset, row, starts in zip(*(c.to_pylist() for c in batch.columns)):
                windows = np.arange(len(passage) - WINDOW + 1)
                offsets = offset - windows
                first = np.flatnonzero(np.concatenate([[True], np.diff(offsets // width) != 0])).tolist()
                found = {}
                for a, b in zip(first, [*first[1:], len(windows)]):
                    begin, end = (int(x) + offset for x in stretch_of(offsets[a], width))
                    held = passage[begin:end] + int(offsets[a] // width).to_bytes(2, "little")
                    key = xxh3_64_intdigest(held) - (1 << 63)
                    found.setdefault((key, passage[a:b + WINDOW - 1]), (int(offsets[a]), []))[1].extend(
                        [s + a for s in starts])
                _rows(found, row, out)
            yield _table(out)
    return cut


def _sort(batches):
    """Marked windows (first, end) of each passage; a shard's passages follow each other by key."""
    held, waiting = None, []
    for batch in batches:
        names = ("shard", "key", "digest", "passage", "copies")
        for shard, *passage in zip(*(batch.column(c).to_pylist() for c in names)):
            if shard != held and waiting:
                yield _marked(waiting)
                waiting = []
            held = shard
            waiting.append(passage)
    if waiting:
        yield _marked(waiting)


def _marked(passages: list[tuple[int, bytes, bytes, int]]) -> pa.RecordBatch:
    kinds = Counter(p[0] for p in passages)
    # A passage that is alone under its key shares its windows with its copies only.
    marks = [(key, digest, [(0, len(passage) - WINDOW + 1)]) for key, digest, passage, copies in passages
             if kinds[key] == 1 and copies > 1]
    passages = [p for p in passages if kinds[p[0]] > 1]
    if passages:
        # 0 ends the text, 1 parts passages, a byte is its value and two.
        ends = np.cumsum([len(p) + 1 for _, _, p, _ in passages])
        raw = np.frombuffer(b"\0".join(p for _, _, p, _ in passages) + b"\0\0", np.uint8)
        dtype = np.uint8 if raw.max() < 254 else np.uint16
        symbols = raw.astype(dtype) + dtype(2)
        symbols[ends - 1], symbols[-1] = 1, 0
        found = induced.recurring(symbols, WINDOW)
        for (key, digest, passage, copies), end in zip(passages, ends.tolist()):
            at = end - 1 - len(passage)
            hits = found[at:at + len(passage) - WINDOW + 1] | (copies > 1)
            edges = np.flatnonzero(np.diff(np.concatenate([[False], hits, [False]]))).tolist()
            if edges:
                marks.append((key, digest, list(zip(edges[::2], edges[1::2]))))
    spans = [[{"first": a, "end": b} for a, b in m[2]] for m in marks]
    return pa.RecordBatch.from_arrays(
        [pa.array([m[0] for m in marks], pa.int64()), pa.array([m[1] for m in marks], pa.binary()),
         pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))], ["key", "digest", "spans"])


def _remove(columns):
    for texts, cuts in columns:
        made = [[], [], [], []]
        for text, cut in zip(texts_of(texts), cuts.to_pylist()):
            joined = []
            for start, stop in sorted((c["start"], c["stop"]) for c in cut or ()):
                if joined and start <= joined[-1][1]:
                    joined[-1][1] = max(stop, joined[-1][1])
                else:
                    joined.append([start, stop])
            kept = [text[a:b] for a, b in zip([0, *(j[1] for j in joined)], [*(j[0] for j in joined), len(text)])]
            removed = sum(b - a for a, b in joined)
            for column, value in zip(made, (len(text), removed, len(joined), b"".join(kept) if joined else text)):
                column.append(value)
        yield [pa.array(m, t) for m, t in zip(made, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))]


def remove_repeats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_bytes``.

    A byte goes if it lies in a window whose bytes also start anywhere else, in the same text or
    another; windows are judged on the texts as given, as UTF-8.  ``n_spans`` counts the runs of bytes
    that went.  Null texts are empty.  ``kept_bytes`` may cut a character and is binary.  No id is
    read; every row is a text of its own.  All columns stay; new columns whose names are taken get
    underscores in front.  An empty table gives an empty table.
    """
    own, spark = docs.columns, docs.sparkSession
    inner = docs.toDF(*[f"c{k}" for k in range(len(own))])
    table = stored(inner.withColumn("row", F.monotonically_increasing_id()), "texts")
    texts = table.select("row", F.col(f"c{own.index(text_col)}").alias("text"))
    seen = stored(texts.mapInArrow(_occurrences, "key long, row long, n long"), "keys")
    shared = seen.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key")
    # Stored, so that the shuffles of the keys are gone when the texts are shuffled.
    listed = stored(attach_marks(seen.select("key", "row"), shared, ["key"])
                    .groupBy("row").agg(F.collect_list("key").alias("keys")), "listed")
    discard(seen)
    del seen, shared
    columns = [c.split()[0] for c in PASSAGE.split(", ")]
    passages = stored(texts.join(listed, "row").select("row", "text", "keys").mapInArrow(_passages, PASSAGE), "passages")
    discard(listed)
    del listed
    marks, read = [], []
    for width in (*CLASSES[1:], None):
        # Equal passages under a key have equal offsets.
        held = stored(passages.groupBy("key", "digest", "passage").agg(F.sum(F.size("starts")).alias("copies")), "distinct")
        # Bytes are in ``held`` from here on, places without them in ``places``.
        places = stored(passages.drop("passage"), "places")
        discard(passages)
        sizes = held.groupBy("key").agg(F.sum(F.octet_length("passage")).alias("bytes"), F.count("*").alias("kinds")) \
            .where("kinds > 1")
        hot = F.col("bytes") > HOT_BYTES if width else F.lit(False)
        keys = stored(sizes.withColumn("hot", hot), "sizes")
        total = keys.where("NOT hot").agg(F.sum("bytes")).first()[0] or 0
        hot_keys, shards = keys.where("hot").select("key"), total // SHARD_BYTES + 1
        more = not hot_keys.isEmpty()
        dealt = held.join(hot_keys, "key", "left_anti") if more else held
        shard = F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")
        # As many tasks as shards: sorting takes far longer than what a shard's size suggests.
        marked = dealt.withColumn("shard", shard).repartition(shards, "shard").sortWithinPartitions("shard", "key") \
            .mapInArrow(_sort, "key long, digest binary, spans array<struct<first:int,end:int>>")
        spans = stored(marked.withColumn("spans", F.explode("spans")), "spans")
        del dealt, marked
        met = attach_marks(places.select("key", "digest", "row", "starts"), spans, ["key", "digest"])
        marks.append(met.select("row", F.explode("starts").alias("at"), "spans.first", "spans.end").select(
            "row", (F.col("at") + F.col("first")).alias("start"), (F.col("at") + F.col("end") + WINDOW - 1).alias("stop")))
        if more:
            again = attach_marks(places, held.join(hot_keys, "key", "left_semi").select("key", "digest", "passage"), ["key", "digest"])
            passages = stored(again.select(*columns).mapInArrow(_cut(width), PASSAGE), "passages")
        discard(held)
        read += [places, keys, spans]
        if not more:
            break
    cuts = stored(functools.reduce(DataFrame.unionAll, marks).groupBy("row").agg(
        F.collect_list(F.struct("start", "stop")).alias("cuts")), "cuts")
    for gone in read:
        discard(gone)
    del marks, read, places, keys, spans, met, held, passages, sizes, hot_keys
    free(spark)
    both = table.join(cuts, "row", "left").select(*inner.columns, "cuts").toDF(*own, free_name(own, "cuts"))
    out = add_columns(both, {"n_bytes": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType(),
                             "kept_bytes": T.BinaryType()}, _remove, text_col, both.columns[-1])
    return out.drop(both.columns[-1])
