"""Token ids in binary files: frequency ranks, byte-aligned lengths, separate control bytes.

Ids are replaced by their rank in the corpus, most frequent first, so common ids need one byte.
Four ranks share a control byte with two bits each: a rank's bytes less one.  Control bytes and
data bytes are stored apart, so that a reader looks up the lengths of four ranks at once in a table
and gathers all data with numpy, without a loop over ids.

A file set is a folder of three Parquet tables, so that it can live in any store Spark writes to:
``ranks`` (rank, id, tokens), ``blocks`` (part, before, doc_id, n_tokens, control, data) and
``parts`` (part, first): a document's ids start at ``first + before``.  Part numbers, and places
within a part, ascend with doc_id.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import discard, free, stored, texts_of, worker_cache

END_ID = 1
MAX_VOCABULARY_BYTES = 64 << 20
CACHED_WORDS = 900_000
# Between runs that are encoded together; each run has its own piece of text, and this is one, too.
PARTER, TOGETHER = "\x01", 32


def _among(*places: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(b"".join(places))] = True
    return table


SPACE = _among(b" \t\n\r\x0b\x0c")
SIGN = _among(bytes(range(0x21, 0x27)), bytes(range(0x28, 0x30)), b":;<=>?@[\\]^_`{|}~")
PLAIN = _among(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
# Second bytes of Latin-1 letters.
LATIN = _among(bytes(range(0x80, 0x97)), bytes(range(0x98, 0xb7)), bytes(range(0xb8, 0xc0)))

# Bytes of each of the four ranks under a control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 16- or 32-bit ranks."""
    width = 2 if ranks.dtype.itemsize <= 2 else 4
    ranks = ranks.astype(f"<u{width}", copy=False)
    used = np.ones((len(ranks), width), bool)
    for k in range(1, width):
        used[:, k] = ranks > (1 << 8 * k) - 1
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    for k in range(1, width):
        codes[:len(ranks)] += used[:, k]
    control = codes[::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, width)[used].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks of ``pack``."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    start = np.cumsum(size, dtype=np.int64) - size
    padded = np.frombuffer(data + bytes(4), np.uint8)
    out = padded[start].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(size > k)
        if not len(longer):
            break
        out[longer] |= padded[start[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _load(path: str) -> bytes:
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError("the tokenizer is larger than what may be broadcast")
    return data


def split_runs(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The runs of characters between white space, and where each text's runs begin and the last one's end.
    Signs at the end of a run that follow a digit or Latin-1 letter are a run of their own."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sign, inside = SIGN[data], ~SPACE[data]
    turns = np.flatnonzero(sign[1:] != sign[:-1]) + 1
    starts, ends = (turns[1::2], turns[2::2]) if sign[0] else (turns[::2], turns[1::2])
    before = data[starts - 1]
    last = ~inside[ends] & (PLAIN[before] | (LATIN[before] & (data[starts - 2] == 0xC3)))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[starts[last]] = True
    stops = inside & np.append(begins[1:] | ~inside[1:], True)
    begin = np.flatnonzero(begins)
    offsets = np.append(0, np.cumsum(np.flatnonzero(stops) + 1 - begin))
    runs = pa.Array.from_buffers(pa.large_binary(), len(begin),
                                 [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[inside])])
    places = np.cumsum([0] + [len(t) + 1 for t in texts])
    return runs, np.searchsorted(begin, places)


def _coded(runs: list[bytes], tokenizer, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all runs, one after another, and how many each has."""
    parter = tokenizer.encode(PARTER, add_special_tokens=False).ids
    mark, end = PARTER.encode(), f" {PARTER} ".encode()
    joined = len(parter) == 1 and not any(mark in r for r in runs)
    if joined:
        lines = [end.join(runs[k:k + TOGETHER]).decode("utf-8", "replace") for k in range(0, len(runs), TOGETHER)]
        coded = tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        flat = np.array([i for c in coded for i in (*c.ids, parter[0])], kind)
        at = np.flatnonzero(flat == parter[0])
        if len(at) == len(runs):
            return np.delete(flat, at), np.diff(at, prepend=-1) - 1
    coded = tokenizer.encode_batch_fast([r.decode("utf-8", "replace") for r in runs], add_special_tokens=False)
    return np.array([i for c in coded for i in c.ids], kind), np.array([len(c) for c in coded], np.int64)


def encode_texts(texts: list[bytes], tokenizer, cache: dict, kind: str) -> list[bytes]:
    """Ids of each text, as integers of ``kind``: those the tokenizer gives for the whole text.

    The tokenizer composes characters, folds case, drops white space, and never joins across white
    space or from a letter or digit to other signs than an apostrophe.  So it is given each distinct
    run of characters once, without its last signs, and what it said is remembered.  Runs of ASCII
    alone that differ in case share what it said, unless folding would make an added token; others go
    to it as they are, since a letter and a mark may compose in one case only.  A few runs are given to it
    together, with a control character between them.  A text that holds one of the tokenizer's added
    tokens is given to it whole.
    """
    if not texts:
        return []
    added = [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()]
    whole = {k: np.array(tokenizer.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids, kind).tobytes()
             for k, t in enumerate(texts) if any(a in t for a in added)}
    runs, firsts = split_runs([b"" if k in whole else t for k, t in enumerate(texts)])
    met = runs.dictionary_encode()
    words, met = met.dictionary.to_numpy(zero_copy_only=False).tolist(), met.indices.to_numpy()
    rows = cache.setdefault("rows", {})
    row = list(map(rows.get, words))
    missing = [w for w, r in zip(words, row) if r is None]
    if not rows or len(rows) + len(missing) > CACHED_WORDS:
        rows.clear()                          # beyond what is remembered: from this batch on
        cache.update(ids=np.zeros(0, kind), sizes=np.zeros(0, np.int64))
        missing, row = words, [None] * len(words)
    folded = [w.lower() if w.isascii() else w for w in missing]
    if any(a in b"\n".join(folded) for a in added):
        folded = [w if any(a in f for a in added) else f for w, f in zip(missing, folded)]
    fresh = [f for f in dict.fromkeys(folded) if f not in rows]
    found = [_coded(fresh[k:k + 8192], tokenizer, kind) for k in range(0, len(fresh), 8192)]
    rows.update(zip(fresh, range(len(cache["sizes"]), len(cache["sizes"]) + len(fresh))))
    known = [rows[f] for f in folded]
    rows.update(zip(missing, known))
    for name, parts in zip(("ids", "sizes"), zip(*found)):
        cache[name] = np.concatenate([cache[name], *parts])
    late = iter(known)
    row = np.array([next(late) if r is None else r for r in row], np.int64)
    begin = np.cumsum(cache["sizes"]) - cache["sizes"]
    sizes, begin = cache["sizes"][row][met], begin[row][met]
    ends = np.append(0, np.cumsum(sizes))
    ids = cache["ids"][np.repeat(begin - ends[:-1], sizes) + np.arange(ends[-1])]
    cuts = ends[firsts].tolist()
    return [whole[k] if k in whole else ids[a:b].tobytes() for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def tokenize(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
             end_id: int = END_ID) -> DataFrame:
    """(part, before, doc_id, n_tokens, ids) in ascending id order, ``end_id`` after each text.

    ``ids`` are little-endian unsigned 16- or 32-bit integers, by the vocabulary's size.  Null texts
    count as empty, null ids come first; rows that repeat an id follow each other.  Document ids
    are integers, or texts of such.  Added tokens that stand in a text get their own id, as the
    library has it.  Only these two columns are read.
    """
    spark = docs.sparkSession
    data = _load(tokenizer_path)
    model, key = spark.sparkContext.broadcast(data), zlib.crc32(data)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, F.asc_nulls_first("doc_id")) \
        .sortWithinPartitions(F.asc_nulls_first("doc_id")).withColumn("part", F.spark_partition_id())

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark runs a task on each core
        from tokenizers import Tokenizer

        held = worker_cache("tokenfile")
        if held.get("model") != key:
            held.update(model=key, tokenizer=Tokenizer.from_buffer(model.value), words={})
        tokenizer = held["tokenizer"]
        kind = "<u2" if max(tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
        end, width, before = np.array([end_id], kind).tobytes(), int(kind[2]), 0
        for batch in batches:
            ids = [i + end for i in encode_texts(texts_of(batch.column(1)), tokenizer, held["words"], kind)]
            sizes = [len(i) // width for i in ids]
            starts = before + np.cumsum([0] + sizes)
            before = int(starts[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array(starts[:-1], pa.int64()), batch.column(0),
                 pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
                ["part", "before", "doc_id", "n_tokens", "ids"])

    return ordered.mapInArrow(run, "part int, before long, doc_id long, n_tokens long, ids binary")


def _raw(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4")


def frequencies(tokens: DataFrame) -> DataFrame:
    """(id, tokens) of all ids of ``tokenize``; a task sends one row for each id it has met."""
    def run(batches):
        counts = np.zeros(0, np.int64)
        for batch in batches:
            ids = _raw(b"".join(batch.column(1).to_pylist()), sum(batch.column(0).to_pylist()))
            found = np.bincount(ids, minlength=len(counts))
            found[:len(counts)] += counts
            counts = found
        ids = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(counts[ids], pa.int64())],
                                         ["id", "tokens"])

    return tokens.select("n_tokens", "ids").mapInArrow(run, "id long, tokens long") \
        .groupBy("id").agg(F.sum("tokens").alias("tokens"))


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, **options) -> None:
    """Tokenize ``docs`` and write the file set below ``path``.  See ``tokenize`` for the rows."""
    spark = docs.sparkSession
    tokens = stored(tokenize(docs, tokenizer_path, **options), "token-ids")
    # Vocabularies and part numbers are bounded: these go through the driver.
    counted = [(r["id"], r["tokens"]) for r in frequencies(tokens).collect()]
    counted.sort(key=lambda r: (-r[1], r[0]))
    size = max((i for i, _ in counted), default=-1) + 1
    rank = np.zeros(size, np.uint16 if len(counted) <= 1 << 16 else np.uint32)
    rank[[i for i, _ in counted]] = np.arange(len(counted))
    ranks = spark.sparkContext.broadcast(rank)
    spark.createDataFrame([(k, i, n) for k, (i, n) in enumerate(counted)], "rank long, id long, tokens long") \
        .coalesce(1).write.parquet(f"{path}/ranks")
    totals = sorted((r["part"], r["n"]) for r in
                    tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    firsts = np.cumsum([0] + [n for _, n in totals]).tolist()
    spark.createDataFrame([(p, f) for (p, _), f in zip(totals, firsts)], "part int, first long") \
        .coalesce(1).write.parquet(f"{path}/parts")

    def code(batches):
        table = ranks.value
        for batch in batches:
            packed = [pack(table[_raw(ids, n)]) for n, ids in
                      zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:4] + [pa.array([p[k] for p in packed], pa.binary()) for k in (0, 1)],
                ["part", "before", "doc_id", "n_tokens", "control", "data"])

    tokens.mapInArrow(code, "part int, before long, doc_id long, n_tokens long, control binary, data binary") \
        .write.option("compression", "zstd").parquet(f"{path}/blocks")
    discard(tokens)
    free(spark)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of a file set; ``ids`` are little-endian unsigned 32-bit."""
    names = spark.read.schema("rank long, id long, tokens long").parquet(f"{path}/ranks")
    ids_by_rank = np.array([r["id"] for r in names.orderBy("rank").collect()], "<u4")
    table = spark.sparkContext.broadcast(ids_by_rank)
    blocks = spark.read.schema("part int, before long, doc_id long, n_tokens long, control binary, data binary") \
        .parquet(f"{path}/blocks")
    first = spark.read.schema("part int, first long").parquet(f"{path}/parts")

    def run(batches):
        ids = table.value
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array([ids[unpack(c, d, n)].tobytes() for n, c, d in rows], pa.binary())],
                ["doc_id", "start", "n_tokens", "ids"])

    placed = blocks.join(first, "part").select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "control", "data")
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
