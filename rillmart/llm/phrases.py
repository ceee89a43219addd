"""Substring dedup by repeated-phrase automata.

A window is 50 consecutive words.  Windows are looked for in four steps, none of which compares
pairs of documents or gathers a phrase's documents:

1. Anchors.  Among the ten-word phrases of each window the one with the least hash is its anchor.
   Equal windows have equal anchors, and a text has about one anchor for twenty words.  Anchors of
   a single document are dropped.
2. Recurring windows.  Windows under the other anchors are counted by hash: a partial aggregate
   finds each window's first document (least id), and windows of one document are dropped.
3. Automata.  The first documents supply the words of the recurring passages.  Passages go to
   shards by anchor; a shard compiles an Aho-Corasick automaton over phrases of half a window, each
   known by a pair of characters that stands for its exact words, so a window is a path of four.
4. Search.  All passages of all documents that hold such an anchor stream through the automaton of
   their shard, which reports every occurrence and its first document.  A hot anchor has several
   automata: its windows are dealt out by hash, and a document's passage goes to the parts that may
   hold one of its windows; if a part still meets too many documents, it is copied for groups of them.

Words are removed where a reported window's first document has a smaller id.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from rillmart.operators.joins import attach_marks

from .common import add_columns, discard, free, free_name, stored, texts_of

WINDOW, PHRASE = 50, 10       # words of a window, of an anchor
HALF = WINDOW // 2
SHARD_WINDOWS = 20_000        # recurring windows of one anchor under one automaton, about
SALT_ROWS = 5_000             # documents of one anchor under one automaton, about
REACH = WINDOW - PHRASE + 1   # windows that an anchor at one place can have
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(WINDOW)], np.uint64)


def _hashes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each phrase, hash of each window)."""
    from xxhash import xxh3_64_intdigest

    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        n = len(h) - PHRASE + 1
        phrase = sum(h[j:j + n] * _POWERS[j] for j in range(PHRASE))
        n = len(h) - WINDOW + 1
        window = sum(phrase[j:j + n] * _POWERS[j] for j in range(0, WINDOW, PHRASE))
        # Products of one multiplier keep some order; mix before taking least values.
        phrase = (phrase ^ (phrase >> np.uint64(29))) * _MULTIPLIER
        window = (window ^ (window >> np.uint64(29))) * _MULTIPLIER
    return phrase.view(np.int64), window.view(np.int64)


def anchors(words: list[bytes]):
    """(anchor hash, first and last window) of each run of windows with one anchor, window hashes.

    Empty for a text of fewer words than a window.
    """
    if len(words) < WINDOW:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    phrase, window = _hashes(words)
    place = np.empty(len(window), np.int64)
    for k in range(0, len(window), 1 << 15):
        part = np.lib.stride_tricks.sliding_window_view(phrase[k:k + (1 << 15) + REACH - 1], REACH)
        place[k:k + len(part)] = np.argmin(part, axis=1) + np.arange(k, k + len(part))
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([first[1:], [len(place)]]) - 1
    return phrase[place[first]], first, last, window


def _wanted(words: list[bytes], listed: list[int]):
    """Runs of windows under the listed anchors: (place in the list, first, last), window hashes."""
    found, first, last, window = anchors(words)
    places = {a: k for k, a in enumerate(listed)}
    return [(places[a], f, l) for a, f, l in zip(found.tolist(), first.tolist(), last.tolist())
            if a in places], window


def _occurrences(batches):
    for batch in batches:
        ids, found = [], []
        for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
            a = np.unique(anchors(text.split())[0])
            ids.append(np.full(len(a), doc, np.int64))
            found.append(a)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x), pa.int64()) for x in (found, ids)], ["anchor", "id"])


def _windows(batches):
    for batch in batches:
        ids, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for doc, text, listed in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)),
                                     batch.column(2).to_pylist()):
            runs, window = _wanted(text.split(), listed)
            if runs:
                of = np.unique(np.concatenate([window[f:l + 1] for _, f, l in runs]))
                found.append(of)
                ids.append(np.full(len(of), doc, np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x), pa.int64()) for x in (found, ids)], ["window", "id"])


PASSAGE = "anchor long, part int, stream boolean, row long, id long, words binary, places array<int>"


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()))
    names = [c.split()[0] for c in PASSAGE.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names)


def _patterns(batches):
    """A first document's different passages, with the places of windows that recur."""
    for batch in batches:
        out = []
        for doc, text, listed, recurring in zip(
                batch.column(0).to_pylist(), texts_of(batch.column(1)),
                *(batch.column(k).to_pylist() for k in (2, 3))):
            words = text.split()
            runs, window = _wanted(words, listed)
            recurs = np.isin(window, np.array(recurring, np.int64))
            passages = {}
            for k, f, l in runs:
                marked = np.flatnonzero(recurs[f:l + 1])
                if len(marked):
                    passages[b" ".join(words[f:l + WINDOW])] = k, marked.tolist()
            out += [(listed[k], 0, False, None, doc, passage, marked) for passage, (k, marked) in passages.items()]
        yield _rows(out)


def _streams(batches):
    """Every document's different passages, with the places where each stands."""
    for batch in batches:
        out = []
        for row, doc, text, listed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                          texts_of(batch.column(2)), batch.column(3).to_pylist()):
            words = text.split()
            passages = {}
            for k, f, l in _wanted(words, listed)[0]:
                passages.setdefault(b" ".join(words[f:l + WINDOW]), (k, []))[1].append(f)
            out += [(listed[k], 0, True, row, doc, passage, places) for passage, (k, places) in passages.items()]
        yield _rows(out)


def _deal(batches):
    """Passages of anchors with several parts, once for each part that may hold one of their windows.

    A window's part follows from its hash.  Other rows pass as they are.
    """
    for batch in batches:
        parts = batch.column("parts")
        split = pc.greater(parts, 1)
        yield batch.filter(pc.invert(split))
        out = []
        for r in batch.filter(split).to_pylist():
            part = _hashes(r["words"].split())[1] % r["parts"]
            for p in np.unique(part if r["stream"] else part[r["places"]]).tolist():
                places = r["places"] if r["stream"] else [k for k in r["places"] if part[k] == p]
                out.append({**r, "part": p, "places": places})
        if out:
            yield pa.RecordBatch.from_pylist(out, batch.schema)


def _phrases(passage: bytes) -> list[bytes]:
    ends = np.flatnonzero(np.frombuffer(passage + b" ", np.uint8) == 32).tolist()
    return [passage[a:b] for a, b in zip([0] + [e + 1 for e in ends], ends[HALF - 1:])]


class Shard:
    """The passages of one shard and, once documents come, their automaton.

    The library looks through a node's edges one by one, so phrases are not numbered by one symbol
    each, which would give the root an edge for every window, but by a pair: 256 second
    characters, and first ones from a range of their own, so that a match cannot start between them.
    """

    def __init__(self):
        self.names: dict[bytes, str] = {}
        self.first: dict[str, int] = {}
        self.automaton = None

    def _name(self, phrase: bytes) -> str:
        name = self.names.get(phrase)
        if name is None:
            high, low = divmod(len(self.names), 256)
            name = self.names[phrase] = chr(0x10000 + high) + chr(1 + low)
        return name

    def add(self, doc: int, passage: bytes, marked: list[int]) -> None:
        phrases = _phrases(passage)
        for at in marked:
            key = self._name(phrases[at]) + self._name(phrases[at + HALF])
            self.first[key] = min(doc, self.first.get(key, doc))

    def search(self, passage: bytes) -> list[tuple[int, int]]:
        """(window, its first document) for every occurrence of a recurring window."""
        import ahocorasick

        if not self.first:
            return []
        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for key, doc in self.first.items():
                self.automaton.add_word(key, doc)
            self.automaton.make_automaton()
        get = self.names.get
        names = [get(p, "\0\0") for p in _phrases(passage)]
        if len(names) - names.count("\0\0") < 2:
            return []
        # Every 25th phrase, from each of the first 25 on, as one text of equal stretches that end
        # with a name of no phrase.
        size = -(-len(names) // HALF) + 1
        names += ["\0\0"] * (HALF * size - len(names))
        text = "".join(itertools.chain.from_iterable(names[r::HALF] for r in range(HALF)))
        return [(end // 2 // size + HALF * (end // 2 % size - 1), doc) for end, doc in self.automaton.iter(text)]


def _search(batches):
    held, shard, last, found = None, Shard(), None, []
    for batch in batches:
        out = []
        for number, stream, row, doc, passage, places in zip(
                *(batch.column(c).to_pylist() for c in ("shard", "stream", "row", "id", "words", "places"))):
            if number != held:
                held, shard, last = number, Shard(), None
            if not stream:
                shard.add(doc, passage, places)
                continue
            if passage != last:               # equal passages follow each other
                last, found = passage, shard.search(passage)
            hits = sorted([w for w, first in found if first < doc])
            if hits:
                starts = [hits[0]] + [b for a, b in itertools.pairwise(hits) if b != a + 1]
                stops = [a for a, b in itertools.pairwise(hits) if b != a + 1] + [hits[-1]]
                out += [(row, at + a, at + b + WINDOW) for at in places for a, b in zip(starts, stops)]
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(3)],
                                         ["row", "start", "stop"])


def _remove(columns):
    for texts, spans in columns:
        n_words, n_removed, kept = [], [], []
        for text, cut in zip(texts_of(texts), spans.to_pylist()):
            words = text.split()
            gone = np.zeros(len(words), bool)
            for span in cut or ():
                gone[span["start"]:span["stop"]] = True
            n_words.append(len(words))
            n_removed.append(int(gone.sum()))
            kept.append(b" ".join(itertools.compress(words, ~gone) if n_removed[-1] else words))
        yield [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
               pa.array(kept, pa.binary()).cast(pa.string())]


def _hot(shared: DataFrame, patterns: DataFrame) -> DataFrame:
    """(anchor, parts, salts) of anchors that need more than one automaton.

    A part holds about ``SHARD_WINDOWS`` windows.  A passage goes to ``REACH`` parts at most, so
    with more of them each meets fewer documents and is copied less.
    """
    many = patterns.groupBy("anchor").agg(F.sum(F.size("places")).alias("windows")) \
        .where(F.col("windows") > SHARD_WINDOWS)
    both = shared.where(F.col("n") > SALT_ROWS).join(many, "anchor", "full")
    parts = F.ceil(F.coalesce("windows", F.lit(1)) / SHARD_WINDOWS).cast("int")
    met = F.coalesce("n", F.lit(1)) * F.least(parts, F.lit(REACH)) / parts
    return both.select("anchor", parts.alias("parts"), F.ceil(met / SALT_ROWS).cast("int").alias("salts"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``.

    A word goes if it lies in a window whose words also start a window in a document of smaller id;
    windows are judged on the texts as given.  Words are runs of anything but blank and ASCII white
    space; kept words are joined by one space.  Null texts have no words.  Ids are integers.  A row
    with a null id is not compared and stays whole; rows that repeat an id are each compared with
    smaller ids.  New columns whose names are taken get underscores in front.
    """
    own = docs.columns
    inner = docs.toDF(*[f"c{k}" for k in range(len(own))])
    key, text = (F.col(f"c{own.index(c)}") for c in (id_col, text_col))
    keyed = inner.select(key.cast("long").alias("id"), text.alias("text")).where("id IS NOT NULL")
    seen = stored(keyed.mapInArrow(_occurrences, "anchor long, id long"), "anchors")
    shared = seen.groupBy("anchor").agg(F.min("id").alias("a"), F.max("id").alias("b"),
                                        F.count("*").alias("n")).where("a < b")
    shared = stored(shared.select("anchor", "n"), "shared")
    held = attach_marks(seen, shared.select("anchor"), ["anchor"]).groupBy("id").agg(
        F.collect_list("anchor").alias("anchors"))
    rows = inner.withColumn("row", F.monotonically_increasing_id()) \
        .join(held, key.cast("long") == F.col("id"), "left").drop("id") \
        .withColumn("live", F.col("anchors").isNotNull())
    table = stored(rows, "phrases", by="live")
    discard(seen)
    del seen, held, rows
    live = table.where("live").select("row", key.cast("long").alias("id"), text.alias("text"), "anchors")

    windows = live.select("id", "text", "anchors").mapInArrow(_windows, "window long, id long")
    recurring = stored(windows.groupBy("window").agg(F.min("id").alias("first"), F.max("id").alias("last"))
                       .where("first < last").drop("last"), "windows")
    del windows
    free(docs.sparkSession)
    owners = recurring.groupBy(F.col("first").alias("id")).agg(F.collect_list("window").alias("windows"))
    patterns = stored(live.join(owners, "id").select("id", "text", "anchors", "windows")
                      .mapInArrow(_patterns, PASSAGE), "patterns")
    hot = stored(_hot(shared, patterns), "hot")
    streams = live.mapInArrow(_streams, PASSAGE)
    dealt = patterns.unionAll(streams).join(hot, "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    if not hot.where("parts > 1").isEmpty():
        dealt = dealt.mapInArrow(_deal, dealt.schema)
    salts = F.coalesce("salts", F.lit(1))
    salt = F.when(F.col("stream"), F.array(F.pmod("row", salts))).otherwise(F.sequence(F.lit(0), salts - 1).cast("array<long>"))
    dealt = dealt.withColumn("salt", F.explode(salt))
    shards = recurring.count() // SHARD_WINDOWS + int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.select("stream", "row", "id", "words", "places", F.pmod(
        F.xxhash64("anchor", "part", "salt"), F.lit(shards)).cast("int").alias("shard"))
    spans = dealt.repartition("shard").sortWithinPartitions("shard", "stream", "words") \
        .mapInArrow(_search, "row long, start long, stop long")
    cuts = stored(spans.groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("cuts")), "cuts")
    discard(patterns)
    del spans, dealt, streams, patterns, owners
    free(docs.sparkSession)
    cut = table.where("live").join(cuts, "row", "left")
    whole = table.where("NOT live").withColumn("cuts", F.lit(None).cast(cuts.schema["cuts"].dataType))
    columns = [*inner.columns, "cuts"]
    both = cut.select(*columns).unionAll(whole.select(*columns)).toDF(*own, free_name(own, "cuts"))
    out = add_columns(both, {"n_words": T.LongType(), "n_removed": T.LongType(), "kept_text": T.StringType()},
                      _remove, text_col, both.columns[-1])
    return out.drop(both.columns[-1])
