"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, decoding.

Pre-tokenisation uses no regular expression.  Every code point has a class (letter, number, white
space, plain space, apostrophe, other); class, a one-character look ahead and the length of a
contraction that would start there make up an input symbol.  Each symbol is a function from state
to state of a small automaton, functions compose associatively, and all compositions form a finite
table, so a scan over function numbers finds the state after every character: first inside rows of
fixed width, all rows at once, then over the rows' totals.  A state says whether its character
starts a piece.  The slices go to pair merging, which remembers pieces it has merged.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .common import add_columns, texts_of, worker_cache

MAX_VOCABULARY_BYTES = 64 << 20   # what is broadcast: a vocabulary, never data
CACHED_PIECES, CACHED_LENGTH = 300_000, 64
STRETCH = 1 << 20                 # characters scanned together
SHORT_PIECE = 48                  # bytes up to which pairs are searched one after another
ROW = 64

# Classes of code points.
LETTER, NUMBER, WHITE, SPACE, APOSTROPHE, OTHER = range(6)
# White_Space of the Unicode character database.  Fixed values.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
               0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Letters after an apostrophe that make a piece of their own.  Fixed values.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

# States: what the character belongs to, and whether a piece starts at it.
_KINDS = ("letter", "number", "other", "white", "lead", "short", "short2", "short3")
# letter, number, other: inside such a run.  white: in a run of white space whose next character
# may still belong to it.  lead: a plain space that joins the run after it.  short: at the
# apostrophe of a contraction; short2, short3: with one or two letters of it still to come.
STATES = [(k, starts) for k in _KINDS for starts in (False, True)]
START = len(STATES)               # before a text


def code_classes() -> np.ndarray:
    """The class of each code point, from the Unicode character database."""
    out = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        category = unicodedata.category(chr(code))[0]
        if category == "L":
            out[code] = LETTER
        elif category == "N":
            out[code] = NUMBER
    out[WHITE_SPACE] = WHITE
    out[0x20], out[0x27] = SPACE, APOSTROPHE
    return out


def _step(state: int, cls: int, white_next: bool, short: int) -> int:
    """The state at a character of class ``cls`` after ``state``.

    white_next: whether white space or the text's end follows.  short: letters of a contraction
    that would start at this apostrophe.
    """
    kind = STATES[state][0] if state < START else "none"
    index = {s: i for i, s in enumerate(STATES)}
    if kind in ("short2", "short3"):
        # Letters of a contraction: one or two are left.
        return index["short2" if kind == "short3" else "short", False]
    if cls in (WHITE, SPACE):
        # The last white character before other text stands alone or leads that text.
        last = not white_next
        inside = kind == "white"
        if last:
            return index["lead" if cls == SPACE else "short", True]
        return index["white", not inside]
    run = {LETTER: "letter", NUMBER: "number"}.get(cls, "other")
    if kind == "lead" or kind == run:
        return index[run, False]
    if cls == APOSTROPHE and short:
        return index["short3" if short == 2 else "short2", True]
    return index[run, True]


def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(function of each symbol, composition table, state after START by function, identity).

    A symbol is class + 6 * (white space or end follows) + 12 * contraction letters.
    """
    n = START + 1
    reset = tuple([START] * n)      # between texts
    symbols = [tuple([_step(s, k % 6, k // 6 % 2 == 1, k // 12) for s in range(n)])
               for k in range(36)] + [reset]
    number = {tuple(range(n)): 0}
    todo = list(number)
    for f in symbols:
        if f not in number:
            number[f] = len(number)
            todo.append(f)
    generators = list(dict.fromkeys(symbols))
    while todo:
        f = todo.pop()
        for g in generators:
            h = tuple(g[s] for s in f)
            if h not in number:
                number[h] = len(number)
                todo.append(h)
    functions = list(number)
    table = np.zeros((len(functions), len(functions)), np.uint16)
    for i, f in enumerate(functions):
        for j, g in enumerate(functions):
            table[i, j] = number[tuple(g[s] for s in f)]
    return (np.array([number[s] for s in symbols], np.uint16), table,
            np.array([f[START] for f in functions], np.uint8), 0)


def scan(functions: np.ndarray, compose: np.ndarray, identity: int) -> np.ndarray:
    """Inclusive scan: the composition of all functions up to each place."""
    n = len(functions)
    if n <= ROW:
        out, acc = np.empty(n, functions.dtype), identity
        for i in range(n):
            acc = compose[acc, functions[i]]
            out[i] = acc
        return out
    rows = -(-n // ROW)
    cells = np.full(rows * ROW, identity, functions.dtype)
    cells[:n] = functions
    cells = np.ascontiguousarray(cells.reshape(rows, ROW).T)
    width = compose.shape[1]
    flat = compose.ravel()
    for k in range(1, ROW):
        cells[k] = flat[cells[k - 1].astype(np.intp) * width + cells[k]]
    before = np.full(rows, identity, functions.dtype)
    before[1:] = scan(cells[-1].copy(), compose, identity)[:-1]
    cells = flat[before.astype(np.intp)[None, :] * width + cells]
    return cells.T.ravel()[:n]


def piece_starts(texts: list[str], classes: np.ndarray, machine) -> tuple[np.ndarray, np.ndarray]:
    """(piece starts, text starts) in code points of the joined texts, each text followed by one
    separator, which starts a piece of its own."""
    symbol, compose, state, identity = machine
    sizes = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer("\n".join(texts + [""]).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum(sizes + 1) - 1
    cls = classes[codes]
    white = (cls == WHITE) | (cls == SPACE)
    follows = np.ones(len(codes), np.uint8)      # the separator is white, as is the end
    follows[:-1] = white[1:]
    number = cls + 6 * follows
    at = np.flatnonzero(cls == APOSTROPHE)
    if len(at):
        padded = np.concatenate([codes, np.zeros(2, codes.dtype)])
        one, two = padded[at + 1], padded[at + 2]
        length = np.zeros(len(at), np.uint8)
        for c in CONTRACTIONS:
            hit = one == ord(c[0])
            if len(c) == 2:
                hit &= two == ord(c[1])
            length[hit & (length == 0)] = len(c)
        number[at] += 12 * length
    number[ends] = 36
    states = state[scan(symbol[number], compose, identity)]
    starts = (states % 2 == 1) & (states < START)
    starts[ends] = True
    return np.flatnonzero(starts), ends - sizes


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of a token's bytes, a space, its id, on each line."""
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError("the vocabulary is larger than what may be broadcast")
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Token ids of one piece: the pair of lowest rank is joined until none is left."""
    found = ranks.get(piece)
    if found is not None:
        return (found,)
    return _merge_short(piece, ranks) if len(piece) <= SHORT_PIECE else _merge_long(piece, ranks)


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    rank, none = ranks.get, 1 << 40
    ends = list(range(len(piece) + 1))
    pairs = [rank(piece[i:i + 2], none) for i in range(len(piece) - 1)]
    while pairs:
        least = min(pairs)
        if least == none:
            break
        i = pairs.index(least)
        del ends[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = rank(piece[ends[i]:ends[i + 2]], none)
        if i:
            pairs[i - 1] = rank(piece[ends[i - 1]:ends[i + 1]], none)
    return tuple([ranks[piece[a:b]] for a, b in zip(ends, ends[1:])])


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Neighbours form a linked list and candidate pairs a heap: n log n."""
    n = len(piece)
    end, prev, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i]:
            continue
        j = end[i]
        if j >= n or end[j] != stop:
            continue
        alive[j] = False
        end[i] = stop
        if stop < n:
            prev[stop] = i
            r = ranks.get(piece[i:end[stop]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := prev[i]) >= 0:
            r = ranks.get(piece[p:stop])
            if r is not None:
                heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return tuple(out)


def encode_texts(texts: list[str], ranks, classes, machine, cache: dict) -> list[tuple[list, list]]:
    """For each text (ids, places of its pieces in code points, tokens of each piece)."""
    out, part, size = [], [], 0
    for text in texts:
        if part and size + len(text) > STRETCH:
            out += _encode_part(part, ranks, classes, machine, cache)
            part, size = [], 0
        part.append(text)
        size += len(text)
    return out + _encode_part(part, ranks, classes, machine, cache) if part else out


def _encode_part(texts: list[str], ranks, classes, machine, cache: dict) -> list[tuple[list, list]]:
    starts, begins = piece_starts(texts, classes, machine)
    joined = "\n".join(texts + [""])
    places = starts.tolist()
    pieces = [joined[a:b] for a, b in zip(places, places[1:] + [len(joined)])]
    first = np.searchsorted(starts, begins).tolist() + [len(places)]
    out = []
    for k in range(len(texts)):
        a, b = first[k], first[k + 1] - 1        # the last piece is the separator
        ids, counts = [], []
        for piece in pieces[a:b]:
            got = cache.get(piece)
            if got is None:
                got = merge(piece.encode("utf-8", "surrogatepass"), ranks)
                if len(piece) <= CACHED_LENGTH:
                    if len(cache) >= CACHED_PIECES:
                        cache.clear()
                    cache[piece] = got
            ids += got
            counts.append(len(got))
        out.append((ids, starts[a:b] - begins[k], np.array(counts, np.int32)))
    return out


def _int_lists(rows: list) -> pa.Array:
    sizes = np.cumsum([0] + [len(r) for r in rows]).astype(np.int32)
    flat = np.concatenate([np.asarray(r, np.int32) for r in rows]) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat, pa.int32()))


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", offsets: bool = True) -> DataFrame:
    """``docs`` with ``token_ids`` and, if wanted, ``piece_starts`` and ``piece_tokens``.

    Every whole text is encoded without special tokens; null counts as empty, an empty text has no
    ids.  ``piece_starts`` are code points in the text, ``piece_tokens`` the tokens of each piece.
    New columns whose names are taken get underscores in front.
    """
    sc = docs.sparkSession.sparkContext
    ranks = load_ranks(vocabulary)
    parts = sc.broadcast((ranks, code_classes(), automaton()))
    key = f"bpe-{hash(frozenset(ranks.items()))}"      # what pieces were merged to depends on it
    names = ["token_ids", "piece_starts", "piece_tokens"] if offsets else ["token_ids"]

    def compute(columns):
        ranks, classes, machine = parts.value
        cache = worker_cache(key)
        for (column,) in columns:
            texts = [t.decode("utf-8", "surrogatepass") for t in texts_of(column)]
            coded = encode_texts(texts, ranks, classes, machine, cache)
            yield [_int_lists([c[k] for c in coded]) for k in range(len(names))]

    return add_columns(docs, dict.fromkeys(names, T.ArrayType(T.IntegerType())), compute, text_col, cache=key)


def encode_decode(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` and ``decoded``, by one worker: ``decode`` of ``encode``."""
    ranks = load_ranks(vocabulary)
    parts = docs.sparkSession.sparkContext.broadcast((ranks, code_classes(), automaton()))
    key = f"bpe-{hash(frozenset(ranks.items()))}"

    def compute(columns):
        ranks, classes, machine = parts.value
        cache, token = worker_cache(key), {i: t for t, i in ranks.items()}
        for (column,) in columns:
            texts = [t.decode("utf-8", "surrogatepass") for t in texts_of(column)]
            coded = [c[0] for c in encode_texts(texts, ranks, classes, machine, cache)]
            yield [_int_lists(coded), pa.array([decode_ids(ids, token) for ids in coded], pa.binary())]

    return add_columns(docs, {"token_ids": T.ArrayType(T.IntegerType()), "decoded": T.BinaryType()},
                       compute, text_col, cache=key)


def decode_ids(ids: list[int], token: dict[int, bytes]) -> bytes:
    return b"".join([token[i] for i in ids])


def decode(coded: DataFrame, vocabulary: str, ids_col: str = "token_ids") -> DataFrame:
    """``coded`` with ``decoded``, the bytes of the ids; null ids give no bytes."""
    sc = coded.sparkSession.sparkContext
    words = sc.broadcast({i: t for t, i in load_ranks(vocabulary).items()})

    def compute(columns):
        token = words.value
        for (column,) in columns:
            yield [pa.array([decode_ids(ids or [], token) for ids in column.to_pylist()], pa.binary())]

    return add_columns(coded, {"decoded": T.BinaryType()}, compute, ids_col)
