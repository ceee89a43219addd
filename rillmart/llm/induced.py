"""External induced sorting of the suffixes of a text, with the length of common prefixes.

The order of the suffixes that stand at the left end of a descent's rise (leftmost S) fixes all
others: an L suffix is induced by the one behind it in ascending order, an S suffix in descending
order.  Both passes take tuples (symbol, position, common prefix) from a priority queue.  Symbols are
cut into ranges of about ``RANGE`` tuples; the queue holds a range's tuples in the order they were
pushed, in memory or, beyond ``memory`` bytes, in a file, and only the range that is being taken out
is sorted.  Tuples are taken in batches: as many as are certain to come before anything they induce.

The order of the leftmost S suffixes comes from recursion: the ranks of the pieces of text between
them form a text of at most half the length, whose suffixes are sorted in the same way.  The prefixes that neighbouring seeds have in common are compared once; the
passes carry them on: what two suffixes share is one symbol more than their successors share, and
that is the least value met between those, which is kept for each symbol that may come in front.

Texts, orders and queues of more than ``memory`` bytes live in unnamed temporary files, which the
system takes away with the process.
"""

from __future__ import annotations

import tempfile

import numpy as np

RANGE = 8192
# A reduced text of so few symbols is sorted in memory (some 50 MB), which ends the recursion.  A shard
# of text is reduced to a third, so its first reduced text is the last one.
BASE = 1 << 20
MEMORY = 256 << 20
# Columns of a tuple; in the front, the last one tells induced (0) from given (1) tuples.
POSITION, SYMBOL, COMMON, GIVEN = range(4)


class Store:
    """Arrays in memory, or in unnamed files when they are large."""

    def __init__(self, memory: int = MEMORY):
        self.memory = memory

    def array(self, n: int, dtype) -> np.ndarray:
        if n * np.dtype(dtype).itemsize <= self.memory:
            return np.zeros(n, dtype)
        with tempfile.TemporaryFile() as file:
            return np.memmap(file, dtype, "w+", shape=(n,))


class Queue:
    """A priority queue of tuples by symbol, and by order of arrival among equal symbols."""

    def __init__(self, cuts: np.ndarray, memory: int):
        # Range r holds the symbols from cuts[r] to cuts[r + 1].
        self.cuts, self.memory = cuts, memory
        self.parts: list[list] = [[] for _ in range(len(cuts))]
        self.held, self.file = 0, None

    def range_of(self, symbols: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.cuts, symbols, "right") - 1

    def push(self, tuples: np.ndarray) -> None:
        if not len(tuples):
            return
        into = self.range_of(tuples[:, SYMBOL])
        order = np.argsort(into, kind="stable")
        into, tuples = into[order], tuples[order]
        starts = np.flatnonzero(np.concatenate([[True], into[1:] != into[:-1]]))
        stops = np.append(starts[1:], len(into))
        for r, a, b in zip(into[starts].tolist(), starts.tolist(), stops.tolist()):
            self.parts[r].append(tuples[a:b])
        self.held += tuples.nbytes
        if self.held > self.memory:
            self.spill()

    def spill(self) -> None:
        """Move the tuples to the file; a part is then (offset, count)."""
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for parts in self.parts:
            kept = [p for p in parts if isinstance(p, tuple)]
            fresh = [p for p in parts if not isinstance(p, tuple)]
            if fresh:
                kept.append((self.file.tell(), sum(map(len, fresh))))
                for p in fresh:
                    self.file.write(np.ascontiguousarray(p).data)
            parts[:] = kept
        self.held = 0

    def take(self, r: int):
        """The parts of range ``r``, in order of arrival."""
        parts, self.parts[r] = self.parts[r], []
        for part in parts:
            if isinstance(part, tuple):
                self.file.seek(part[0])
                yield np.frombuffer(self.file.read(part[1] * 24), np.int64).reshape(-1, 3)
            else:
                self.held -= part.nbytes
                yield part

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Text:
    """Symbols that end with a 0 which is nowhere else."""

    def __init__(self, symbols: np.ndarray, store: Store):
        self.symbols, self.store, self.size = symbols, store, int(symbols.max()) + 1
        self.rising = self._rising()

    def __len__(self) -> int:
        return len(self.symbols)

    def _rising(self) -> np.ndarray:
        """True where a suffix is less than the one behind it (S); the last one counts as S."""
        text, step = self.symbols, 1 << 20
        rising = self.store.array(len(text), bool)
        rising[-1] = True
        for stop in range(len(text) - 1, 0, -step):
            start = max(stop - step, 0)
            here, behind = text[start:stop], text[start + 1:stop + 1]
            # A symbol that is followed by itself has the type of that one.
            at = np.where(here != behind, np.arange(len(here)), len(here))
            at = np.minimum.accumulate(at[::-1])[::-1]
            rising[start:stop] = np.append(here < behind, rising[stop])[at]
        return rising

    def seeds(self) -> np.ndarray:
        """Positions of the leftmost S suffixes."""
        return np.flatnonzero(self.rising[1:] & ~self.rising[:-1]) + 1

    def keys(self, at: np.ndarray, down: bool) -> np.ndarray:
        """The symbols at some positions, so that they ascend in the order of a pass."""
        found = self.symbols[at].astype(np.int64)
        return self.size - 1 - found if down else found

    def common_prefix(self, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
        """How many symbols the suffixes at ``a`` and ``b``, two others each, share, up to ``limit``."""
        text, wide = self.symbols, 8 // self.symbols.itemsize
        words = np.ndarray((max(len(text) - wide + 1, 0),), "<u8", buffer=text.data, strides=(text.itemsize,))
        out = np.full(len(a), limit, np.int64)
        pairs, k = np.arange(len(a)), 0
        while k < limit and len(pairs):
            left, right = a[pairs] + k, b[pairs] + k
            near_end = np.maximum(left, right) >= len(words)
            for j in np.flatnonzero(near_end):
                m = 0
                while text[left[j] + m] == text[right[j] + m]:
                    m += 1
                out[pairs[j]] = min(k + m, limit)
            pairs, left, right = pairs[~near_end], left[~near_end], right[~near_end]
            x = words[left] ^ words[right]
            low, differ = x & (~x + np.uint64(1)), x != 0
            same = np.log2(low[differ].astype(np.float64)).astype(np.int64) // (8 * text.itemsize)
            out[pairs[differ]] = np.minimum(k + same, limit)
            pairs, k = pairs[~differ], k + wide
        return out


class Carry:
    """For each symbol, the least common prefix since the last tuple that this symbol stood before."""

    def __init__(self, symbols: int, limit: int):
        self.least, self.limit = np.zeros(symbols, np.int64), limit

    def over(self, shared: np.ndarray, induced: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The common prefix of each induced suffix with the one before it of the same symbol.
        ``shared``: that of each tuple taken with the one before; ``induced``: those that induce."""
        out = np.zeros(len(induced), np.int64)
        before, self.least = self.least, np.minimum(self.least, shared.min())
        order = np.argsort(symbols, kind="stable")
        ends = np.flatnonzero(np.diff(symbols[order])) + 1
        for mine in np.split(order, ends) if len(order) else ():
            symbol, cuts = symbols[mine[0]], np.concatenate([[0], induced[mine] + 1])
            open_end = cuts[-1] < len(shared)
            least = np.minimum.reduceat(shared, cuts if open_end else cuts[:-1])
            least[0] = min(least[0], before[symbol])
            out[mine] = np.minimum(least[:len(mine)] + 1, self.limit)
            self.least[symbol] = least[-1] if open_end else self.limit
        return out


def induce(text: Text, given: np.ndarray, down: bool, given_common: np.ndarray | None = None, limit: int = 0):
    """One pass: the positions it induces, in its order, what each shares with the one before it,
    and pairs of an induced and a given position that share ``limit`` symbols.

    Upwards, L suffixes are induced from the given leftmost S ones and from each other; downwards, S
    suffixes from the given L ones and from each other.  Without ``given_common`` nothing is carried.
    """
    size, rising, store = text.size, text.rising, text.store
    counts = np.bincount(text.symbols, minlength=size)
    full = np.cumsum(counts[::-1] if down else counts) // RANGE
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(full)) + 1])
    bounds = np.append(cuts, size)
    edges = np.searchsorted(text.keys(given, down), bounds)
    carried = None if given_common is None else Carry(size, limit)
    total = len(text) - len(given) if down else len(text) - int(np.count_nonzero(rising))
    out, shares = store.array(total, np.int64), store.array(0 if carried is None else total, np.int16)
    done, last, met = 0, np.array([[-1, -1, 0, 0]]), []
    queue = Queue(cuts, store.memory)
    if down:
        queue.push(np.array([[len(text) - 1, size - 1, 0]]))
    for r in range(len(cuts)):
        mine = np.zeros((edges[r + 1] - edges[r], 4), np.int64)
        mine[:, POSITION] = given[edges[r]:edges[r + 1]]
        mine[:, SYMBOL], mine[:, GIVEN] = text.keys(mine[:, POSITION], down), 1
        if carried:
            mine[:, COMMON] = given_common[edges[r]:edges[r + 1]]
        queued = np.concatenate([np.zeros((0, 3), np.int64), *queue.take(r)])
        front = _merged([np.column_stack([queued, np.zeros(len(queued), np.int64)]), mine])
        while len(front):
            at, here = front[:, POSITION], front[:, SYMBOL]
            ahead = text.keys(np.maximum(at - 1, 0), down)
            induces = (at > 0) & (rising[np.maximum(at - 1, 0)] == down)
            # What is induced comes behind the induced tuples of its symbol and before the given ones.
            bound = np.minimum.accumulate(np.concatenate([[size], np.where(induces, ahead, size)[:-1]]))
            unsafe = here + front[:, GIVEN] > bound
            n = int(unsafe.argmax()) if unsafe.any() else len(front)
            batch, front = front[:n], front[n:]
            where, own = np.flatnonzero(induces[:n]), batch[:, GIVEN] == 0
            fresh = np.zeros((len(where), 4), np.int64)
            fresh[:, POSITION], fresh[:, SYMBOL] = at[where] - 1, ahead[where]
            count = int(np.count_nonzero(own))
            out[done:done + count] = at[:n][own]
            if carried:
                before = np.concatenate([last, batch[:-1]])
                alike = batch[:, SYMBOL] == before[:, SYMBOL]
                shared = np.where(alike, batch[:, COMMON], 0)
                # Nothing has been carried between the induced and the given tuples of a symbol.
                for m in np.flatnonzero(alike & (batch[:, GIVEN] != before[:, GIVEN])):
                    pair = batch[m:m + 1, POSITION], before[m:m + 1, POSITION]
                    shared[m] = text.common_prefix(*pair, limit)[0]
                    if shared[m] == limit:
                        met += [pair[0][0], pair[1][0]]
                fresh[:, COMMON] = carried.over(shared, where, fresh[:, SYMBOL])
                shares[done:done + count] = shared[own]
                last = batch[-1:]
            done += count
            stays = fresh[:, SYMBOL] < bounds[r + 1]
            queue.push(fresh[~stays, :GIVEN])
            if stays.any():
                front = _merged([front, fresh[stays]])
    queue.close()
    return out, shares, np.array(met, np.int64)


def _merged(parts: list[np.ndarray]) -> np.ndarray:
    """Tuples by symbol, induced before given ones, else in the order they come in."""
    front = np.concatenate(parts)
    return front[np.argsort(2 * front[:, SYMBOL] + front[:, GIVEN], kind="stable")]


def piece_names(text: Text, seeds: np.ndarray) -> np.ndarray:
    """The rank of each piece of text from a seed up to the next one, equal pieces with equal ranks.

    Pieces are compared a word of symbols at a time.  Behind its end a piece counts as greater than
    any symbol: where one piece begins with another, the longer one goes on with an L symbol.
    """
    symbols, wide = text.symbols, 8 if text.symbols.dtype == np.uint8 and text.size < 256 else 1
    length = np.append(np.diff(seeds) + 1, 1)
    names, k = np.zeros(len(seeds), np.int64), 0
    while True:
        left = length - k
        if wide == 8:
            words = np.ndarray((len(symbols),), ">u8", buffer=np.append(symbols, np.zeros(8, np.uint8)).data, strides=(1,))
            word = words[np.minimum(seeds + k, len(symbols) - 1)].astype(np.uint64)
            beyond = np.clip(8 - left, 0, 8).astype(np.uint64) * np.uint64(8)
            word |= np.where(beyond >= 64, ~np.uint64(0), (np.uint64(1) << np.minimum(beyond, 63)) - np.uint64(1))
        else:
            word = np.where(left > 0, symbols[np.minimum(seeds + k, len(symbols) - 1)].astype(np.int64), text.size)
        order = np.lexsort((word, names))
        fresh = (np.diff(names[order]) != 0) | (word[order][1:] != word[order][:-1])
        names[order] = np.concatenate([[0], np.cumsum(fresh)])
        k += wide
        # Pieces that differ from all others, or have ended, need no further word.
        same = np.bincount(names)[names] > 1
        if not (same & (length > k)).any():
            return names


def seed_order(text: Text) -> np.ndarray:
    """The leftmost S positions in the order of their suffixes."""
    seeds = text.seeds()
    names = piece_names(text, seeds)
    if names.max() + 1 == len(seeds):
        return seeds[np.argsort(names)]
    reduced = text.store.array(len(seeds), np.int64)
    reduced[:] = names
    return seeds[suffix_order(Text(reduced, text.store))]


def doubled_order(symbols: np.ndarray) -> np.ndarray:
    """All positions in the order of their suffixes, by ranks of 1, 2, 4, ... symbols."""
    n, reach = len(symbols), 0
    rank = np.append(symbols.astype(np.int64) + 1, 0)
    while True:
        # Without ``reach``, by the symbols alone.
        key = rank[:-1] * (n + 2) + rank[np.minimum(np.arange(n) + reach, n)] if reach else rank[:-1].copy()
        order = np.argsort(key, kind="stable")
        rank[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)]) + 1
        if rank[order[-1]] == n:
            return order
        reach = 2 * reach or 1


def suffix_order(text: Text) -> np.ndarray:
    """All positions in the order of their suffixes."""
    if len(text) <= BASE:
        return doubled_order(text.symbols)
    falling, _, _ = induce(text, seed_order(text), False)
    rising, _, _ = induce(text, falling[::-1], True)
    both = np.concatenate([falling, rising[::-1]])
    kinds = np.repeat([0, 1], [len(falling), len(rising)])
    return both[np.argsort(2 * text.symbols[both].astype(np.int64) + kinds, kind="stable")]


def recurring(symbols: np.ndarray, length: int, memory: int = MEMORY) -> np.ndarray:
    """True at each position where ``length`` symbols start that start somewhere else too.
    ``symbols`` ends with a 0 that is nowhere else."""
    store = Store(memory)
    text, found = Text(symbols, store), store.array(len(symbols), bool)
    if len(text) <= length:
        return found
    seeds = seed_order(text)
    common = np.append(0, text.common_prefix(seeds[1:], seeds[:-1], length))
    falling, shared, _ = induce(text, seeds, False, common, length)
    common = np.append(0, shared[:0:-1])
    rising, also, met = induce(text, falling[::-1], True, common, length)
    for order, same in ((falling, shared), (rising, also)):
        hits = np.flatnonzero(same >= length)
        found[order[hits]] = found[order[hits - 1]] = True
    found[met] = True
    return found
