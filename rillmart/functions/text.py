"""Word segmentation and its table function."""

from __future__ import annotations

import itertools
import unicodedata
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rillmart.session import ship_with_tasks

ship_with_tasks(__name__)

# A run of letters and digits of alphabetic scripts ...
ALPHABETIC = r"[\p{L}\p{N}&&[^\p{IsHan}]]+"
# ... or one Chinese character; with a dictionary, a whole run of them.
WORD = ALPHABETIC + r"|\p{IsHan}"
RUN = ALPHABETIC + r"|\p{IsHan}+"


def words(text: Column) -> Column:
    """Lower-case words in order, repeats kept.  Runs inside the JVM."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


MAX_LIST_BYTES = 64 << 20
CUT_CHARS = 1 << 20


class WordTrie:
    """A word list as a trie in sorted arrays, walked from all places of a text at once.

    An edge's key is state * symbols + symbol, where symbols are numbered by their order; looking
    up the edges of all places that are still on a path is one binary search.
    """

    def __init__(self, words: Iterable[str]):
        listed = sorted({w for w in words if w})
        self.symbols = np.unique(_codes("".join(listed)))
        states, edges, self.longest = {"": 0}, {}, max(map(len, listed), default=0)
        for word in listed:
            for end in range(1, len(word) + 1):
                if word[:end] not in states:
                    states[word[:end]] = len(states)
                    edges[states[word[:end - 1]], word[end - 1]] = states[word[:end]]
        known = dict(zip(map(chr, self.symbols.tolist()), range(len(self.symbols))))
        found = sorted((s * len(known) + known[c], into) for (s, c), into in edges.items())
        self.keys = np.array([k for k, _ in found], np.int64)
        self.into = np.array([i for _, i in found], np.int64)
        self.is_word = np.zeros(len(states), bool)
        self.is_word[[states[w] for w in listed]] = True

    def longest_at(self, codes: np.ndarray) -> np.ndarray:
        """The length of the longest word that starts at each place, 0 if none does."""
        out = np.zeros(len(codes), np.int64)
        if not len(self.keys) or not len(codes):
            return out
        number = np.minimum(np.searchsorted(self.symbols, codes), len(self.symbols) - 1)
        number = np.where(self.symbols[number] == codes, number, -1)
        places, state = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        for length in range(1, self.longest + 1):
            inside = places + length <= len(codes)
            places, state = places[inside], state[inside]
            symbol = number[places + length - 1]
            key = state * len(self.symbols) + symbol
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = (symbol >= 0) & (self.keys[edge] == key)
            places, state = places[on], self.into[edge[on]]
            if not len(places):
                break
            ended = self.is_word[state]
            out[places[ended]] = length
        return out

    def cut_runs(self, runs: Sequence[str], chars: int = CUT_CHARS) -> Iterator[list[tuple[int, int]]]:
        """Spans of listed words in each run of letters.  Runs are walked through together, about
        ``chars`` characters at a time, so that the arrays are bounded."""
        first = 0
        while first < len(runs):
            last, held = first, 0
            while last < len(runs) and (last == first or held < chars):
                held += len(runs[last]) + 1
                last += 1
            # Runs hold letters and digits only, so a line end parts them.
            spans, at, start = list(self.cut("\n".join(runs[first:last]))), 0, 0
            for run in runs[first:last]:
                end, found = start + len(run), []
                while at < len(spans) and spans[at][0] < end:
                    found.append((spans[at][0] - start, spans[at][1] - start))
                    at += 1
                yield found
                start = end + 1
            first = last

    def cut(self, text: str) -> Iterator[tuple[int, int]]:
        """(start, end) of the longest listed words, left to right, none overlapping."""
        length, end = self.longest_at(_codes(text)), 0
        for at in np.flatnonzero(length).tolist():
            if at >= end:
                end = at + int(length[at])
                yield at, end


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def word_list(words: DataFrame, limit: int = MAX_LIST_BYTES) -> list[str]:
    """The distinct words of a one-column table, which must not be larger than ``limit`` bytes."""
    column = F.lower(F.col(words.columns[0])).alias("word")
    distinct = words.select(column).where("word <> ''").distinct()
    size = distinct.agg(F.sum(F.octet_length("word"))).first()[0] or 0
    if size > limit:
        raise ValueError(f"the word list has {size} bytes, more than {limit}")
    return sorted(r.word for r in distinct.collect())


def dictionary_words(text: Column, dictionary: Sequence[str], everywhere: bool = False) -> Column:
    """Like ``words``, but a run of Chinese characters is cut into the longest listed words, left to
    right; a character no word starts with stands alone.

    ``everywhere`` cuts runs of other letters too; what lies between their listed words stands
    as it is.  The list goes to the executors once, as a broadcast trie, so it is bounded by
    ``MAX_LIST_BYTES``.  The texts of an Arrow batch are walked through together.
    """
    size = sum(len(w.encode()) for w in dictionary)
    if size > MAX_LIST_BYTES:
        raise ValueError(f"the word list has {size} bytes, more than {MAX_LIST_BYTES}")
    context = SparkSession.getActiveSession().sparkContext
    # Plain arrays, since a broadcast class would have to be importable on the executors.
    fields = context.broadcast(vars(WordTrie(w.lower() for w in dictionary)))

    @F.pandas_udf("array<string>")
    def cut(batch: pd.Series) -> pd.Series:
        trie = WordTrie(())
        vars(trie).update(fields.value)
        runs = [run for listed in batch if listed is not None for run in listed]
        pieces = map(_pieces, runs, trie.cut_runs(runs), itertools.repeat(everywhere))
        return batch.map(lambda listed: None if listed is None else [w for _ in listed for w in next(pieces)])

    return cut(F.regexp_extract_all(F.lower(text), F.lit(RUN), F.lit(0)))


def _is_han(c: str) -> bool:
    """The script of ``\\p{IsHan}``: ideographs of all planes and the signs used with them."""
    return unicodedata.name(c, "").startswith(("CJK UNIFIED", "CJK COMPATIBILITY IDEOGRAPH", "CJK RADICAL",
                                               "KANGXI RADICAL")) or c in "\u3005\u3007"


def _pieces(run: str, found: list[tuple[int, int]], everywhere: bool) -> list[str]:
    """A run as its listed words and what lies between them."""
    han = _is_han(run[0])
    if not han and not everywhere:
        return [run]
    out, last = [], 0
    for start, end in [*found, (len(run), len(run))]:
        between = run[last:start]
        out += between if han else [between] if between else []
        out += [run[start:end]] if end > start else []
        last = end
    return out


def explode_words(df: DataFrame, text: str, word: str = "keyword",
                  dictionary: Sequence[str] | None = None, everywhere: bool = False) -> DataFrame:
    """One row per word: the lateral join with the segmenter."""
    tokens = dictionary_words(F.col(text), dictionary, everywhere) if dictionary else words(F.col(text))
    return df.select(*[c for c in df.columns if c != text], F.explode(tokens).alias(word))


def register_words(spark: SparkSession, name: str = "segment_words") -> None:
    """Make the segmenter callable from SQL:
    ``SELECT w.word FROM t, LATERAL segment_words(t.text) w``."""
    pattern = WORD.replace("\\", "\\\\")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(body STRING) "
              f"RETURNS TABLE(word STRING) RETURN "
              f"SELECT explode(regexp_extract_all(lower(body), '{pattern}', 0))")
