"""Wu-Manber search against a plain one."""

import random
import re

import pytest

from rillmart.llm import decontam
from tests.llm.helpers import EMPTY, ODD, docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(text, items):
    w = words(text)
    hit, found = [False] * len(w), set()
    for item, t in items:
        v = words(t)
        n = min(13, len(v))
        for k in range(len(v) - n + 1) if v else ():
            for i in range(len(w) - n + 1):
                if w[i:i + n] == v[k:k + n]:
                    hit[i:i + n] = [True] * n
                    found.add(str(item) if item is not None else "")
    return len(w), sum(hit), sorted(found)


@pytest.mark.parametrize("shard_windows", [100_000, 40])
def test_same_as_brute_force(spark, shard_windows):
    rng = random.Random(4)
    vocabulary = ["a", "b", "c", "dé", "éa", "3", "ab", "ba"]
    text = lambda n: rng.choice([" ", ", ", "-"]).join(rng.choices(vocabulary, k=n))
    items = [(k, text(rng.randint(10, 30))) for k in range(6)]
    items += [(7, "b a"), (8, "Dé"), (9, None), (10, "--"), (None, "éa 3 ab"), (2, items[2][1]), (11, items[3][1])]
    rows = [(k, text(rng.randint(0, 120))) for k in range(40)]
    rows += [(100 + k, text(30) + " " + items[k][1].upper() + " " + text(20)) for k in range(6)] + ODD
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = decontam.mark(docs(spark, rows), benchmark, shard_windows=shard_windows)
    got = sorted((r.doc_id or -1, r.n_words, r.n_hit, list(r["items"])) for r in out.collect())
    assert got == sorted((i or -1, *brute(t, items)) for i, t in rows)


def test_dropping_and_empty_tables(spark):
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    table = docs(spark, [(1, "one two three"), (2, "clean text"), (3, None)])
    kept = decontam.drop_contaminated(table, benchmark)
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} == {2, 3}
    assert decontam.drop_contaminated(table, benchmark.limit(0)).count() == 3
    assert decontam.mark(docs(spark, EMPTY), benchmark).count() == 0
