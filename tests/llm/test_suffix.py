"""Byte-wise substring dedup against counting all windows in Python."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from rillmart.llm import induced, suffix
from tests.llm.helpers import EMPTY, ODD, docs

SF = "/root/testdata/sf0.001"


def brute(texts, window=suffix.WINDOW):
    """(bytes, removed, spans, kept) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + window] for r in raw for i in range(len(r) - window + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - window + 1):
            if seen[r[i:i + window]] > 1:
                gone[i:i + window] = b"\x01" * window
        spans = sum(g and not b for g, b in zip(gone, b"\0" + gone))
        out.append((len(r), sum(gone), spans, bytes(c for c, g in zip(r, gone) if not g)))
    return out


def check(spark, rows):
    table = docs(spark, rows)
    out = suffix.remove_repeats(table)
    assert out.columns == [*table.columns, "n_bytes", "n_removed", "n_spans", "kept_bytes"]
    got = [(r.doc_id, r.text, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in out.collect()]
    want = [(*r, *b) for r, b in zip(rows, brute([t for _, t in rows]))]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def texts(seed=2):
    """Texts that share passages of about a window's length, copies, and texts of few characters."""
    rnd = random.Random(seed)
    words = ["lorem", "ipsum", "é", "dolor", "日本", "x", "amet,"]

    def some(n):
        return " ".join(rnd.choice(words) + str(rnd.randrange(40)) for _ in range(n))
    shared = [some(n) for n in (30, 40, 60, 200)]
    out = [some(20) + rnd.choice(shared) + some(20) + rnd.choice(shared) for _ in range(60)]
    out += [shared[3]] * 20 + [shared[3] + "!", "?" + shared[3]]
    # One passage in many texts, between words of their own.
    out += [f"{k} " + shared[1][:230] + f" {k * k} tail" for k in range(40)]
    return out + ["ab" * 300, "a" * 199, "a" * 200, "a" * 201, "abc" * 70 + "x" + "abc" * 70]


def test_against_brute_force(spark):
    check(spark, list(enumerate(texts())))


def test_hot_keys_are_cut_again(spark, monkeypatch):
    """Every key counts as hot, down to single windows; shards of many sizes."""
    monkeypatch.setattr(suffix, "HOT_BYTES", 300)
    monkeypatch.setattr(suffix, "SHARD_BYTES", 5_000)
    check(spark, list(enumerate(texts(3))))


def test_odd_texts(spark):
    check(spark, [(i, t if t is None or len(t) < 9000 else t[:6000]) for i, t in ODD])


def test_texts_in_stretches(monkeypatch):
    """Texts hashed together, and long ones in stretches, have the runs they have alone."""
    rnd = random.Random(1)
    made = [bytes(rnd.randrange(256) for _ in range(n)) for n in (0, 250, 3, 3000, 199, 200, 650, 90, 701)]
    alone = [sorted(zip(*(c.tolist() for c in suffix.runs([t])[1:]))) for t in made]
    together = suffix.runs(made)
    for k in range(len(made)):
        mine = together[0] == k
        assert sorted(zip(*(c[mine].tolist() for c in together[1:]))) == alone[k]
    suffix._tables.cache_clear()
    monkeypatch.setattr(suffix, "STRETCH", 700)
    cut = suffix.runs(made)
    suffix._tables.cache_clear()
    for k, text in enumerate(made):
        mine = cut[0] == k
        windows = sorted(w for a, b in zip(cut[1][mine], cut[2][mine]) for w in range(a, b))
        assert windows == list(range(max(len(text) - suffix.WINDOW + 1, 0)))
        assert set(cut[4][mine].tolist()) == {r[3] for r in alone[k]}


def test_empty_table(spark):
    assert suffix.remove_repeats(docs(spark, EMPTY)).count() == 0


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, gone, spans, hashlib.sha256(kept).hexdigest())
            for (i, _), (n, gone, spans, kept) in zip(rows, brute([t for _, t in rows]))]
    got = entry.queries()["op13_suffix_dedup"](spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("tuples", [1, 7, 2048])
@pytest.mark.parametrize("memory", [0, 1 << 30])
@pytest.mark.parametrize("base", [1, 1 << 17])
def test_induced_sorting(monkeypatch, tuples, memory, base):
    """In memory and through files, with small and large ranges of symbols."""
    monkeypatch.setattr(induced, "RANGE", tuples)
    monkeypatch.setattr(induced, "BASE", base)
    rnd = random.Random(tuples)
    for _ in range(40):
        n, letters = rnd.randrange(1, 120), rnd.choice([1, 2, 3, 20, 250])
        text = [rnd.randrange(letters) + 1 for _ in range(n)]
        a, b = rnd.randrange(n), rnd.randrange(n)
        text[b:b + 40] = text[a:a + 40]
        raw = bytes(text) + b"\0"
        symbols = np.frombuffer(raw, np.uint8).astype(rnd.choice([np.uint8, np.uint16]))
        order = induced.suffix_order(induced.Text(symbols, induced.Store(memory)))
        assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        for length in (1, 3, 9):
            seen = Counter(raw[i:i + length] for i in range(len(raw) - length + 1))
            want = [i + length <= len(raw) and seen[raw[i:i + length]] > 1 for i in range(len(raw))]
            assert induced.recurring(symbols, length, memory).tolist() == want


def test_a_shard_is_induced_once(monkeypatch):
    """Passes over a reduced text, many small batches each, cost more than all else."""
    passes, induce = [], induced.induce
    monkeypatch.setattr(induced, "induce", lambda text, *rest: passes.append(len(text)) or induce(text, *rest))
    rnd = np.random.default_rng(5)
    symbols = np.append(rnd.integers(1, 40, suffix.SHARD_BYTES), 0).astype(np.uint8)
    symbols[-301:-1] = symbols[1000:1300]
    found = induced.recurring(symbols, suffix.WINDOW)
    n = len(symbols)
    assert np.flatnonzero(found).tolist() == [*range(1000, 1101), *range(n - 301, n - 200)]
    assert passes == [n, n]


def test_tables_no_later_step_reads_are_gone(spark, monkeypatch):
    """Of the tables a job stores, the texts and the cuts stay for the result."""
    made, store = [], suffix.stored

    def stored(df, name):
        made.append((name, store(df, name)))
        return made[-1][1]

    monkeypatch.setattr(suffix, "stored", stored)
    text = "".join(chr(97 + k * k % 23) + str(k) for k in range(120))
    out = suffix.remove_repeats(docs(spark, [(1, text), (2, "x" + text), (3, "short")]))
    assert {name for name, df in made if os.path.exists(df.stored_at.removeprefix("file:"))} == {"texts", "cuts"}
    assert sorted(r.n_removed for r in out.collect()) == [0, len(text), len(text)]
