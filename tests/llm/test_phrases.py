"""Repeated passages against a plain search."""

import random

from rillmart.llm import phrases
from tests.llm.helpers import EMPTY, ODD, docs


def brute(rows):
    seen, out = {}, []
    split = [(i, (t or "").split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - 49):
            if i is not None:
                key = tuple(w[k:k + 50])
                seen[key] = min(seen.get(key, i), i)
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if i is not None and seen[tuple(w[k:k + 50])] < i:
                gone[k:k + 50] = [True] * 50
        out.append((i if i is not None else -1, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out)


def test_same_as_brute_force(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choices("abcdefgh", k=n))
    passages = [text(n) for n in (49, 50, 51, 60, 75, 200)]
    rows = [(k, " ".join(x for _ in range(4) for x in (text(rng.randint(0, 40)), rng.choice(passages)) if x))
            for k in range(60)]
    rows += [(k + 100, rows[k][1]) for k in range(10)] + [(105, rows[3][1]), (106, text(100))] + ODD
    out = phrases.remove_repeats(docs(spark, rows))
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_removed, r.kept_text)
                 for r in out.collect())
    assert got == brute(rows)


def test_many_shards_for_one_anchor(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SALT_ROWS", 3)
    rng = random.Random(6)
    passage = " ".join(rng.choices("abcdefgh", k=55))
    rows = [(k, f"{' '.join(rng.choices('xyz', k=30))} {passage} {' '.join(rng.choices('xyz', k=30))}") for k in range(30)]
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in phrases.remove_repeats(docs(spark, rows)).collect())
    assert got == brute(rows)


def test_windows_of_a_hot_anchor_are_dealt_out(spark, monkeypatch):
    """One header over many different bodies that each have a copy: no shard holds all windows."""
    monkeypatch.setattr(phrases, "SHARD_WINDOWS", 40)
    monkeypatch.setattr(phrases, "SALT_ROWS", 7)
    rng = random.Random(7)
    text = lambda n: " ".join(rng.choices("abcdefgh", k=n))
    header = text(45)
    rows = [(k, f"{header} {body}") for j in range(20) for body in [text(60)] for k in (j, j + 50)]
    hot, parts = phrases._hot, []

    def noted(*tables):
        parts.extend(r.parts for r in hot(*tables).collect())
        return hot(*tables)

    monkeypatch.setattr(phrases, "_hot", noted)
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in phrases.remove_repeats(docs(spark, rows)).collect())
    assert got == brute(rows)
    assert max(parts) > 2


def test_parts_hold_each_window_once():
    import pyarrow as pa
    rng = random.Random(8)
    passage = " ".join(rng.choices("abcdefgh", k=90)).encode()
    schema = pa.schema([("anchor", pa.int64()), ("part", pa.int32()), ("stream", pa.bool_()), ("row", pa.int64()),
                        ("id", pa.int64()), ("words", pa.binary()), ("places", pa.list_(pa.int32())), ("parts", pa.int32())])
    row = dict(anchor=1, part=0, row=3, id=4, words=passage)
    rows = [{**row, "stream": False, "places": list(range(41)), "parts": 5}, {**row, "stream": True, "places": [7], "parts": 5},
            {**row, "stream": True, "places": [9], "parts": 1}]
    out = [r for b in phrases._deal([pa.RecordBatch.from_pylist(rows, schema)]) for r in b.to_pylist()]
    dealt = [r for r in out if not r["stream"]]
    assert sorted(p for r in dealt for p in r["places"]) == list(range(41)) and len(dealt) > 1
    assert {r["part"] for r in dealt} == {r["part"] for r in out if r["stream"] and r["parts"] == 5}
    assert [r for r in out if r["parts"] == 1] == rows[2:]


def test_a_passage_repeated_in_a_text_is_one_row(spark):
    text = ("over and again " * 400).encode()
    listed = phrases.anchors(text.split())[0].tolist()
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1]), pa.array([1]), pa.array([text]), pa.array([sorted(set(listed))])], list("abcd"))
    assert len(listed) > 100 and sum(b.num_rows for b in phrases._streams([batch])) < 60


def test_empty_table(spark):
    assert phrases.remove_repeats(docs(spark, EMPTY)).count() == 0
