"""SimHash and its links against all pairs."""

import random

import xxhash

from rillmart.llm import simhash
from rillmart.llm.components import components
from tests.llm.helpers import EMPTY, ODD, docs


def plain(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + 3]) for i in range(max(len(w) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin((rows[i][1] ^ rows[j][1]) & (1 << 64) - 1).count("1") <= 3:
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    ids = lambda r: [rows[k][0] for k in range(len(rows)) if root[k] == r and rows[k][0] is not None]
    return [min(ids(r), default=None) for r in root]


def test_fingerprints(spark):
    for r in simhash.fingerprints(docs(spark, ODD)).collect():
        assert r.simhash & (1 << 64) - 1 == plain(r.text)


def test_links_are_those_of_all_pairs(spark, monkeypatch):
    rng = random.Random(7)
    centres = [rng.getrandbits(64) for _ in range(12)]
    flip = lambda v, n: v ^ sum(1 << b for b in rng.sample(range(64), n))
    values = centres + [flip(rng.choice(centres), rng.randint(0, 5)) for _ in range(150)] + [0, 7, 15]
    rows = [(k, v - (1 << 64) if v >> 63 else v) for k, v in enumerate(values)] + [(None, 0), (None, 1 << 40), (162, 0)]
    table = spark.createDataFrame(rows, "doc_id long, simhash long")
    for tile in (1024, 4):
        monkeypatch.setattr(simhash, "TILE", tile)
        out = simhash.near_duplicates(table).collect()
        got = sorted((r.simhash, r.doc_id or 0, r.component_id if r.component_id is not None else -1) for r in out)
        want = [c if c is not None else -1 for c in brute(rows)]
        assert got == sorted((v, i or 0, c) for (i, v), c in zip(rows, want))
        kept = [r.component_id for r in out if r.kept]
        assert len(kept) == len(set(kept)) == len(set(want))


def test_rows_that_stay(spark):
    out = simhash.drop_near_duplicates(docs(spark, ODD))
    assert out.columns == docs(spark, ODD).columns
    assert {r.doc_id for r in out.collect()} >= {1, 4, 11, 12}
    assert simhash.drop_near_duplicates(docs(spark, EMPTY)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(5, 5), (100, 101), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}
