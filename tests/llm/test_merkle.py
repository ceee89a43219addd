"""The manifest against a Merkle tree in plain Python."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F, types as T

from rillmart.llm import merkle
from tests.llm.helpers import ODD

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("leaf", T.StringType()),
                       T.StructField("a.b", T.IntegerType())])
COLUMNS = ("doc_id", "lang", "text")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    """(root, siblings of every leaf as (side, digest), from the leaf up)."""
    nodes, where, proofs = list(nodes), list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for k, at in enumerate(where):
            other = at ^ 1
            if other < len(nodes):
                proofs[k].append(("l" if at & 1 else "r", nodes[other]))
        nodes = [digest(*nodes[k:k + 2]) for k in range(0, len(nodes), 2)]
        where = [at // 2 for at in where]
    return nodes[0], proofs


def brute(rows):
    """(doc_id, leaf, subroot, root, digest of the proof) of each (doc_id, text, lang)."""
    trees = defaultdict(list)
    for i, t, lang in rows:
        trees[lang].append((i, leaf(i, lang, t)))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    grown = {}
    for name in names:
        ordered = sorted(trees[name], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        grown[name] = ordered, climb([d for _, d in ordered])
    root, above = climb([grown[n][1][0] for n in names])
    return sorted(((i, d, grown[n][1][0], root, digest(*[h for _, h in own + over]))
                   for n, over in zip(names, above) for (i, d), own in zip(grown[n][0], grown[n][1][1])), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)


def proved(docs, **more):
    made = merkle.manifest(docs, columns=COLUMNS, **more)
    return made.withColumn("proof", merkle.proof_digest(F.col("path"))).withColumn(
        "folded", merkle.fold(F.col("leaf"), F.col("sides"), F.col("path")))


@pytest.mark.parametrize("block_levels", [1, 2, 9])
def test_manifest(spark, monkeypatch, block_levels):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", block_levels)
    langs = [None, "", "=", "en", "é", "日本"]
    rows = [(i, t, langs[k % 4]) for k, (i, t) in enumerate(ODD)]
    rows += [(i, f"text {i}", "en" if i % 3 else langs[i % 6]) for i in range(100, 190)]
    out = proved(table(spark, rows)).collect()
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof) for r in out), key=repr) == brute(rows)
    assert all(r.folded == r.root for r in out)
    assert sorted((r.lang or "~", r.place) for r in out) == sorted(
        (lang or "~", k) for lang in langs for k in range(sum(r[2] == lang for r in rows)))


@pytest.mark.parametrize("rows", [[(1, "a", "en")], [(1, "a", "en"), (2, None, None)], [(k, "a", None) for k in range(5)]])
def test_small_trees(spark, rows):
    out = proved(table(spark, rows)).collect()
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof) for r in out), key=repr) == brute(rows)
    assert all(r.folded == r.root for r in out)


def test_a_changed_row_fails(spark):
    docs = table(spark, [(k, f"t{k}", "en") for k in range(20)])
    forged = merkle.leaf_digest(F.col("doc_id"), F.col("lang"), F.concat("text", F.lit("!")))
    out = merkle.manifest(docs, columns=COLUMNS, carry={
        "forged": F.when(F.col("doc_id") % 4 == 0, forged), "leaf": F.lit(0)})
    assert out.columns[:5] == ["doc_id", "lang", "forged", "leaf", "_leaf"]
    wrong = out.where("forged IS NOT NULL").withColumn(
        "folded", merkle.fold(F.col("forged"), F.col("sides"), F.col("path")))
    assert wrong.count() == 5 and wrong.where("folded = root").count() == 0


def test_empty_table(spark):
    assert proved(table(spark, [])).count() == 0
