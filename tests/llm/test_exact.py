"""Exact dedup against a plain grouping in Python."""

from collections import defaultdict

from pyspark.sql import functions as F

from rillmart.llm import exact
from tests.llm.helpers import EMPTY, ODD, docs

A = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_groups_keep_the_largest_id(spark):
    table = docs(spark, ODD)
    out = exact.duplicate_groups(table, first_width=2)
    assert out.columns == [*table.columns, "keep_id", "group_size", "_kept"]
    want = defaultdict(list)
    for i, t in ODD:
        want[(t or "").translate(A)].append(i)
    rows = out.select("doc_id", "text", "keep_id", "group_size", F.col("_kept").alias("stays")).collect()
    assert len(rows) == len(ODD)
    stays = defaultdict(int)
    for r in rows:
        ids = want[(r.text or "").translate(A)]
        best = max((i for i in ids if i is not None), default=None)
        assert (r.keep_id, r.group_size) == (best, len(ids))
        stays[(r.text or "").translate(A)] += r.stays
        assert not r.stays or r.doc_id == best
    assert set(stays.values()) == {1}


def test_dropping_keeps_columns(spark):
    out = exact.drop_duplicates(docs(spark, ODD))
    assert out.columns == docs(spark, ODD).columns
    assert out.count() == len({(t or "").translate(A) for _, t in ODD})


def test_empty_table(spark):
    assert exact.duplicate_groups(docs(spark, EMPTY)).count() == 0


def test_a_hot_group_is_joined_from_fresh_shuffles(spark):
    rows = [(i, "the same text over and over" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    out = exact.duplicate_groups(docs(spark, rows)).where("keep_id = 2997")
    assert out.count() == 1000 and out.where("_kept").count() == 1
