"""Joins that carry marks, against the difference of two joins."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_stream_joins import T, change, line
from test_streaming import Feed

from rillmart import schemas
from rillmart.operators.joins import interval_join
from rillmart.plans import facts
from rillmart.session import shared_dir
from rillmart.sources import readers, sinks
from rillmart.streaming import jobs, store

MARKS = [(True, True), (True, False), (False, True)]


def made(spark, rng, n, shape):
    some = [(rng.choice([None, "a", "b", "hot", "hot"]), rng.choice([None, rng.randrange(8), rng.randrange(1500)]),
             T + rng.randrange(1500), *rng.choice(MARKS)) for _ in range(n)]
    key, value = shape
    return spark.createDataFrame(some, f"{key} string, {value} int, s bigint, _now boolean, _was boolean") \
        .withColumn("et", F.timestamp_seconds("s")).drop("s")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_marked_joins(spark, how):
    """Hot and null keys, rows of one moment, copies; two joins, one behind the other."""
    rng = random.Random(3)
    for n, lower, upper in ((150, -10, 10), (150, -30, 5), (60, -700, 20)):
        a, b, c = made(spark, rng, n, ("k", "x")), made(spark, rng, n, ("l", "y")), made(spark, rng, n, ("m", "z"))

        def plan(a, b, c):
            wide = interval_join(a, b, [("k", "l")], lower, upper, how)
            return interval_join(wide, c, [("k", "m")], lower, upper, how)
        got = plan(a, b, c)
        for mark in ("_now", "_was"):
            want = plan(*[d.where(mark).drop("_now", "_was") for d in (a, b, c)])
            assert want.count() and rows(got.where(mark).drop("_now", "_was").select(*want.columns)) == rows(want)
        assert got.where("NOT (_now OR _was)").isEmpty()


def test_only_rows_that_come_or_go_are_published(spark, tmp_path):
    """A marked plan is worked out once for a micro-batch, and what stays is neither compared nor shuffled for that."""
    feed, root = Feed(tmp_path / "in"), shared_dir(spark, "marked")
    batches = [[line("1", "o", T), line("1", "o", T), line("2", "o", T + 1), change("order_info", T, id="o", user_id="u")],
               [change("order_detail_coupon", T + 10, order_detail_id="1", coupon_id="c"), line("3", "p", T)],
               [change("order_detail_coupon", T + 10, order_detail_id="1", coupon_id="c"), change("order_info", T, id="p")], []]
    seen, calls = [], []

    def plan(log):
        calls.append("_now" in log.columns)
        return facts.published(facts.order_detail(log))
    for batch in batches:
        feed.send(*batch)
        log = readers.read_changelog(spark, feed.topic, delay=None).drop("pt")
        where = jobs.join_facts({"log": log}, plan, facts.REACH["order_detail"], "marked", root, marked=True)
        got, read = sinks.read_counted(spark, where), readers.read_changelog(spark, feed.topic, False)
        want = facts.published(facts.order_detail(read))
        assert rows(got.select(*schemas.ORDER_DETAIL)) == rows(want)
        seen.append(sorted((r["batch_id"], r.id, r.coupon_id or "", r["_count"]) for r in spark.read.parquet(where).collect()))
    assert seen[0] == [(0, "1", "", 1), (0, "1", "", 1), (0, "2", "", 1)]
    assert [r for r in seen[1] if r[0] == 1] == [(1, "1", "", -1)] * 2 + [(1, "1", "c", 1)] * 2
    assert [r for r in seen[2] if r[0] == 2] == [(2, "1", "c", 1)] * 2 + [(2, "3", "", 1)]
    assert all(calls) and len(calls) == len(batches)


def test_tables_that_take_nothing_back_are_not_compared(spark, tmp_path):
    table = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1)], "id string, _count bigint")
    table.write.parquet(f"{tmp_path}/t/batch_id=0")
    plan = sinks.read_counted(spark, f"{tmp_path}/t")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    assert rows(plan) == [("a",), ("a",), ("a",), ("b",)]
    spark.createDataFrame([("a", -2)], "id string, _count bigint").write.parquet(f"{tmp_path}/t/batch_id=1")
    assert rows(sinks.read_counted(spark, f"{tmp_path}/t")) == [("a",), ("b",)]


def test_large_parts_grow_by_folders(spark, tmp_path, monkeypatch):
    """A part that only grows is not written anew by every batch; its folders are bounded, and a batch can be run again."""
    monkeypatch.setattr(store, "SMALL", 0)
    monkeypatch.setattr(store, "FOLDERS", 3)
    held, folders = store.PartStore(spark, str(tmp_path / "s"), "v int, part int, bucket int", ["part", "bucket"]), []
    for n in range(8):
        for again in (False, True):
            held.clean(n)
            fresh = f"{tmp_path}/fresh"
            came = held.write(spark.createDataFrame([(n, 0, 0), (-n, 5, n)], "v int, part int, bucket int"), fresh, ["v"])
            assert came == {"part=0/bucket=0", f"part=5/bucket={n}"}
            held.add(n, fresh, came, {"n": n}, ["v"])
        index = held.index(n + 1)
        folders.append(1 + len(index["older"].get("part=0/bucket=0", [])))
        assert rows(held.read(n + 1, {"part=0/bucket=0"})) == [(k, 0, 0) for k in range(n + 1)]
        assert index["notes"] == {"n": n} and held.read(n + 1).count() == 2 * (n + 1)
    assert folders == [1, 2, 3, 1, 2, 3, 1, 2]
    held.replace(8, spark.createDataFrame([(9, 0, 0)], "v int, part int, bucket int"), {"part=0/bucket=0"})
    assert rows(held.read(9, {"part=0/bucket=0"})) == [(9, 0, 0)]
    held.replace(9, spark.createDataFrame([], "v int, part int, bucket int"), set(), expired=lambda p: p["part"] == "5")
    held.clean(10)
    held.clean(11)
    assert rows(held.read(10)) == [(9, 0, 0)]


def test_few_rows_taken_back(spark, tmp_path, monkeypatch):
    table = spark.createDataFrame([("a", 2), ("a", -1), ("b", 1), (None, 1), ("c", 1), ("c", -1), (None, 1)], "id string, _count bigint")
    table.write.parquet(f"{tmp_path}/t/batch_id=0")
    for few in (500, 1):
        monkeypatch.setattr(sinks, "FEW", few)
        assert rows(sinks.read_counted(spark, f"{tmp_path}/t")) == [("a",), ("b",), (None,), (None,)]
