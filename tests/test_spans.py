"""Micro-batches worked out in spans of time, and what they leave on disk."""

import datetime
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_stream_joins import T, change, line
from test_streaming import Feed

from rillmart import fixtures as fx, registry, schemas
from rillmart.plans import facts, trade
from rillmart.session import shared_dir
from rillmart.sources import readers, sinks
from rillmart.streaming import jobs


def test_time_is_cut_where_parts_are_large(monkeypatch):
    monkeypatch.setattr(jobs, "SPAN", 100)
    assert jobs.time_spans({}, 10, 1) == jobs.time_spans({3: 60, 4: 40}, 10, 1) == [(None, None)]
    assert jobs.time_spans({5: 50, 3: 60, 4: 40}, 10, 1) == [(None, 50), (50, None)]
    assert jobs.time_spans({-1: 10, 0: 400}, 100, 10) == [(None, 0), (0, 25), (25, 50), (50, 75), (75, None)]
    # No finer than twice the reach.
    assert jobs.time_spans({0: 10_000}, 100, 20) == [(None, 50), (50, None)]
    assert jobs.time_spans({0: 10_000}, 20, 20) == [(None, None)]


def cut(monkeypatch, spark):
    """Let every micro-batch be cut as finely as it may be; returns how many spans each had."""
    seen, whole = [], jobs.publish
    monkeypatch.setattr(jobs, "SPAN", 1)

    def publish(frames, where, batch_id):
        seen.append(1 if hasattr(frames, "write") else len(frames))
        whole(frames, where, batch_id)
    monkeypatch.setattr(jobs, "publish", publish)
    return seen


def test_facts_in_spans(spark, tmp_path, monkeypatch):
    """Lines and their orders, activities and coupons on both sides of cuts, and as far apart as they may be."""
    seen, feed, root = cut(monkeypatch, spark), Feed(tmp_path / "in"), shared_dir(spark, "spans")
    times = [T + 20 * k + d for k in range(6) for d in (0, 19)]
    batches = [[line(f"{t}-{k}", f"o{t}", t) for t in times for k in (1, 2)],
               [change("order_info", t + (10 if t % 3 else -10), id=f"o{t}", user_id="u") for t in times]
               + [change("order_detail_coupon", t + 10, order_detail_id=f"{t}-1", coupon_id="c") for t in times]
               + [change("order_detail_activity", t - 10, order_detail_id=f"{t}-2", activity_id="a") for t in times[::2]]]
    for batch in batches:
        feed.send(*batch)
        log = readers.read_changelog(spark, feed.topic, delay=None).drop("pt")
        where = jobs.join_facts({"log": log}, lambda log: registry.owned(facts.order_detail(log)), facts.REACH["order_detail"],
                                "spans", root, width=100, marked=True, spans=True)
        read = readers.read_changelog(spark, feed.topic, False)
        got, want = sinks.read_counted(spark, where), facts.published(facts.order_detail(read))
        assert rows(got.select(*schemas.ORDER_DETAIL)) == rows(want)
    assert max(seen) > 2 and got.columns == want.columns


def details(k, ts):
    return [{"id": str(k % 7), "order_id": f"o{k % 7}", "sku_id": f"s{k % 3}", "province_id": f"p{k % 2}", "sku_num": "1",
             "split_original_amount": str(k), "split_activity_amount": None, "split_coupon_amount": "1",
             "split_total_amount": str(2 * k), "ts": ts}]


@pytest.mark.parametrize("job", ["province", "clock"])
def test_windows_in_spans(spark, tmp_path, monkeypatch, job):
    """Repeats that follow within ten seconds, over cuts and window bounds; only what the windows read is stored."""
    seen, feed, root = cut(monkeypatch, spark), Feed(tmp_path / "in"), shared_dir(spark, "spans")
    for batch in [[r for k in range(n, 20, 2) for r in details(k, T + 9 * k + k % 4)] for n in (1, 0)]:
        feed.send(*batch)
        rows_in = readers.read_fact(spark, feed.topic, schemas.ORDER_DETAIL)
        read = readers.read_fact(spark, feed.topic, schemas.ORDER_DETAIL, False)
        where = (jobs.province_order if job == "province" else jobs.sku_order_by_clock)(rows_in, root=root, width=80)
        if job == "clock":
            got = spark.read.parquet(where).groupBy("sku_id").agg(*[F.sum(m).alias(m) for m in trade.SKU_MEASURES])
            net = trade.net_measures(read, ["sku_id"], trade.SKU_MEASURES, (), trade.REPEAT_TTL)
            want = net.groupBy("sku_id").agg(*[F.sum(m).alias(m) for m in trade.SKU_MEASURES])
            zero = lambda df: rows(df.na.fill(0).select("sku_id", *[F.col(m).cast("double") for m in trade.SKU_MEASURES]))
            assert zero(got) == zero(want)
            continue
        want = trade.province_windows(read, "10 seconds", (), trade.REPEAT_TTL)
        assert rows(sinks.read_counted(spark, where).select(*want.columns)) == rows(want)
    assert max(seen) > 1
    sides = f"{root}/moments/data/sides/data" if job == "clock" else where.replace("/facts", "/sides/data")
    stored = spark.read.parquet(sides).schema["detail"].dataType.names
    assert "sku_num" not in stored and "split_total_amount" in stored and ("order_id" in stored) == (job == "province")


def test_shuffles_go_when_an_action_ends(spark):
    def left():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
        names = set()
        while found.hasNext():
            names.add(found.next().getName())
        return {n for n in names if n.startswith("shuffle_")}
    registry.tune(spark)
    before = left()
    counted = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    assert len(counted.collect()) == 100
    until = time.time() + 20
    while left() - before and time.time() < until:
        time.sleep(0.2)
    assert not left() - before
    assert len(counted.collect()) == 100


def test_details_are_derived_in_steps(spark, tmp_path):
    """Line numbers above 9 and null ones give ids that lines of several orders share."""
    at = datetime.datetime(2024, 1, 1)
    shapes = {
        "orders": [(k, k % 3, "P", 1.0, at, "x") for k in (1, 2, 3, 12)] + [(1, 1, "F", 2.0, at, "y")],
        "customer": [(k, "c", k, 1.0, "m") for k in range(3)],
        "part": [(k, f"part {k}", "b", "t", 1, 2.5) for k in range(1, 31)],
        "lineitem": [(o, p, 5 * p, n, 3.0, 10.0 + p, 0.1, 0.05, "R", "F", at) for o in (1, 2, 3, 12)
                     for n, p in ((0, 3), (1, 6), (10, 9), (12, 30), (None, 15))] * 2}
    for name, some in shapes.items():
        spark.createDataFrame(some, fx.SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    registry.tune(spark, "UTC")
    want = facts.published(registry.detail_fact(spark, str(tmp_path)))
    got = registry.detail_rows(spark, str(tmp_path))
    assert got.columns == want.columns and rows(got) == rows(want)
    assert got.where("id = '20'").select("order_id").distinct().count() == 2


def test_a_published_batch_is_a_micro_batch(spark, tmp_path):
    """However many files it has."""
    where = str(tmp_path / "changes")
    for n, many in enumerate((9, 7, 8)):
        spark.range(100).select(F.col("id").alias("ts"), F.lit(1).cast("bigint").alias("_count")).repartition(many) \
            .write.parquet(f"{where}/batch_id={n}")
    most = registry.most_files(spark, where)
    assert most == 9 and registry.most_files(spark, f"{where}/none") == 1
    seen, stream = [], readers.read_counted_changes(spark, where, "ts bigint", maxFilesPerTrigger=str(most))
    jobs.run_batches(stream, "counted", lambda _: lambda batch, n: seen.append(batch.count()))
    assert len(seen) == 3 and sum(seen) == 300
