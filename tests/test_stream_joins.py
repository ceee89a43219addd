"""Fact joins over micro-batches in no order of time, against their batch forms."""

import duckdb
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_streaming import Feed

import __spark_entry__ as entry
import checks
from rillmart import schemas
from rillmart.plans import facts, trade
from rillmart.session import shared_dir
from rillmart.sources import files, readers, sinks
from rillmart.streaming import jobs
from rillmart.streaming.store import PartStore

SF = "/root/testdata/sf0.001"
T = 1_704_067_200


def change(table, ts, **data):
    return {"database": "d", "table": table, "type": "insert", "ts": ts, "data": data, "offset": ts}


def line(i, order, ts):
    return change("order_detail", ts, id=i, order_id=order, sku_num="2", order_price="1.50")


def test_a_late_side_is_joined(spark, tmp_path):
    feed, root = Feed(tmp_path / "in"), shared_dir(spark, "joined")
    batches = [[line("1", "o", T), line("1", "o", T), line("2", "p", T + 1)],
               [change("order_info", T + 90_000, id="far", user_id="u"), line("3", "far", T + 90_001)],
               [change("order_info", T + 2, id="o", user_id="u"), change("order_info", T + 12, id="p", user_id="u")],
               [change("order_detail_coupon", T + 10, order_detail_id="1", coupon_id="c")], []]
    coupons = []
    for batch in batches:
        feed.send(*batch)
        log = readers.read_changelog(spark, feed.topic, delay=None).drop("pt")
        where = jobs.join_facts({"log": log}, lambda log: facts.published(facts.order_detail(log)),
                                facts.REACH["order_detail"], "joined", root)
        got = sinks.read_counted(spark, where)
        read = readers.read_changelog(spark, feed.topic, False)
        assert rows(got.select(*schemas.ORDER_DETAIL)) == rows(facts.published(facts.order_detail(read)))
        coupons.append(sorted((r.id, r.coupon_id or "") for r in got.collect()))
    both = [("1", "c"), ("1", "c"), ("3", "")]
    assert coupons == [[], [("3", "")], [("1", ""), ("1", ""), ("3", "")], both, both]


def file_count(spark, where):
    return len(files.names(spark, f"{where}/version=*/part=*/bucket=*/part-*"))


def test_old_batches_leave_no_files_behind(spark, tmp_path):
    """Rows all over time in every batch: the store holds as many files after ten batches as after two."""
    feed, root, counts = Feed(tmp_path / "in"), shared_dir(spark, "files"), []
    for n in range(10):
        feed.send(*[line(f"{n}-{k}", f"{k}", T + 86_400 * k) for k in range(4)],
                  *[change("order_info", T + 86_400 * k, id=f"{k}", user_id="u") for k in range(4) if n == 1])
        log = readers.read_changelog(spark, feed.topic, delay=None).drop("pt")
        where = jobs.join_facts({"log": log}, lambda log: facts.published(facts.order_detail(log)),
                                facts.REACH["order_detail"], "files", root)
        store = PartStore(spark, where.replace("/facts", "/sides"), "x int", ["part", "bucket"])
        counts.append((len(store.index(n + 1)["parts"]), file_count(spark, f"{store.where}/data")))
    # Four days, one file each, and those of the batch before, kept for a repeated run.
    assert counts[1:] == [(4, 8)] * 9
    assert sinks.read_counted(spark, where).count() == 40


def test_a_batch_reads_only_parts_near_its_rows(spark, tmp_path):
    store = PartStore(spark, str(tmp_path / "s"), "v int, part int, bucket int", ["part", "bucket"])
    rows_of = lambda *r: spark.createDataFrame(r, "v int, part int, bucket int")
    first = rows_of((1, 0, 0), (2, 0, 1), (3, 5, 0))
    store.replace(0, first, store.part_names(first))
    assert rows(store.read(1, {"part=0/bucket=1"})) == [(2, 0, 1)]
    assert len(store.read(1, {"part=0/bucket=1", "part=9/bucket=0"}).inputFiles()) == 1
    # A batch that is run again starts from the same rows, whatever its first run left.
    for value in (7, 8):
        store.clean(1)
        assert rows(store.read(1)) == rows(first)
        store.replace(1, rows_of((value, 0, 1)), {"part=0/bucket=1"}, {"seen": value})
    assert rows(store.read(2)) == [(1, 0, 0), (3, 5, 0), (8, 0, 1)] and store.index(2)["notes"] == {"seen": 8}
    store.replace(2, rows_of(), {"part=0/bucket=0"}, expired=lambda p: int(p["part"]) > 4)
    assert rows(store.read(3)) == [(8, 0, 1)]
    store.clean(3)
    assert len(files.names(spark, f"{store.where}/data/version=*/part=*/bucket=*")) == 1


def test_sides_expire(spark, tmp_path):
    """A side that comes within the time that is kept is joined; one behind it is written to ``late``."""
    feed, root = Feed(tmp_path / "in"), shared_dir(spark, "expiry")

    def run(*records):
        feed.send(*records)
        log = readers.read_changelog(spark, feed.topic, delay=None).drop("pt")
        where = jobs.join_facts({"log": log}, lambda log: facts.published(facts.order_detail(log)),
                                facts.REACH["order_detail"], "expiry", root, width=100, keep=1_000)
        parts = PartStore(spark, where.replace("/facts", "/sides"), "x int", ["part", "bucket"]).index(99)["parts"]
        return where, sorted(int(p.split("/")[0].removeprefix("part=")) - T // 100 for p in parts)

    assert run(line("1", "o", T), line("2", "p", T + 800))[1] == [0, 8]
    assert run(line("3", "q", T + 1_500))[1] == [8, 15]
    where, parts = run(change("order_info", T, id="o"), change("order_info", T + 805, id="p"))
    assert parts == [8, 15]
    assert [r.id for r in sinks.read_counted(spark, where).collect()] == ["2"]
    late = spark.read.parquet(where.replace("/facts", "/late"))
    assert [r.log.data["id"] for r in late.collect()] == ["o"]


def test_parts_by_key(spark, tmp_path):
    """Sides in buckets of the order they share give the same rows, and a batch reads its buckets only."""
    feed, root = Feed(tmp_path / "in"), shared_dir(spark, "buckets")
    key = F.coalesce(F.col("data")["order_id"], F.col("data")["id"])
    batches = [[line(str(k), f"o{k % 5}", T + k) for k in range(20)],
               [change("order_info", T + k, id=f"o{k}", user_id="u") for k in range(3)],
               [change("order_info", T + 9, id="o4", user_id="u"), line("x", "o4", T + 9)]]
    for batch in batches:
        feed.send(*batch)
        log = readers.read_changelog(spark, feed.topic, delay=None).drop("pt")
        where = jobs.join_facts({"log": log}, lambda log: facts.published(facts.order_detail(log)),
                                facts.REACH["order_detail"], "buckets", root, keys={"log": key}, buckets=8)
        read = readers.read_changelog(spark, feed.topic, False)
        want = facts.published(facts.order_detail(read))
        assert rows(sinks.read_counted(spark, where).select(*schemas.ORDER_DETAIL)) == rows(want)
    index = PartStore(spark, where.replace("/facts", "/sides"), "x int", ["part", "bucket"]).index(3)["parts"]
    assert list(index.values()).count(2) == 1 and len(index) > 2


def test_windows_follow_what_a_join_takes_back(spark, tmp_path):
    """Each round runs both jobs; a coupon that comes later replaces the line in the windows."""
    feed, roots = Feed(tmp_path / "in"), (shared_dir(spark, "details"), shared_dir(spark, "windows"))
    batches = [[line("1", "o", T), line("2", "o", T + 1), change("order_info", T, id="o", user_id="u", province_id="p")],
               [change("order_detail_coupon", T + 2, order_detail_id="1", coupon_id="c")],
               [line("3", "late", T - 500), line("2", "o", T + 1)], [change("order_info", T - 501, id="late")], []]
    for batch in batches:
        feed.send(*batch)
        log = readers.read_changelog(spark, feed.topic, delay=None).drop("pt")
        details = jobs.join_facts({"log": log}, lambda log: facts.published(facts.order_detail(log)),
                                  facts.REACH["order_detail"], "details", roots[0])
        changes = readers.read_counted_changes(spark, details, schemas.fact_ddl(schemas.ORDER_DETAIL))
        where = jobs.sku_order(changes, name="windows", root=roots[1])
        read = facts.order_detail(readers.read_changelog(spark, feed.topic, False))
        want = trade.sku_windows(facts.published(read), "10 seconds", (), trade.REPEAT_TTL)
        got = sinks.read_counted(spark, where)
        assert rows(got.select(*want.columns)) == rows(want)
    stored = spark.read.parquet(where.replace("/facts", "/sides/data"))
    assert sum(r["_n"] < 0 for r in stored.collect()) == 0


@pytest.mark.parametrize("name", ["stream_order_detail_late", "stream_refund_pay_late", "stream_user_login_late",
                                  "stream_sku_order_w10_late", "stream_order_detail_to_sku"])
def test_late_files_give_the_rows_of_sql(spark, name):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in checks.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    assert checks.rows_of(df.columns, [tuple(r) for r in df.collect()]) == \
        checks.rows_of([d[0] for d in cur.description], cur.fetchall())
