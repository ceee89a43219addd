"""Streams over several micro-batches, compared with their batch forms."""

import json
import time

from conftest import rows
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.operators.windows import event_time, tumble
from rillmart.plans import trade, traffic
from rillmart.session import shared_dir
from rillmart.sources import readers, sinks
from rillmart.sources.readers import Topic
from rillmart.streaming import jobs
from rillmart.streaming.results import ResultTable
from rillmart.streaming.store import PartStore, publish

BASE, DAY = 1_704_067_200_000, 86_400_000


class Feed:
    """A folder topic; ``send`` adds one file, each run of a job reads what is new."""

    def __init__(self, path):
        self.path, self.n = path, 0
        path.mkdir(exist_ok=True)

    def send(self, *records):
        self.n += 1
        lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
        (self.path / f"{self.n:03}.txt").write_text("\n".join(lines) + "\n")

    @property
    def topic(self):
        return Topic(str(self.path))


def page(mid, ts, uid="", last=None, is_new="0", **more):
    return {"common": {"mid": mid, "uid": uid, "is_new": is_new, "vc": "v", "ch": "c", "ar": "a"},
            "page": {"page_id": "home", "last_page_id": last, "during_time": "5"}, "ts": ts, **more}


def all_pages(spark, batches):
    lines = spark.createDataFrame([(json.dumps(r),) for b in batches for r in b], "value string")
    return lines.select(F.from_json("value", schemas.PAGE_LOG).alias("r")).select("r.*")


def test_daily_rows_last_between_runs(spark, tmp_path):
    """In order, late within a day, days late, without a device, and the same file once more."""
    feed, root = Feed(tmp_path / "in"), shared_dir(spark, "daily")
    batches = [[page("a", BASE + 5), page("a", BASE + 9), page("b", BASE + 7), page(None, BASE + 8)],
               [page("a", BASE + 60_000), page("b", BASE + DAY), page(None, BASE + 1)],
               [page("a", BASE + 2), page("b", BASE + 400 * DAY), page("a", BASE - 9 * DAY)],
               [page("b", BASE + DAY - 1), page("b", BASE + DAY + 1), page("b", BASE + 6)], []]
    seen = []
    for batch in batches:
        feed.send(*batch)
        seen.append(batch)
        where = jobs.page_view(readers.read_page_log(spark, feed.topic, delay=None), root=root, buckets=2)
        sums = ["uv_ct", "sv_ct", "pv_ct", "dur_sum"]
        got = sinks.read_summed(spark, where, [c for c in schemas.PAGE_VIEW if c not in sums], sums)
        assert rows(got.select(*schemas.PAGE_VIEW)) == rows(traffic.page_view(all_pages(spark, seen)))


def test_a_hot_device(spark, tmp_path):
    """A third of all rows from one device: it comes to one row a day and batch before any join."""
    feed, root = Feed(tmp_path / "in"), shared_dir(spark, "hot")
    batches = [[page("hot" if k % 3 == 0 else f"m{k}", BASE + n * DAY // 2 + k) for k in range(300)] for n in range(3)]
    for batch in batches:
        feed.send(*batch)
        where = jobs.home_detail_uv(readers.read_page_log(spark, feed.topic, delay=None), "1 hour", root=root)
    fresh = spark.read.parquet(f"{where.removesuffix('/windows')}/keys/fresh")
    assert fresh.where("mid = 'hot'").count() == 1
    got = sinks.read_summed(spark, where, schemas.BOUNDS, ["home_uv_ct", "good_detail_uv_ct"])
    want = traffic.home_detail_uv(all_pages(spark, batches), "1 hour")
    assert rows(got) == rows(want)


def test_returning_users_between_runs(spark, tmp_path):
    feed, root = Feed(tmp_path / "in"), shared_dir(spark, "login")

    def run(*records):
        feed.send(*records)
        where = jobs.user_login(readers.read_page_log(spark, feed.topic, delay=None), root=root, buckets=2)
        out = sinks.read_summed(spark, where, schemas.BOUNDS, ["back_ct", "uu_ct"])
        return sorted((r.cur_date, r.back_ct, r.uu_ct) for r in out.collect())

    run(page("m", BASE, "u"), page("m", BASE + 3, "w"))
    got = run(page("m", BASE + 7 * DAY, "w"), page("m", BASE + 8 * DAY, "u"))
    assert got == [("2024-01-01", 0, 2), ("2024-01-08", 0, 1), ("2024-01-09", 1, 1)]
    # A day between comes late: the user was not away for eight days.
    got = run(page("m", BASE + 4 * DAY, "u"))
    assert got == [("2024-01-01", 0, 2), ("2024-01-05", 0, 1), ("2024-01-08", 0, 1), ("2024-01-09", 0, 1)]


def test_cart_users_between_runs(spark, tmp_path):
    feed, root = Feed(tmp_path / "in"), shared_dir(spark, "carts")
    for batch in ([("u", 100), ("v", 101)], [("u", 90_000), ("v", 50)], [("w", 101)]):
        feed.send(*[{"id": "1", "user_id": u, "sku_id": "s", "sku_num": "1", "ts": t} for u, t in batch])
        cart = readers.read_fact(spark, feed.topic, schemas.CART_ADD)
        where = jobs.cart_add_uu(cart, root=root)
    got = sinks.read_summed(spark, where, schemas.BOUNDS, ["cart_add_uu_ct"])
    batch = readers.read_fact(spark, feed.topic, schemas.CART_ADD, False)
    assert rows(got) == rows(trade.cart_add_uu(batch))


def test_visitor_repair_loses_no_line(spark, tmp_path):
    """Rows days behind, rows without a device and dirty lines over three micro-batches."""
    feed, root = Feed(tmp_path / "in"), shared_dir(spark, "repair")
    feed.send(page("a", BASE + DAY, is_new="1"), page("a", BASE, is_new="1"), "not json {",
              page("b", BASE + 90 * DAY, is_new="0"))
    job = lambda: jobs.split_log(readers.read_lines(spark, feed.topic), "repair", root)
    job()
    feed.send(page("a", BASE + 1, is_new="1"), page("b", BASE + 1, is_new="1"), page(None, BASE, is_new="1"))
    job()
    feed.send(page("c", BASE - 40 * DAY, is_new="1"), page(None, BASE + DAY, is_new="1"), "[1")
    where = job()
    out = spark.read.schema("value string, topic string").json(f"{where}/facts").select(
        F.from_json("value", schemas.CLIENT_LOG).alias("r")).select("r.*")
    got = sorted((r.common.get("mid") or "", r.ts - BASE, r.common["is_new"]) for r in out.collect())
    assert got == [("", 0, "1"), ("", DAY, "1"), ("a", 0, "1"), ("a", 1, "1"), ("a", DAY, "0"),
                   ("b", 1, "0"), ("b", 90 * DAY, "0"), ("c", -40 * DAY, "1")]
    assert rows(spark.read.text(f"{where}/dirty").select("value")) == [("[1",), ("not json {",)]


def test_first_days_are_forgotten(spark, tmp_path):
    """Terms of a day: within one micro-batch, over several, a late row, and what is left stored."""
    feed, root = Feed(tmp_path / "in"), shared_dir(spark, "ttl")
    batches = [[page("a", BASE + DAY // 2, is_new="1"), page("a", BASE + DAY + 5, is_new="1"),
                page("a", BASE + 2 * DAY, is_new="1"), page("b", BASE, is_new="1")],
               [page("a", BASE + 3 * DAY - 1, is_new="1"), page("b", BASE + DAY, is_new="1"), page("a", BASE + 7, is_new="1")],
               [page("c", BASE + 9 * DAY, is_new="0"), page("c", BASE + 9 * DAY + 1, is_new="1")]]
    for batch in batches:
        feed.send(*batch)
        where = jobs.split_log(readers.read_lines(spark, feed.topic), "ttl", root, ttl=DAY, buckets=2)
    out = spark.read.schema("value string, topic string").json(f"{where}/facts").select(
        F.from_json("value", schemas.CLIENT_LOG).alias("r")).select("r.*")
    got = sorted((r.common["mid"], r.ts - BASE, r.common["is_new"]) for r in out.collect())
    # a: the term of day 0 ends at noon of day 1; the next one starts on day 2 and holds day 2 only.
    # b: its second row comes when time has gone on by more than a term, and its first day is forgotten.
    assert got == [("a", 7, "0"), ("a", DAY // 2, "1"), ("a", DAY + 5, "0"), ("a", 2 * DAY, "1"),
                   ("a", 3 * DAY - 1, "1"), ("b", 0, "1"), ("b", DAY, "1"), ("c", 9 * DAY, "0"), ("c", 9 * DAY + 1, "0")]
    stored = PartStore(spark, f"{where}/first_days", jobs.FIRST_DAYS, ["bucket"]).read(3)
    assert {r._mid for r in stored.collect()} <= {"a", "b", "c"} and stored.where("_mid = 'c'").count() == 1


def test_result_table_takes_each_load_once(spark, tmp_path):
    """A load that fails half-way, one that comes again, and other micro-batches over the same loads."""
    shape = "stt string, cur_date string, n bigint"
    rows_of = lambda *r: spark.createDataFrame(r, shape)
    changes = str(tmp_path / "changes")
    table = ResultTable(spark, str(tmp_path / "table"), rows_of(), ["n"])
    publish(rows_of(("a", "d1", 2), ("b", "d2", 1)), changes, 0)
    publish(rows_of(("a", "d1", 1)), changes, 1)
    table.load(changes, str(tmp_path / "one"))
    assert rows(table.rows()) == [("a", "d1", 3), ("b", "d2", 1)]
    publish(rows_of(("a", "d1", -3), ("c", "d1", 5)), changes, 2)
    publish(rows_of(("ignored", "d1", 9)), changes, 2)
    table.load(changes, str(tmp_path / "two"), maxFilesPerTrigger="1")
    table.load(changes, str(tmp_path / "one"))
    assert rows(table.rows()) == [("b", "d2", 1), ("c", "d1", 5)]
    assert rows(table.lines())[0] == ('{"stt":"b","cur_date":"d2","n":1}',)


def detail(i, ts, paid, sku="s", order="o"):
    return {"id": i, "order_id": order, "sku_id": sku, "province_id": "p", "split_total_amount": paid,
            "split_original_amount": paid, "split_activity_amount": None, "split_coupon_amount": "0", "ts": ts}


def test_repeats_between_runs(spark, tmp_path):
    """A line repeated in the same window, over the edge of two, late, and after its time to live."""
    feed, columns = Feed(tmp_path / "in"), list(detail("a", 1, "1"))
    roots = shared_dir(spark, "province"), shared_dir(spark, "sku")
    batches = [[detail("a", 100, "3"), detail("b", 101, "5"), detail("c", 104, "7")],
               [detail("a", 108, "4"), detail("x", 115, "1", order="o2")],
               [detail("c", 116, "9"), detail("x", 117, "2", "s2"), detail("a", 104, "8")],
               [detail("x", 127, "6"), detail("x", 127, "6.5"), detail("d", 9_000_000, "x")], [detail("a", 99, "1")]]
    for batch in batches:
        feed.send(*batch)
        fact = lambda stream: readers.read_fact(spark, feed.topic, columns, stream)
        order = ["split_total_amount"]
        where = jobs.province_order(fact(True), order=order, root=roots[0])
        want = trade.province_windows(fact(False), "10 seconds", order, trade.REPEAT_TTL)
        assert rows(sinks.read_counted(spark, where).select(*want.columns)) == rows(want)
        where = jobs.sku_order(fact(True), order=order, root=roots[1])
        want = trade.sku_windows(fact(False), "10 seconds", order, trade.REPEAT_TTL)
        assert rows(sinks.read_counted(spark, where).select(*want.columns)) == rows(want)


def test_messages_and_targets(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.send({"id": "1", "t": "x"}, {"id": "2", "t": "y"})
    src = readers.read_lines(spark, feed.topic).select(
        F.from_json("value", "id string, t string").alias("r")).select("r.*")
    messages = sinks.to_lines(src, key="id", topic=F.col("t"))
    assert messages.columns == ["topic", "key", "value"]
    out = str(tmp_path / "out")
    query = sinks.write_lines(messages.drop("key"), str(tmp_path / "cp"), out).trigger(
        availableNow=True).start()
    query.awaitTermination()
    assert [r.value for r in spark.read.text(f"{out}/topic=x").collect()] == ['{"id":"1","t":"x"}']


def test_fan_out_writes_each_target(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,), (3,)], "n int")
    write = sinks.fan_out({"odd": lambda b: b.where("n % 2 = 1"), "all": lambda b: b}, str(tmp_path))
    write(df, 0)
    write(df, 0)
    assert spark.read.json(str(tmp_path / "odd")).count() == 2
    assert spark.read.json(str(tmp_path / "all")).count() == 3


def test_late_rows_are_dropped(spark, tmp_path):
    feed, root = Feed(tmp_path / "in"), shared_dir(spark, "late")

    def job():
        log = readers.read_page_log(spark, feed.topic)
        return traffic.keyword_pv(log)

    def search(ts, word):
        return {"common": {}, "ts": ts, "page": {"last_page_id": "search", "item_type": "keyword",
                                                 "item": word}}
    for batch in ([search(BASE, "one")], [search(BASE + 60_000, "two")], [search(BASE + 1, "late")],
                  [search(BASE + DAY, "beat")]):
        feed.send(*batch)
        out = jobs.run_available(job(), "late", root)
    assert sorted(r.keyword for r in out.collect()) == ["one", "two"]


def test_processing_time_windows(spark):
    df = event_time(spark.range(10).select(F.lit(0).alias("ts")))
    out = tumble(df, "1 day", [], [F.count("*").alias("n")], time_mode="processing").collect()
    assert sum(r.n for r in out) == 10 and all(r.cur_date != "1970-01-01" for r in out)


def test_processing_time_windows_of_a_stream(spark, tmp_path):
    feed, root = Feed(tmp_path / "in"), shared_dir(spark, "clock")

    def job():
        lines = readers.read_lines(spark, feed.topic)
        return tumble(lines, "1 second", [], [F.count("*").alias("n")], time_mode="processing")

    for n in range(3):
        feed.send(*[{"id": str(k)} for k in range(n + 1)])
        out = jobs.run_available(job(), "clock", root)
        time.sleep(1.1)
    assert sum(r.n for r in out.collect()) >= 1


def test_tombstones(spark):
    df = spark.createDataFrame([("1", "x"), ("2", None)], "id string, v string")
    got = sinks.to_lines(df, key="id", deleted=F.col("v").isNull()).collect()
    assert [tuple(r) for r in got] == [('{"id":"1"}', '{"id":"1","v":"x"}'), ('{"id":"2"}', None)]


def test_a_batch_writes_few_files(spark, tmp_path):
    df = spark.range(200).selectExpr("id % 4 AS topic", "id AS value").repartition(16)
    sinks.write_batches(str(tmp_path / "out"), "json", ["topic"])(df, 0)
    assert len(list((tmp_path / "out").glob("*/topic=*/part-*"))) == 4


def test_table_reads(spark):
    where = "/root/testdata/sf0.001/nation.parquet"
    rules = readers.read_table(spark, where, columns=["n_nationkey", "n_name"], to_camel=True)
    assert rules.columns == ["nNationkey", "nName"] and rules.count() == 25
