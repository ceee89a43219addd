"""Keyed operators against plain-Python models, with one key holding a third of all rows."""

import random
from collections import defaultdict
from datetime import datetime, timezone

from conftest import rows
from pyspark.sql import functions as F

from rillmart import fixtures
from rillmart.operators import keyed
from rillmart.plans import trade

BASE = 1_704_067_200_000  # 2024-01-01 00:00 UTC
DAY = 86_400_000


def day_of(ms):
    return datetime.fromtimestamp(ms / 1000, timezone.utc).strftime("%Y-%m-%d")


def visits(seed, n=600):
    rnd = random.Random(seed)
    return [(i, "hot" if rnd.random() < 0.34 else f"m{rnd.randrange(20)}",
             rnd.choice(["0", "1", None]), BASE + rnd.randrange(12 * DAY)) for i in range(n)]


def test_new_visitor_repair(spark):
    data = visits(1)
    df = spark.createDataFrame(data, "id int, mid string, is_new string, ts bigint")
    got = {r.id: r.is_new_fixed for r in keyed.repair_new_visitors(
        df, F.col("mid"), F.col("is_new"), F.col("ts")).collect()}
    state, want = {}, {}
    for i, mid, new, ts in sorted(data, key=lambda r: (r[3], r[2] == "1")):
        day = day_of(ts)
        if mid not in state:
            state[mid] = day if new == "1" else day_of(ts - DAY)
        want[i] = "0" if new == "1" and state[mid] != day else new
    assert got == want


def test_daily_flag_and_first_row(spark):
    data = visits(2)
    df = spark.createDataFrame(data, "id int, mid string, is_new string, ts bigint")
    want, seen = {}, {}
    for i, mid, _, ts in sorted(data, key=lambda r: (r[3], r[0])):
        want[i] = int(seen.get(mid) != day_of(ts))
        seen[mid] = day_of(ts)
    got = {r.id: r.uv_ct for r in keyed.flag_first_of_day(df, ["mid"], ["id"]).collect()}
    assert got == want
    firsts = keyed.first_per_day(df, ["mid"], ["id"])
    assert {r.id for r in firsts.collect()} == {i for i, flag in want.items() if flag}


def test_login_gaps(spark):
    """Gaps of 0, 1, 7, 8 and 9 days, also when the hours make the gap look shorter."""
    late, early = 23 * 3_600_000, 60_000
    data = []
    for gap in (0, 1, 7, 8, 9):
        data += [(f"u{gap}", BASE + late), (f"u{gap}", BASE + gap * DAY + (late if gap == 0 else early))]
    df = spark.createDataFrame(data, "uid string, ts bigint")
    got = defaultdict(lambda: [0, 0])
    for r in keyed.login_days(df).collect():
        got[r.uid][0] += r.uu_ct
        got[r.uid][1] += r.back_ct
    assert dict(got) == {"u0": [1, 0], "u1": [2, 0], "u7": [2, 0], "u8": [2, 1], "u9": [2, 1]}


def repeats(seed, n=500):
    rnd = random.Random(seed)
    return [("hot" if rnd.random() < 0.34 else f"d{rnd.randrange(25)}", rnd.randrange(400), i,
             rnd.choice([None, *range(1, 50)])) for i in range(n)]


def superseded(data, ttl):
    by_key, out = defaultdict(list), {}
    for key, ts, i, _ in sorted(data, key=lambda r: (r[1], r[2])):
        by_key[key].append((ts, i))
    for seq in by_key.values():
        for (ts, i), nxt in zip(seq, [*seq[1:], None]):
            out[i] = nxt is not None and (ttl is None or nxt[0] - ts <= ttl)
    return out


def test_superseded_rows(spark):
    data = repeats(3)
    df = spark.createDataFrame(data, "id string, ts bigint, n int, amount int")
    for ttl in (0, 3, 10, None):
        got = {r.n: r.superseded for r in keyed.mark_superseded(df, "id", ["n"], ttl).collect()}
        assert got == superseded(data, ttl), ttl


def test_slices_are_complete(spark):
    """Tiny slices: nearly every successor stands in another slice."""
    data = repeats(4)
    df = spark.createDataFrame(data, "id string, ts bigint, n int, amount int")
    for width in (1, 7, 600):
        lasts = keyed.moment_lasts(df, "id", ["n"], 10, slice_seconds=width)
        got = {r["_last"]["n"] for r in lasts.where("kept").collect()}
        assert got == {i for i, gone in superseded(data, 10).items() if not gone}


def test_superseded_rows_where_keys_lie_together(spark):
    """Each key lies whole in its group: the rows are shuffled to their group and to their second, and no more."""
    data = repeats(7) + [("d1", 5, 900, 1), ("d1", 5, 900, 2), (None, 5, 901, 1), ("d1", None, 902, 1)]
    df = spark.createDataFrame([((k or "x")[-1], k, *r) for k, *r in data],
                               "place string, id string, ts bigint, n int, amount int")
    for ttl in (0, 3, 10, None):
        plain = keyed.mark_superseded(df, "id", ["n"], ttl)
        near = keyed.mark_superseded(df.repartition(4, "place"), "id", ["n"], ttl, near=["place"], carry=["amount"])
        assert rows(near) == rows(plain) and near.count() == len(data) - 2, ttl
    near = keyed.mark_superseded(df.repartition(4, "place"), "id", ["n"], 10, near=["place"], carry=["amount"])
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(id") == 2 and "_slice" not in "".join(
        line for line in plan.splitlines() if "Exchange" in line)


def test_ids_tell_orders(spark, tmp_path):
    """An id is the order's number and one digit for the line; line 15 of order 1 is called as line 5 of order 2."""
    for name, lines, want in (("plain", [(1, 0), (2, 9)], True), ("stray", [(1, 15), (2, 5)], False), ("null", [(1, None)], False)):
        spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int").write.parquet(f"{tmp_path}/{name}/lineitem.parquet")
        assert fixtures.ids_tell_orders(spark, f"{tmp_path}/{name}") == want


def test_cancel_out(spark):
    data = repeats(5)
    df = spark.createDataFrame(data, "id string, ts bigint, n int, amount int")
    gone = superseded(data, 10)
    want = [(k, ts, i, a) for k, ts, i, a in data]
    want += [(k, ts, i, None if a is None else -a) for k, ts, i, a in data if gone[i]]
    assert rows(keyed.cancel_out(df, "id", ["amount"], ["n"], 10)) == sorted(want, key=repr)


def test_copies_of_one_record_count_once(spark):
    """A third of all rows are copies of one line; it is paid for once."""
    line = {"id": "1", "order_id": "7", "sku_id": "3", "province_id": "5", "sku_num": "1",
            "split_total_amount": "10.50", "ts": 1_718_160_880}
    copies = spark.range(1000).select(*[F.lit(v).alias(k) for k, v in line.items()])
    other = spark.range(1, 2001).select(
        F.concat(F.lit("x"), "id").alias("id"), F.col("id").cast("string").alias("order_id"),
        F.lit("4").alias("sku_id"), F.lit("5").alias("province_id"), F.lit("1").alias("sku_num"),
        F.lit("1.00").alias("split_total_amount"), F.lit(1_718_160_881).alias("ts"))
    province = spark.createDataFrame([("6", "elsewhere")], "id string, name string")
    out = trade.province_order(copies.unionByName(other), province, order=["order_id"]).collect()
    assert [(r.stt, r.province_name, r.order_count, str(r.order_amount)) for r in out] == [
        ("2024-06-12 02:54:40", "", 2000, "2010.5000")]


def test_cancelled_line_leaves_a_zero_window(spark):
    """A repeat in the next window takes the amount out of the earlier one; a measure
    that is never a number stays null."""
    data = [("1", "7", "5", "3.00", "bad", 100), ("1", "7", "5", "4.00", "bad", 110),
            ("2", "8", "5", "1.00", "bad", 125)]
    df = spark.createDataFrame(data, "id string, order_id string, province_id string, "
                                     "split_total_amount string, split_coupon_amount string, ts bigint")
    province = spark.createDataFrame([("5", "here")], "id string, name string")
    out = trade.province_order(df, province, order=["order_id"]).collect()
    assert sorted((r.stt[-8:], r.order_count, str(r.order_amount)) for r in out) == [
        ("00:01:40", 1, "0.0000"), ("00:01:50", 1, "4.0000"), ("00:02:00", 1, "1.0000")]
    net = trade.net_measures(df, ["id"], {"c": "split_coupon_amount"}, ["order_id"], 10)
    assert net.agg(F.sum("c")).collect()[0][0] is None


def test_latest_per_key(spark):
    data = repeats(6)
    df = spark.createDataFrame(data, "id string, ts bigint, n int, amount int")
    want = {}
    for row in sorted(data, key=lambda r: (r[1], r[2])):
        want[row[0]] = row
    assert rows(keyed.latest_per_key(df, ["id"], ["ts", "n"])) == sorted(want.values(), key=repr)


