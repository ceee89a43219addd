"""Joins: bounds, outer rows, skew."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rillmart.operators import joins, keyed
from rillmart.operators.windows import event_time
from rillmart.plans import facts
from rillmart.sources import readers
from rillmart.streaming import jobs


def emp_dept(spark):
    emp = [(1, "a", 10, 1000), (2, "b", 20, 1000), (3, "c", 30, 1000)]
    dept = [(10, f"d{d:+}", 1000 + d) for d in (-6, -5, 0, 5, 6)] + [(40, "alone", 1000)]
    e = event_time(spark.createDataFrame(emp, "empno int, ename string, deptno int, ts bigint"))
    d = event_time(spark.createDataFrame(dept, "dno int, dname string, ts bigint"))
    return e.drop("ts"), d.drop("ts")


@pytest.mark.parametrize("sliced", [False, True])
def test_interval_bounds_are_inclusive(spark, sliced):
    e, d = emp_dept(spark)
    out = joins.interval_join(e, d, [("deptno", "dno")], -5, 5, unit="MILLISECONDS", sliced=sliced)
    assert rows(out.select("empno", "dname")) == [(1, "d+0"), (1, "d+5"), (1, "d-5")]


@pytest.mark.parametrize("how,left_only,right_only", [
    ("inner", 0, 0), ("left", 2, 0), ("right", 0, 3), ("full", 2, 3)])
def test_bounded_outer_rows(spark, how, left_only, right_only):
    e, d = emp_dept(spark)
    out = joins.interval_join(e, d, [("deptno", "dno")], -5, 5, how, unit="MILLISECONDS")
    assert out.where("dno is null").count() == left_only
    assert out.where("empno is null").count() == right_only
    assert out.where("et is null").count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_sliced_join_equals_brute_force(spark, how):
    """One key holds a third of both sides."""
    rnd = random.Random(7)

    def side(n, name):
        data = [(i, rnd.choice([0, 0, *range(1, 5)]), rnd.randrange(3000)) for i in range(n)]
        df = spark.createDataFrame(data, f"{name} int, {name}_k int, ts bigint")
        return data, event_time(df, "s").drop("ts")

    left, l = side(150, "a")
    right, r = side(150, "b")
    want = []
    for i, k, t in left:
        hits = [j for j, k2, t2 in right if k == k2 and t - 20 <= t2 <= t + 35]
        want += [(i, j) for j in hits] or ([(i, None)] if how == "left" else [])
    out = joins.interval_join(l, r, [("a_k", "b_k")], -20, 35, how, sliced=True)
    assert rows(out.select("a", "b")) == sorted(want, key=repr)


def test_sliced_join_has_no_right_rows_of_its_own(spark):
    e, d = emp_dept(spark)
    with pytest.raises(ValueError):
        joins.interval_join(e, d, [("deptno", "dno")], -5, 5, "full", sliced=True)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_regular_join(spark, how):
    l = spark.createDataFrame([(1, 10), (2, 10), (3, 20), (4, None)], "a int, k int")
    r = spark.createDataFrame([(10, "x"), (30, "y"), (None, "z")], "b int, n string")
    got = joins.regular_join(l, r, [("k", "b")], how)
    want = l.join(r, l.k == r.b, how)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_payment_bounds(spark):
    """Order lines 30 minutes before the payment to 5 seconds after it."""
    paid_at = 10_000
    log = spark.createDataFrame(
        [("db", "payment_info", "update", paid_at,
          {"order_id": "1", "payment_type": "1101", "payment_status": "1602"},
          {"payment_status": "1601"})],
        "`database` string, `table` string, type string, ts bigint, data map<string,string>, "
        "old map<string,string>")
    blank = [F.lit(None).cast("string").alias(c) for c in (
        "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id",
        "coupon_id", "sku_num", "split_original_amount", "split_activity_amount",
        "split_coupon_amount", "split_total_amount")]
    detail = spark.createDataFrame(
        [(str(d), "1", paid_at + d) for d in (-1801, -1800, 0, 5, 6)],
        "id string, order_id string, ts bigint").select("*", *blank)
    dic = spark.createDataFrame([("1101", "wallet")], "dic_code string, dic_name string")
    out = facts.pay_success(event_time(log, "s"), event_time(detail, "s"), dic)
    assert {r.order_detail_id for r in out.collect()} == {"-1800", "0", "5"}
    assert {r.ts for r in out.collect()} == {paid_at}


def test_lookup_drops_and_enrich_keeps(spark):
    df = spark.createDataFrame([("1",), ("2",), (None,)], "k string")
    dim = spark.createDataFrame([("1", "one")], "id string, name string")
    assert rows(joins.lookup_join(df, dim, "k", "id", {"n": "name"})) == [("1", "one")]
    assert rows(joins.enrich(df, dim, "k", "id", {"n": "name"})) == [
        ("1", "one"), ("2", None), (None, None)]


def hot_rows(spark):
    """A third of the rows share a key and a second; the payload does not compress."""
    n = F.col("id")
    hot = n % 3 == 0
    return spark.range(0, 60_000, 1, 8).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("k"), n)).alias("k"), n.alias("n"),
        F.when(hot, 77).otherwise(n).alias("ts"), F.lit("1").alias("flag"),
        F.sha2(n.cast("string"), 256).alias("load"))


def by_enrich(df):
    dim = df.where("n < 30000").groupBy("k").agg(F.max("n").alias("top")).select(
        F.concat("k", F.lit("")).alias("id"), "top")
    return joins.enrich(df, dim, "k", "id", {"top": "top"})


def by_repair(df):
    return keyed.repair_new_visitors(df, F.col("k"), F.col("flag"), F.col("ts"))


def by_repeat(df):
    return keyed.mark_superseded(df, "k", ["n"], 10)


@pytest.mark.parametrize("job", [by_enrich, by_repair, by_repeat])
def test_hot_key_is_sliced(spark, job):
    """With a side too large to broadcast, AQE cuts the hot key's rows into slices."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200000",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "400000",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = job(hot_rows(spark))
        assert len(out.collect()) == 60_000
        assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["left", "full"])
def test_streamed_outer_join(spark, tmp_path, how):
    """An unmatched row comes out once, when its wait is over."""
    (tmp_path / "e").mkdir()
    (tmp_path / "d").mkdir()
    (tmp_path / "e" / "1.csv").write_text("1,a,10,1000\n2,b,20,1000\n9,z,99,9000000\n")
    (tmp_path / "d" / "1.csv").write_text("10,x,1005\n40,y,1000\n99,z,9000000\n")

    def read(name, schema):
        src = readers.read_csv_records(spark, str(tmp_path / name), schema)
        return event_time(src, "ms", "0 seconds").drop("ts")

    out = joins.ttl_join(read("e", "empno int, ename string, deptno int, ts bigint"),
                         read("d", "dno int, dname string, ts bigint"), [("deptno", "dno")], 10, how)
    got = jobs.run_available(out.drop("et"), "emp-dept").where("coalesce(deptno, dno) <> 99")
    want = [(1, "x"), (2, None)] + ([(None, "y")] if how == "full" else [])
    assert rows(got.select("empno", "dname")) == sorted(want, key=repr)
