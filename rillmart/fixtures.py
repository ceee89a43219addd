"""The provided test tables, seen as this engine's inputs.

Each adapter is a projection (plus the joins it needs) over whole tables, so the
work of a query grows with its tables.  Times are epoch numbers in the session zone.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rillmart.functions.fields import MONEY
from rillmart.functions.timefmt import DATETIME

DATABASE = "shop"

# Dictionary codes (1104 is missing on purpose, so that an inner
# lookup has something to drop) and the two top product categories.
DICTIONARY = [("1101", "wallet"), ("1102", "bank card"), ("1103", "union pay"),
              ("1201", "good"), ("1202", "fair"), ("1203", "bad"),
              ("1501", "refund only"), ("1502", "return and refund"),
              ("1301", "quality"), ("1302", "wrong size"), ("1303", "not as described")]
CATEGORY1 = [("0", "goods"), ("1", "services")]


# The columns of the provided tables.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table, with its schema declared."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def text(c: Column) -> Column:
    return c.cast("string")


# --- client logs -----------------------------------------------------------------

def visits(events: DataFrame) -> DataFrame:
    """Events with the parts of a client-log record."""
    k = F.regexp_extract("props", r"\d+", 0).cast("int")
    kind = F.col("event_type")
    pages = F.create_map(*[F.lit(x) for x in (
        "view", "home", "click", "good_detail", "signup", "mine", "purchase", "trade",
        "error", "search_result")])
    last = (F.when(kind == "signup", "login").when(kind == "error", "search")
            .when((kind == "view") & (k % 4 == 0), F.lit(None).cast("string"))
            .when(kind == "view", "mine").otherwise("home"))
    common = F.create_map(
        F.lit("mid"), F.concat(F.lit("mid_"), text(F.col("user_id"))),
        F.lit("uid"), F.when(k % 10 == 0, "").otherwise(text(F.col("user_id"))),
        F.lit("is_new"), F.when(k % 2 == 0, "1").otherwise("0"),
        F.lit("vc"), F.concat(F.lit("v"), text(k % 3)),
        F.lit("ch"), F.concat(F.lit("c"), text(k % 4)),
        F.lit("ar"), F.concat(F.lit("a"), text(F.col("user_id") % 5)))
    page = F.create_map(
        F.lit("page_id"), pages[kind], F.lit("last_page_id"), last,
        F.lit("during_time"), text(F.round(F.col("value") * 100).cast("bigint")))
    return events.select("event_id", k.alias("k"), kind.alias("kind"), common.alias("common"),
                         page.alias("page"), millis(F.col("ts")).alias("ts"))


def millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits(table(spark, sf_dir, "events")).select("common", "page", "ts")


def raw_log(events: DataFrame) -> DataFrame:
    """Client-log lines, some of them not JSON."""
    v = visits(events)
    k, ts = F.col("k"), F.col("ts")

    def items(n: Column, *fields: Column) -> Column:
        rows = F.transform(F.sequence(F.lit(1), n), lambda i: F.create_map(
            F.lit("pos"), text(i), *fields))
        return F.when(n > 0, rows).otherwise(F.array().cast("array<map<string,string>>"))

    start = F.when((F.col("kind") == "purchase") & (k % 7 == 0),
                   F.create_map(F.lit("entry"), F.lit("icon")))
    err = F.when((F.col("kind") == "error") & (k % 3 == 0), F.create_map(F.lit("code"), text(k)))
    line = F.to_json(F.struct(
        "common", "page", start.alias("start"), err.alias("err"),
        items(k % 3, F.lit("item"), text(k)).alias("displays"),
        items(k % 2, F.lit("action_id"), F.lit("favor_add"), F.lit("ts"), text(ts)).alias("actions"),
        "ts"))
    return v.select(F.when(F.col("event_id") % 97 == 0, "not json {").otherwise(
        F.coalesce(line, F.lit(""))).alias("value"))


def cart_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", r"\d+", 0).cast("int")
    return e.where(F.col("event_type").isin("click", "view")).select(
        text(F.col("event_id")).alias("id"), text(F.col("user_id")).alias("user_id"),
        text(k).alias("sku_id"), text(1 + k % 5).alias("sku_num"),
        seconds(F.col("ts")).alias("ts"))


def search_log(documents: DataFrame) -> DataFrame:
    """Whole document texts as search items, one second apart."""
    n = F.col("doc_id")
    page = F.create_map(
        F.lit("last_page_id"), F.when(n % 2 == 0, "search").otherwise("home"),
        F.lit("item_type"), F.when(n % 3 != 0, "keyword").otherwise("sku"),
        F.lit("item"), F.col("text"))
    begin = F.unix_millis(F.lit("2024-01-01").cast("timestamp"))
    return documents.select(F.create_map(F.lit("mid"), text(n)).alias("common"),
                            page.alias("page"), (begin + n * 1000).alias("ts"))


# --- change log ---------------------------------------------------------------------

def record(df: DataFrame, name: str, op: str, ts: Column, data: dict[str, Column],
           old: dict[str, Column] | None = None) -> DataFrame:
    def pack(fields):
        return F.create_map(*[x for f, c in fields.items() for x in (F.lit(f), text(c))])
    no_old = F.lit(None).cast("map<string,string>")
    return df.select(F.lit(DATABASE).alias("database"), F.lit(name).alias("table"),
                     F.lit(op).alias("type"), ts.cast("bigint").alias("ts"),
                     pack(data).alias("data"), (pack(old) if old else no_old).alias("old"))


def clock(ts: Column) -> Column:
    return F.date_format(F.timestamp_seconds(ts), DATETIME)


def orders_at(spark: SparkSession, sf_dir: str, place: bool = False) -> DataFrame:
    """Orders with their time ``t`` in seconds, and the province when asked for."""
    o = table(spark, sf_dir, "orders")
    t = seconds(F.col("o_orderdate")) + F.col("o_orderkey") % 86400
    out = o.select("o_orderkey", "o_custkey", "o_orderstatus", t.alias("t"))
    if place:
        c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        out = out.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").drop("c_custkey")
    return out


Parts = list[tuple[str, Callable[[], DataFrame]]]


def order_log(spark: SparkSession, sf_dir: str) -> Parts:
    """order_info and payment_info records."""
    o, placed = orders_at(spark, sf_dir), orders_at(spark, sf_dir, place=True)
    key, t, status = F.col("o_orderkey"), F.col("t"), F.col("o_orderstatus")
    who = {"id": key, "user_id": F.col("o_custkey"), "province_id": F.col("c_nationkey")}

    def moved(df, at, old, new):
        return record(df, "order_info", "update", at,
                      {**who, "order_status": F.lit(new), "operate_time": clock(at)},
                      {"order_status": F.lit(old)})

    paid_at = t + (key % 40) * 60 - 10
    return [
        ("order_info", lambda: record(
            placed, "order_info", "insert", t,
            {**who, "order_status": F.lit("1001"), "create_time": clock(t)})),
        ("order_info", lambda: moved(placed.where(status == "F"), t + (key % 60) * 60,
                                     "1001", "1003")),
        ("order_info", lambda: moved(placed.where(status == "P"), t + 600, "1002", "1005")),
        ("order_info", lambda: moved(placed.where(status == "P"), t + 1200, "1005", "1006")),
        ("payment_info", lambda: record(
            o.where(status == "O"), "payment_info", "update", paid_at,
            {"order_id": key, "user_id": F.col("o_custkey"),
             "payment_type": 1101 + key % 4, "callback_time": clock(paid_at),
             "payment_status": F.lit("1602")}, {"payment_status": F.lit("1601")})),
    ]


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines, the last row of each (order, line)."""
    rest = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag"]
    return (table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber")
            .agg(F.max(F.struct(*rest)).alias("x")).select("l_orderkey", "l_linenumber", "x.*"))


def line_id() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def known(key: Column) -> Column:
    return F.coalesce(text(key), F.lit(""))


def dec(name: str) -> Column:
    return F.col(name).cast(MONEY)


def shares() -> dict[str, Column]:
    price = dec("l_extendedprice")
    return {"split_total_amount": (price * (1 - dec("l_discount"))).cast(MONEY),
            "split_activity_amount": (price * dec("l_discount")).cast(MONEY),
            "split_coupon_amount": (price * dec("l_tax")).cast(MONEY)}


def timed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order and its time."""
    return order_lines(spark, sf_dir).join(orders_at(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))


def line_log(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> Parts:
    """order_detail, activity, coupon and refund records.  ``lines`` are ``timed_lines`` where they have been stored."""
    lines = timed_lines(spark, sf_dir) if lines is None else lines
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    n, sku, coupon, t = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"), F.col("t")
    at = t + n
    refunds = lines.where((F.col("l_returnflag") == "R") & (F.col("o_orderstatus") == "P"))
    num, total = F.col("l_quantity").cast("int"), shares()["split_total_amount"]
    asked, back = t + 600 + n % 8, t + 1200 + n % 8
    # Keys are never null; saying so lets the branches share one pass over the lines.
    line, who = known(line_id()), {"order_id": known(F.col("l_orderkey")), "sku_id": known(sku)}
    return [
        ("order_detail", lambda: record(
            lines.join(part, sku == F.col("p_partkey")), "order_detail", "insert", at,
            {"id": line, **who, "sku_name": F.col("p_name"), "create_time": clock(at),
             "sku_num": num, "order_price": dec("p_retailprice"), **shares()})),
        ("order_detail_activity", lambda: record(
            lines.where(sku % 3 == 0), "order_detail_activity", "insert", at + sku % 15,
            {"order_detail_id": line, "activity_id": sku % 10, "activity_rule_id": sku % 7})),
        ("order_detail_coupon", lambda: record(
            lines.where(coupon % 5 == 0), "order_detail_coupon", "insert", at + coupon % 12,
            {"order_detail_id": line, "coupon_id": coupon % 9})),
        ("order_refund_info", lambda: record(
            refunds, "order_refund_info", "insert", asked,
            {"id": line, **who, "user_id": F.col("o_custkey"), "refund_type": 1501 + n % 2,
             "refund_reason_type": 1301 + sku % 4, "refund_reason_txt": F.lit("see type"),
             "refund_num": num, "refund_amount": total, "create_time": clock(asked)})),
        ("order_refund_info", lambda: record(
            refunds, "order_refund_info", "update", t + 1200 + (n * 3) % 8,
            {"id": line, **who, "refund_num": num, "refund_status": F.lit("0705")},
            {"refund_status": F.lit("0702")})),
        ("refund_payment", lambda: record(
            refunds, "refund_payment", "update", back,
            {"id": line, **who, "payment_type": 1101 + n % 4, "callback_time": clock(back),
             "total_amount": total, "refund_status": F.lit("1602")},
            {"refund_status": F.lit("1601")})),
    ]


def cart_log(spark: SparkSession, sf_dir: str) -> Parts:
    li = table(spark, sf_dir, "lineitem")
    sku, num = F.col("l_partkey"), F.col("l_quantity").cast("int")
    ts = seconds(F.col("l_shipdate")) + F.col("l_orderkey") % 86400
    row = {"id": line_id(), "user_id": F.col("l_suppkey"), "sku_id": sku}
    return [
        ("cart_info", lambda: record(li, "cart_info", "insert", ts, {**row, "sku_num": num})),
        ("cart_info", lambda: record(
            li.where(F.col("l_linenumber") % 2 == 0), "cart_info", "update", ts,
            {**row, "sku_num": num + sku % 7 - 3}, {"sku_num": num})),
    ]


def comment_log(spark: SparkSession, sf_dir: str) -> Parts:
    key = F.col("o_orderkey")
    return [("comment_info", lambda: record(
        orders_at(spark, sf_dir), "comment_info", "insert", F.col("t") + 3600, {
            "id": key, "user_id": F.col("o_custkey"), "sku_id": key % 1000,
            "appraise": 1201 + key % 4, "comment_txt": F.concat(F.lit("comment "), text(key))}))]


def change_log(spark: SparkSession, sf_dir: str, *tables: str, lines: DataFrame | None = None) -> DataFrame:
    """Change-log records of the named tables, or of all.  ``lines``: as in ``line_log``."""
    logs = {order_log: {"order_info", "payment_info"},
            partial(line_log, lines=lines): {"order_detail", "order_detail_activity", "order_detail_coupon",
                       "order_refund_info", "refund_payment"},
            cart_log: {"cart_info"}, comment_log: {"comment_info"},
            customer_log: {"customer_info"}}
    return reduce(DataFrame.unionByName, [
        build() for log, made in logs.items() if not tables or made & set(tables)
        for name, build in log(spark, sf_dir) if not tables or name in tables])


def mixed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_info records of every type, some from another database or empty."""
    o = orders_at(spark, sf_dir)
    key = F.col("o_orderkey")
    types = F.array(*[F.lit(x) for x in ("insert", "update", "delete", "bootstrap-start",
                                         "bootstrap-insert", "bootstrap-complete")])
    base = record(o, "order_info", "insert", F.col("t"), {"id": key, "user_id": F.col("o_custkey")})
    number = F.col("data")["id"].cast("bigint")
    return base.withColumns({
        "type": types[(number % 6).cast("int")],
        "database": F.when(number % 11 == 0, "other").otherwise(F.col("database")),
        "data": F.when(number % 13 == 0, F.create_map().cast("map<string,string>"))
        .when(number % 17 == 0, F.lit(None).cast("map<string,string>"))
        .otherwise(F.col("data"))})


# --- dimensions and rules --------------------------------------------------------------

def dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DICTIONARY, "dic_code string, dic_name string")


def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nation is left out, to have a missing dimension row."""
    n = table(spark, sf_dir, "nation")
    return n.where("n_nationkey <> 24").select(text(F.col("n_nationkey")).alias("id"),
                                               F.col("n_name").alias("name"))


def product_dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    p, n, r = (table(spark, sf_dir, x) for x in ("part", "nation", "region"))
    key = F.col("p_partkey")
    return {
        "sku": p.select(text(key).alias("id"), F.col("p_name").alias("sku_name"),
                        text(F.col("p_size")).alias("spu_id"), F.col("p_brand").alias("tm_id"),
                        text(key % 27).alias("category3_id")),
        "spu": p.where("p_size <> 7").select(
            text(F.col("p_size")).alias("id"),
            F.concat(F.lit("spu "), text(F.col("p_size"))).alias("spu_name")).distinct(),
        "trademark": p.select(F.col("p_brand").alias("id"),
                              F.upper("p_brand").alias("tm_name")).distinct(),
        "category3": n.select(text(F.col("n_nationkey")).alias("id"), F.col("n_name").alias("name"),
                              text(F.col("n_regionkey")).alias("category2_id")),
        "category2": r.select(text(F.col("r_regionkey")).alias("id"), F.col("r_name").alias("name"),
                              text(F.col("r_regionkey") % 2).alias("category1_id")),
        "category1": spark.createDataFrame(CATEGORY1, "id string, name string"),
    }


def customer_log(spark: SparkSession, sf_dir: str) -> Parts:
    """Customers: inserted, some updated with an empty field, deleted, inserted again."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    day = F.lit(1_700_000_000)
    row = {"id": key, "name": F.col("c_name"), "segment": F.col("c_mktsegment"),
           "balance": dec("c_acctbal")}
    none = F.lit(None).cast("string")
    steps = [
        ("insert", 1, 0, row, None),
        ("update", 3, 100_000_000, {"id": key, "name": none, "segment": F.lit(""),
                                    "balance": dec("c_acctbal") + 1},
         {"balance": dec("c_acctbal")}),
        ("delete", 7, 200_000_000, row, None),
        ("insert", 21, 300_000_000, {"id": key, "name": F.col("c_name"),
                                     "segment": F.lit("BACK"), "balance": none}, None),
    ]
    return [("customer_info", lambda op=op, every=every, lag=lag, data=data, old=old: record(
        c.where(key % every == 0), "customer_info", op, day + key + lag, data, old))
        for op, every, lag, data, old in steps]


def rule_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration changes derived from events: each event rewrites or removes the
    rule of one source table and type."""
    e = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", r"\d+", 0).cast("int")
    tables = F.array(*[F.lit(x) for x in ("order_info", "payment_info", "comment_info",
                                          "cart_info", "coupon_use")])
    kinds = F.array(F.lit("insert"), F.lit("update"))
    source = tables[(F.col("user_id") % 5).cast("int")]
    rule = F.struct(
        source.alias("source_table"), kinds[k % 2].alias("source_type"),
        F.concat(F.lit("fact_"), source, F.lit("_"), kinds[k % 2]).alias("sink_table"),
        F.when(k % 3 == 0, "id,user_id").when(k % 3 == 1, "id,order_status,appraise")
        .otherwise("id,order_id, user_id").alias("sink_columns"))
    op = F.when(k % 10 == 9, "d").when(F.col("event_id") < 10, "r").when(k % 4 == 0, "c").otherwise("u")
    none = F.lit(None)
    return e.select(op.alias("op"), F.when(op.isin("u", "d"), rule).otherwise(none).alias("before"),
                    F.when(op != "d", rule).otherwise(none).alias("after"),
                    millis(F.col("ts")).alias("ts_ms"), "event_id")


def dim_rules(spark: SparkSession) -> DataFrame:
    """Dimension rules as configuration rows."""
    return spark.createDataFrame(
        [("customer_info", "dim_customer", "id,name,segment,balance", "info", "id"),
         ("order_info", "dim_order", "id,user_id", "info", "id")],
        "source_table string, sink_table string, sink_columns string, sink_family string, "
        "sink_row_key string")


# --- repeated facts -----------------------------------------------------------------------

def repeated_lines(spark: SparkSession, sf_dir: str, place: bool = True) -> DataFrame:
    """The order lines as they are, with ``id``, their time ``ts`` and, for ``place``, the province; one
    (order, line) occurs more than once, some repeats within ten seconds and some later."""
    o = orders_at(spark, sf_dir, place)
    li = table(spark, sf_dir, "lineitem")
    ts = F.col("t") + F.col("l_linenumber") + F.col("l_suppkey") % 25
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).withColumns({"id": line_id(), "ts": ts})


def ids_tell_orders(spark: SparkSession, sf_dir: str) -> bool:
    """Whether lines of one id belong to one order: those numbered from 0 to 9 do."""
    stray = ~F.coalesce(F.col("l_linenumber").between(0, 9), F.lit(False))
    return table(spark, sf_dir, "lineitem").where(stray).isEmpty()


def details(lines: DataFrame, *more: Column | str) -> DataFrame:
    """``repeated_lines`` as order-detail facts, with further columns."""
    num = F.col("l_quantity").cast("int")
    return lines.select(
        text(F.col("id")).alias("id"), text(F.col("l_orderkey")).alias("order_id"),
        text(F.col("l_partkey")).alias("sku_id"), *more,
        text(num).alias("sku_num"), text((num * dec("l_extendedprice")).cast(MONEY)).alias("split_original_amount"),
        *[text(c).alias(name) for name, c in shares().items()],
        "ts", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def repeated_details(spark: SparkSession, sf_dir: str, place: bool = True) -> DataFrame:
    """Order-detail facts straight from the order lines, with their repeats.  Without
    ``place`` there is no province, and the key the lines were joined by stands beside."""
    return details(repeated_lines(spark, sf_dir, place),
                   text(F.col("c_nationkey")).alias("province_id") if place else "l_orderkey")


TIE_BREAK = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
