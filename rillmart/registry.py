"""The registered queries over the provided tables, with their SQL twins."""

from __future__ import annotations

import functools
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillmart import fixtures as fx, oracle as sql, schemas
from rillmart.functions import timefmt
from rillmart.functions.fields import amount, json_record
from rillmart.functions.text import explode_words, register_words, word_list
from rillmart.operators import changelog, dims, joins, keyed, routing
from rillmart.operators.logsplit import split_log_json
from rillmart.operators.windows import event_time
from rillmart.plans import facts, trade, traffic
from rillmart.session import shared_dir, tune
from rillmart.sources import files, readers, sinks
from rillmart.sources.readers import Topic
from rillmart.streaming import jobs
from rillmart.streaming.lookups import DimVersions, RuleBook
from rillmart.streaming.results import ResultTable

SECOND, HOUR, DAY = 1_000, 3_600_000, 86_400_000
Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query.  The tables hold zone-less times; they are read as UTC."""
    def add(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark, "UTC"), sf_dir)
        _QUERIES[name] = run
        if oracle:
            _SQL[name] = oracle
        return run
    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- traffic summaries ------------------------------------------------------------------

@query("page_view_w1d", sql.page_view(DAY))
def page_view_w1d(spark, sf):
    return traffic.page_view(fx.page_log(spark, sf), "1 day")


@query("page_view_w10", sql.page_view(10 * SECOND))
def page_view_w10(spark, sf):
    return traffic.page_view(fx.page_log(spark, sf))


@query("home_detail_uv_w1h", sql.home_detail(HOUR))
def home_detail_uv(spark, sf):
    return traffic.home_detail_uv(fx.page_log(spark, sf), "1 hour")


@query("user_login_w1h", sql.user_login(HOUR))
def user_login(spark, sf):
    return traffic.user_login(fx.page_log(spark, sf), "1 hour")


@query("cart_add_uu_w1h", sql.cart_uu(HOUR))
def cart_add_uu(spark, sf):
    return trade.cart_add_uu(fx.cart_facts(spark, sf), "1 hour")


@query("keyword_pv", sql.keyword(10 * SECOND))
def keyword_pv(spark, sf):
    return traffic.keyword_pv(fx.search_log(fx.table(spark, sf, "documents")))


@query("keyword_pv_sql", sql.keyword(10 * SECOND))
def keyword_pv_sql(spark, sf):
    """The same job written as SQL over views, with the segmenter as a table function."""
    register_words(spark)
    event_time(fx.search_log(fx.table(spark, sf, "documents"))).createOrReplaceTempView("page_log")
    return spark.sql("""
        SELECT date_format(w.start, 'yyyy-MM-dd HH:mm:ss') AS stt,
               date_format(w.end, 'yyyy-MM-dd HH:mm:ss') AS edt,
               date_format(w.start, 'yyyy-MM-dd') AS cur_date, keyword, keyword_count
        FROM (SELECT window(et, '10 seconds') AS w, t.word AS keyword, count(*) AS keyword_count
              FROM page_log, LATERAL segment_words(page['item']) AS t
              WHERE page['last_page_id'] = 'search' AND page['item_type'] = 'keyword'
                AND page['item'] IS NOT NULL
              GROUP BY window(et, '10 seconds'), t.word)""")


@query("dictionary_words", sql.DICTIONARY_WORDS)
def dictionary_words(spark, sf):
    """How often the words of product names, and stretches of them, are cut out of each language's texts."""
    part = fx.table(spark, sf, "part")
    token = F.explode(F.split(F.lower(F.concat_ws(" ", "p_name", "p_type")), " ")).alias("w")
    w = F.col("w")
    drawn = part.select(token).distinct().select(F.explode(F.array(w, F.substring(w, 1, 3), F.substring(w, 2, 3))).alias("w"))
    listed = word_list(drawn.where(F.char_length("w") > 1))
    docs = fx.table(spark, sf, "documents").select("lang", "text")
    cut = explode_words(docs, "text", "word", listed, everywhere=True)
    known = spark.createDataFrame([(x,) for x in listed], "word string")
    return cut.groupBy("lang", "word").agg(F.count("*").alias("n")).join(known, "word", "left_semi").select("lang", "word", "n")


@query("daily_unique_flag", sql._with(sql.VISITS) + """SELECT event_id, mid, ms AS ts,
    CAST(row_number() OVER (PARTITION BY mid, day ORDER BY ms, event_id) = 1 AS INT) AS uv_ct FROM v""")
def daily_unique_flag(spark, sf):
    rows = fx.visits(fx.table(spark, sf, "events")).select(
        "event_id", F.col("common")["mid"].alias("mid"), "ts")
    return keyed.flag_first_of_day(rows, ["mid"], ["event_id"])


# --- client log -----------------------------------------------------------------------------

def client_log(spark, sf):
    return changelog.parse_json(fx.raw_log(fx.table(spark, sf, "events")), schemas.CLIENT_LOG,
                                on_error="drop")


def log_columns():
    common, page = F.col("common"), F.col("page")
    return [*[common[c].alias(c) for c in ("mid", "uid", "is_new", "vc", "ch", "ar")],
            page["page_id"].alias("page_id"), page["last_page_id"].alias("last_page_id"),
            page["during_time"].cast("bigint").alias("during_time")]


@query("new_visitor_repair", sql.log(f"SELECT {sql.LOG_COLUMNS}, ms AS ts FROM log"))
def new_visitor_repair(spark, sf):
    return traffic.repaired_log(client_log(spark, sf)).select(*log_columns(), "ts")


@query("log_dirty", "SELECT 'not json {' AS value FROM events WHERE event_id % 97 = 0")
def log_dirty(spark, sf):
    return changelog.dirty_records(fx.raw_log(fx.table(spark, sf, "events")), schemas.CLIENT_LOG)


@query("log_split_err", sql.log(f"""SELECT {sql.LOG_COLUMNS}, CAST(k AS VARCHAR) AS err_code,
    CAST(k % 3 AS BIGINT) AS displays, CAST(k % 2 AS BIGINT) AS actions, ms AS ts
    FROM log WHERE has_err"""))
def log_split_err(spark, sf):
    return traffic.log_facts(client_log(spark, sf))["err"].select(
        *log_columns(), F.col("err")["code"].alias("err_code"),
        F.size("displays").cast("bigint").alias("displays"),
        F.size("actions").cast("bigint").alias("actions"), "ts")


@query("log_split_start", sql.log(f"""SELECT {sql.LOG_COLUMNS}, 'icon' AS entry, ms AS ts
    FROM log WHERE has_start"""))
def log_split_start(spark, sf):
    return traffic.log_facts(client_log(spark, sf))["start"].select(
        *log_columns(), F.col("start")["entry"].alias("entry"), "ts")


@query("log_split_display", sql.log(f"""SELECT {sql.LOG_COLUMNS}, CAST(k AS VARCHAR) AS item,
    CAST(pos AS VARCHAR) AS pos, ms AS ts
    FROM log, (VALUES (1), (2)) p(pos) WHERE NOT has_start AND pos <= k % 3"""))
def log_split_display(spark, sf):
    return traffic.log_facts(client_log(spark, sf))["display"].select(
        *log_columns(), F.col("display")["item"].alias("item"),
        F.col("display")["pos"].alias("pos"), "ts")


@query("log_split_action", sql.log(f"""SELECT {sql.LOG_COLUMNS}, 'favor_add' AS action_id,
    CAST(ms AS VARCHAR) AS action_ts FROM log WHERE NOT has_start AND k % 2 = 1"""))
def log_split_action(spark, sf):
    return traffic.log_facts(client_log(spark, sf))["action"].select(
        *log_columns(), F.col("action")["action_id"].alias("action_id"),
        F.col("action")["ts"].alias("action_ts"))


@query("log_split_page", sql.log(f"""SELECT {sql.LOG_COLUMNS},
    k % 3 = 0 AS empty_displays, k % 2 = 0 AS empty_actions, ms AS ts FROM log WHERE NOT has_start"""))
def log_split_page(spark, sf):
    return traffic.log_facts(client_log(spark, sf))["page"].select(
        *log_columns(), F.col("displays").isNotNull().alias("empty_displays"),
        F.col("actions").isNotNull().alias("empty_actions"), "ts")


SENT = """
    SELECT 'err' AS topic, mid, fixed AS is_new, page_id, CAST(k AS VARCHAR) AS detail, ms AS ts FROM log WHERE has_err
    UNION ALL SELECT 'start', mid, fixed, page_id, 'icon', ms FROM log WHERE has_start
    UNION ALL SELECT 'page', mid, fixed, page_id, CAST(dur AS VARCHAR), ms FROM log WHERE NOT has_start
    UNION ALL SELECT 'display', mid, fixed, page_id, k || ':' || pos, ms
      FROM log, (VALUES (1), (2)) p(pos) WHERE NOT has_start AND pos <= k % 3
    UNION ALL SELECT 'action', mid, fixed, page_id, 'favor_add', ms FROM log WHERE NOT has_start AND k % 2 = 1"""
SENT_LOG = sql.log(SENT)


def sent_log(lines):
    """What the five targets were sent, parsed again."""
    text = "map<string,string>"
    fact = F.from_json("value", f"common {text}, page {text}, start {text}, err {text}, display {text}, "
                                f"action {text}, ts bigint").alias("r")
    common, page, topic = F.col("r.common"), F.col("r.page"), F.col("topic")
    detail = (F.when(topic == "err", F.col("r.err")["code"]).when(topic == "start", F.col("r.start")["entry"])
              .when(topic == "page", page["during_time"]).when(topic == "action", F.col("r.action")["action_id"])
              .otherwise(F.concat_ws(":", F.col("r.display")["item"], F.col("r.display")["pos"])))
    ts = F.coalesce(F.col("r.ts"), F.col("r.action")["ts"].cast("bigint"))
    return lines.select("topic", fact).select("topic", common["mid"].alias("mid"), common["is_new"].alias("is_new"),
                                              page["page_id"].alias("page_id"), detail.alias("detail"), ts.alias("ts"))


@query("log_fan_out", SENT_LOG)
def log_fan_out(spark, sf):
    return sent_log(split_log_json(traffic.repaired_log(client_log(spark, sf))))


# --- change log filters -----------------------------------------------------------------------

@query("changes_insert", sql._with(sql.ORDERS) + """SELECT CAST(o_orderkey AS VARCHAR) AS id,
    CAST(o_custkey AS VARCHAR) AS user_id, CAST(c_nationkey AS VARCHAR) AS province_id, t AS ts FROM o""")
def changes_insert(spark, sf):
    return changelog.changes(fx.change_log(spark, sf, "order_info"), "order_info", "insert",
                             ["id", "user_id", "province_id"])


@query("changes_transition", sql._with(sql.ORDERS) + f"""SELECT CAST(o_orderkey AS VARCHAR) AS id,
    {sql.ts_text(sql._CANCEL)} AS operate_time, {sql._CANCEL} AS ts FROM o WHERE o_orderstatus = 'F'""")
def changes_transition(spark, sf):
    return changelog.changes(fx.change_log(spark, sf, "order_info"), "order_info", "update",
                             ["id", "operate_time"], was={"order_status": facts.UNPAID},
                             now={"order_status": facts.CANCELLED})


@query("changes_to_value", sql._with(sql.ORDERS) + f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
    CAST(1101 + o_orderkey % 4 AS VARCHAR) AS payment_type, {sql._PAID} AS ts
    FROM o WHERE o_orderstatus = 'O'""")
def changes_to_value(spark, sf):
    return changelog.changes(fx.change_log(spark, sf, "payment_info"), "payment_info", "update",
                             ["order_id", "payment_type"], changed=["payment_status"],
                             now={"payment_status": facts.PAID})


@query("cart_add_delta", sql.CART_ADD)
def cart_add_delta(spark, sf):
    return facts.cart_add(fx.change_log(spark, sf, "cart_info"))


@query("etl_gate", sql.ETL_GATE)
def etl_gate(spark, sf):
    return changelog.etl_gate(fx.mixed_log(spark, sf), fx.DATABASE).select(
        F.col("data")["id"].alias("id"), "type", "ts")


@query("drop_bootstrap", sql.DROP_BOOTSTRAP)
def drop_bootstrap(spark, sf):
    return changelog.drop_bootstrap(fx.mixed_log(spark, sf)).select(
        F.col("data")["id"].alias("id"), "type", "database", "ts")


# --- facts ----------------------------------------------------------------------------------

def timed_log(spark, sf, *tables, lines=None):
    return event_time(fx.change_log(spark, sf, *tables, lines=lines), "s")


def detail_fact(spark, sf, lines=None):
    return facts.order_detail(timed_log(spark, sf, "order_info", "order_detail",
                                        "order_detail_activity", "order_detail_coupon", lines=lines))


@query("order_detail", sql.ORDER_DETAIL)
def order_detail(spark, sf):
    return facts.published(detail_fact(spark, sf))


@query("order_cancel", sql.ORDER_CANCEL)
def order_cancel(spark, sf):
    return facts.published(facts.order_cancel(timed_log(spark, sf, "order_info"), detail_fact(spark, sf)))


@query("pay_success", sql.PAY_SUCCESS)
def pay_success(spark, sf):
    return facts.published(facts.pay_success(timed_log(spark, sf, "payment_info"),
                                             detail_fact(spark, sf), fx.dictionary(spark)))


@query("refund", sql.REFUND)
def refund(spark, sf):
    return facts.published(facts.refund(timed_log(spark, sf, "order_info", "order_refund_info"), fx.dictionary(spark)))


@query("refund_pay", sql.REFUND_PAY)
def refund_pay(spark, sf):
    return facts.published(facts.refund_pay(timed_log(
        spark, sf, "order_info", "order_refund_info", "refund_payment"), fx.dictionary(spark)))


@query("comment_dic", sql.COMMENT)
def comment_dic(spark, sf):
    return facts.comment(fx.change_log(spark, sf, "comment_info"), fx.dictionary(spark))


# --- joins ----------------------------------------------------------------------------------

@query("interval_join", """
    SELECT a.event_id AS left_id, b.event_id AS right_id, a.user_id AS user_id
    FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'click'
      AND b.event_type = 'purchase' AND epoch_us(b.ts) // 1000 BETWEEN epoch_us(a.ts) // 1000 - 600000 AND epoch_us(a.ts) // 1000 + 1800000""")
def interval_join(spark, sf):
    e = event_time(fx.table(spark, sf, "events").withColumn("ms", fx.millis(F.col("ts"))), ts="ms")
    clicks = e.where("event_type = 'click'").select(F.col("event_id").alias("left_id"), "user_id", "et")
    buys = e.where("event_type = 'purchase'").select(
        F.col("event_id").alias("right_id"), F.col("user_id").alias("_user"), "et")
    return joins.interval_join(clicks, buys, [("user_id", "_user")], -600, 1800,
                               sliced=True).select("left_id", "right_id", "user_id")


def join_sides(spark, sf):
    """Orders of every fifth customer point to a customer that does not exist."""
    o, c = fx.table(spark, sf, "orders"), fx.table(spark, sf, "customer")
    who = F.when(F.col("o_custkey") % 5 == 0, -F.col("o_custkey") - 1).otherwise(F.col("o_custkey"))
    return o.select("o_orderkey", who.alias("who")), c.select("c_custkey", "c_name")


def _register_join(how: str) -> None:
    @query(f"join_{how}", f"""SELECT o_orderkey, c_custkey, c_name FROM (
        SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 THEN -o_custkey - 1 ELSE o_custkey END AS who
        FROM orders) {how.upper()} JOIN customer ON who = c_custkey""")
    def run(spark, sf):
        o, c = join_sides(spark, sf)
        return joins.regular_join(o, c, [("who", "c_custkey")], how).select(
            "o_orderkey", "c_custkey", "c_name")


for _how in ("inner", "left", "right", "full"):
    _register_join(_how)


# --- repeats and trade summaries ------------------------------------------------------------------

@query("dedup_cancel_out", sql.CANCEL_OUT)
def dedup_cancel_out(spark, sf):
    """Lines are marked as they are; texts and amounts, which take twice the bytes, are made of them afterwards."""
    lines = fx.repeated_lines(spark, sf)
    near = ["l_orderkey"] if fx.ids_tell_orders(spark, sf) else []
    marked = keyed.mark_superseded(lines, "id", fx.TIE_BREAK, 10, near=near, carry=["l_discount", "l_tax"])
    measures = list(trade.SKU_MEASURES.values())
    typed = fx.details(marked, "superseded").withColumns({m: amount(F.col(m)) for m in measures})
    return keyed.reversals(typed, measures).select("id", "order_id", "sku_id", "ts", *measures)


@query("dedup_latest", sql.LATEST)
def dedup_latest(spark, sf):
    rows = fx.repeated_details(spark, sf)
    return keyed.latest_per_key(rows, ["id"], ["ts", *fx.TIE_BREAK]).select(
        "id", "order_id", "sku_id", "province_id", "split_total_amount", "ts")


@query("province_order_w10", sql.province_order(10 * SECOND))
def province_order_w10(spark, sf):
    return trade.province_order(fx.repeated_details(spark, sf), fx.provinces(spark, sf),
                                order=fx.TIE_BREAK)


@query("province_order_w1d", sql.province_order(DAY))
def province_order_w1d(spark, sf):
    return trade.province_order(fx.repeated_details(spark, sf), fx.provinces(spark, sf), "1 day",
                                fx.TIE_BREAK)


def products(spark, sf):
    return dims.flatten_products(**fx.product_dims(spark, sf))


@query("sku_order_w10", sql.sku_order(10 * SECOND))
def sku_order_w10(spark, sf):
    return trade.sku_order(fx.repeated_details(spark, sf, place=False), products(spark, sf), order=fx.TIE_BREAK,
                           near=["l_orderkey"])


@query("sku_order_w1d", sql.sku_order(DAY))
def sku_order_w1d(spark, sf):
    return trade.sku_order(fx.repeated_details(spark, sf, place=False), products(spark, sf), "1 day",
                           fx.TIE_BREAK, near=["l_orderkey"])


# --- rules and dimensions ----------------------------------------------------------------------------

def fact_rules(spark, sf):
    return routing.latest_rules(routing.rule_events(fx.rule_log(spark, sf)),
                                ["source_table", "source_type"], ["ts_ms", "event_id"])


@query("rules_latest", sql.RULES_LATEST)
def rules_latest(spark, sf):
    return fact_rules(spark, sf).select("source_table", "source_type", "sink_table", "sink_columns")


@query("route_fact", sql.ROUTE_FACT)
def route_fact(spark, sf):
    log = changelog.drop_bootstrap(fx.change_log(
        spark, sf, "order_info", "payment_info", "comment_info"))
    routed = routing.route_facts(log, fact_rules(spark, sf))
    return routed.select("sink_table", "ts", *[F.col("data")[c].alias(c) for c in (
        "id", "user_id", "order_id", "order_status", "appraise")])


ORDER = ["ts", "offset"]


def numbered(log):
    """Change-log rows of the tables with the offset a topic would give them."""
    return log.withColumn("offset", F.xxhash64("table", "type", "ts", F.to_json("data")))


def dim_changes(spark, sf, *tables):
    log = changelog.etl_gate(fx.change_log(spark, sf, *tables), fx.DATABASE)
    log = numbered(log)
    return routing.route_dims(log, fx.dim_rules(spark), ORDER)


@query("route_dim", sql.ROUTE_DIM)
def route_dim(spark, sf):
    return dim_changes(spark, sf, "customer_info", "order_info").select("sink_table", "row_key", "op", "ts", *[
        F.col("data")[c].alias(c) for c in ("id", "name", "segment", "balance")])


def folded_customers(spark, sf, resets=None):
    routed = dim_changes(spark, sf, "customer_info")
    return dims.dim_table(dims.fold_dims(routed, ORDER, resets), "dim_customer",
                          ["id", "name", "segment", "balance"])


@query("dim_fold", sql.DIM_FOLD)
def dim_fold(spark, sf):
    return folded_customers(spark, sf)


@query("dim_reset", sql.DIM_RESET)
def dim_reset(spark, sf):
    """The rule of the dimension was changed between the inserts and the updates."""
    events = spark.createDataFrame(
        [("r", "dim_customer", 0), ("u", "dim_customer", 1_780_000_000_000)],
        "op string, sink_table string, ts_ms bigint")
    return folded_customers(spark, sf, routing.dim_resets(events)).drop("id")


# --- scalars -------------------------------------------------------------------------------------------

@query("time_functions", """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS moment, strftime(ts, '%Y%m%d') AS compact,
    epoch_us(ts) // 1000000 * 1000 AS back_to_ms,
    epoch_us(ts) // 86400000000 * 86400000 AS midnight, epoch_us(ts) // 1000000 AS seconds FROM events""")
def time_functions(spark, sf):
    e = fx.table(spark, sf, "events").select("event_id", fx.millis(F.col("ts")).alias("ms"))
    ms = F.col("ms")
    return e.select("event_id", timefmt.millis_to_date(ms).alias("day"),
                    timefmt.millis_to_datetime(ms).alias("moment"),
                    timefmt.millis_to_compact_date(ms).alias("compact"),
                    timefmt.text_to_millis(timefmt.millis_to_datetime(ms)).alias("back_to_ms"),
                    timefmt.date_to_millis(timefmt.millis_to_date(ms)).alias("midnight"),
                    F.unix_seconds(timefmt.from_millis(ms)).alias("seconds"))


@query("json_out", sql.JSON_OUT)
def json_out(spark, sf):
    """Rows as the JSON lines a sink writes, with nulls and quoted texts among them."""
    e = fx.table(spark, sf, "events")
    rare = F.when(F.col("event_id") % 7 != 0, F.col("event_type"))
    quoted = F.concat(F.lit('say "'), F.col("event_type"), F.lit('" \\ '), F.col("props"))
    rows = e.select("event_id", "user_id", rare.alias("event_type"), quoted.alias("text"))
    return rows.select(json_record("event_id", "user_id", "event_type", "text").alias("value"))


# --- streams ---------------------------------------------------------------------------------------------
#
# Each stream reads lines that Spark derives from the tables and has written to the
# shared folder as a topic would hold them.  A last heartbeat line far in the future
# moves the watermark over all windows; what it belongs to stays open and unseen.

HEARTBEAT = 4_000_000_000


PARTS, FILES = 4, 4


def topic_in_turn(spark, name, parts):
    """Write a topic of ``FILES`` files for each part; a stream reads one part after another."""
    where = shared_dir(spark, f"topic-{name}")
    for lines in parts:
        lines.repartition(FILES).write.mode("append").text(where)
    return Topic(where, options={"maxFilesPerTrigger": str(FILES)})


def in_parts(spark, name, lines, part):
    """Deal lines (``value`` and what ``part`` reads) out to the parts of a topic, in one pass and without a shuffle.

    The times of the files put the parts in order.  All parts get as many files, some of them empty, so
    that each is a micro-batch.
    """
    where = shared_dir(spark, f"topic-{name}")
    lines.select("value", part.alias("part")).write.partitionBy("part").text(where, compression="gzip")
    found = [files.names(spark, f"{where}/part={k}/part-*", 2) for k in range(PARTS)]
    most, now = max(1, *map(len, found)), int(time.time()) * 1000
    for k, own in enumerate(found):
        for n in range(len(own), most):
            own.append(f"part={k}/none-{n}")
            files.write_text(spark, f"{where}/{own[-1]}", "")
        if not all([files.set_time(spark, f"{where}/{f}", now - (PARTS - k) * 1000) for f in own]):
            # A store that dates files itself: write one part after another.
            return topic_in_turn(spark, name, [spark.read.text(f"{where}/part={k}") for k in range(PARTS)])
    return Topic(where, options={"maxFilesPerTrigger": str(most)})


def as_lines(rows, *columns):
    """Rows as lines of a topic, with their times beside them."""
    return rows.select(json_record(*columns or rows.columns).alias("value"), F.col("ts").alias("at"))


def topic(spark, name, lines):
    """Write lines of a topic in ``PARTS`` slices of time and return where they are.  Times that stand beside the
    lines, as ``at``, are cut without rendering a line; others are read from the lines, which are derived once for that."""
    if "at" in lines.columns:
        return in_slices(spark, name, lines)
    at = F.coalesce(F.get_json_object("value", "$.ts"), F.get_json_object("value", "$.ts_ms")).cast("bigint")
    timed = lines.withColumn("at", at).persist()
    try:
        return in_slices(spark, name, timed)
    finally:
        timed.unpersist()


def in_slices(spark, name, lines):
    at = F.coalesce("at", F.lit(0))
    cuts = lines.select(at.alias("at")).approxQuantile("at", [k / PARTS for k in range(1, PARTS)], 0.01)
    return in_parts(spark, name, lines, sum(((at > F.lit(int(c))).cast("int") for c in cuts), F.lit(0)))


def beat(df, **fields):
    """One row of the same shape in the far future."""
    one = df.sparkSession.range(1)
    cols = [fields[f.name].cast(f.dataType).alias(f.name) if f.name in fields
            else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema]
    return df.unionByName(one.select(*cols))


def page_stream(spark, sf, deal=None):
    rows = as_lines(fx.page_log(spark, sf), "common", "page", "ts")
    return readers.read_page_log(spark, (deal or topic)(spark, "page", rows), delay=None)


def summed(spark, where, columns, sums):
    return sinks.read_summed(spark, where, [c for c in columns if c not in sums], sums).select(*columns)


def page_view_stream(spark, sf, deal=None):
    where = jobs.page_view(page_stream(spark, sf, deal))
    return summed(spark, where, schemas.PAGE_VIEW, ["uv_ct", "sv_ct", "pv_ct", "dur_sum"])


@query("stream_page_view_results", sql.page_view(10 * SECOND))
def stream_page_view_results(spark, sf):
    """Windows kept in a result table, all sent a second time under other batch numbers."""
    changes, root = jobs.page_view(page_stream(spark, sf)), shared_dir(spark, "results")
    sums = ["uv_ct", "sv_ct", "pv_ct", "dur_sum"]
    table = ResultTable(spark, f"{root}/table", spark.read.parquet(changes).select(*schemas.PAGE_VIEW), sums)
    table.load(changes, f"{root}/first", maxFilesPerTrigger="2")
    table.load(changes, f"{root}/again", maxFilesPerTrigger="3")
    return table.rows()


def home_detail_stream(spark, sf, deal=None):
    where = jobs.home_detail_uv(page_stream(spark, sf, deal), "1 hour")
    return summed(spark, where, schemas.HOME_DETAIL_UV, ["home_uv_ct", "good_detail_uv_ct"])


def user_login_stream(spark, sf, deal=None):
    where = jobs.user_login(page_stream(spark, sf, deal), "1 hour")
    return summed(spark, where, schemas.USER_LOGIN, ["back_ct", "uu_ct"])


def cart_add_uu_stream(spark, sf, deal=None):
    lines = as_lines(fx.cart_facts(spark, sf), *schemas.CART_ADD)
    cart = readers.read_fact(spark, (deal or topic)(spark, "cart", lines), schemas.CART_ADD)
    return summed(spark, jobs.cart_add_uu(cart, "1 hour"), schemas.CART_ADD_UU, ["cart_add_uu_ct"])


@query("stream_keyword_pv", sql.keyword(10 * SECOND))
def stream_keyword_pv(spark, sf):
    page = F.create_map(*[F.lit(x) for x in ("last_page_id", "search", "item_type", "keyword",
                                             "item", "beat")])
    rows = beat(fx.search_log(fx.table(spark, sf, "documents")), page=page,
                ts=F.lit(HEARTBEAT * 1000))
    lines = topic(spark, "search", as_lines(rows, "common", "page", "ts"))
    return jobs.run_available(traffic.keyword_pv(readers.read_page_log(spark, lines)), "keyword")


def split_lines(spark, where):
    return sent_log(spark.read.schema("value string, topic string").json(f"{where}/facts"))


@query("stream_log_split", SENT_LOG)
def stream_log_split(spark, sf):
    """The five facts, each line sent to its own target by one writer."""
    lines = readers.read_lines(spark, topic(spark, "log", fx.raw_log(fx.table(spark, sf, "events"))))
    return split_lines(spark, jobs.split_log(lines))


@query("stream_log_split_ttl", sql.log_with_ttl(SENT))
def stream_log_split_ttl(spark, sf):
    """First days are forgotten after a day, in the middle of a micro-batch or between two."""
    lines = readers.read_lines(spark, topic(spark, "log", fx.raw_log(fx.table(spark, sf, "events"))))
    return split_lines(spark, jobs.split_log(lines, ttl=DAY))


@query("stream_log_split_late", SENT_LOG)
def stream_log_split_late(spark, sf):
    """Four files: every device's first record, then the other rows in no order of time."""
    events = fx.table(spark, sf, "events")
    rows = fx.visits(events).select("event_id", F.col("common")["mid"].alias("mid"), "ts")
    firsts = rows.where("event_id % 97 <> 0").groupBy("mid").agg(F.min("ts").alias("first"))
    part = F.when(F.col("ts") == F.col("first"), 0).otherwise(1 + F.pmod(F.xxhash64("event_id"), F.lit(3)))
    parts = rows.join(firsts, "mid").select("event_id", part.alias("part"))
    dealt = events.join(parts, "event_id").persist()
    try:
        where = topic_in_turn(spark, "log", [fx.raw_log(dealt.where(F.col("part") == k)) for k in range(PARTS)])
    finally:
        dealt.unpersist()
    return split_lines(spark, jobs.split_log(readers.read_lines(spark, where)))


@query("stream_log_dirty", _SQL["log_dirty"])
def stream_log_dirty(spark, sf):
    lines = readers.read_lines(spark, topic(spark, "log", fx.raw_log(fx.table(spark, sf, "events"))))
    return jobs.run_available(jobs.dirty_lines(lines), "log-dirty")


def change_topic(spark, sf, *tables):
    rows = fx.change_log(spark, sf, *tables)
    for name in tables:
        ids = {f: F.lit("beat") for f in ("id", "order_id", "order_detail_id", "sku_id")}
        data = F.create_map(*[x for f, v in ids.items() for x in (F.lit(f), v)])
        rows = beat_row(rows, name, data)
    return topic(spark, "db", as_lines(rows))


def beat_row(rows, name, data):
    return beat(rows, database=F.lit(fx.DATABASE), table=F.lit(name), type=F.lit("insert"),
                data=data, ts=F.lit(HEARTBEAT))


def change_stream(spark, sf, *tables):
    return readers.read_changelog(spark, change_topic(spark, sf, *tables))


def out_of_order(spark, name, lines):
    """Write lines of a topic in parts with no order of time between them."""
    return in_parts(spark, name, lines, F.pmod(F.xxhash64("value"), F.lit(PARTS)))


# The provided orders lie thin over seven years, so their parts are wide.
WIDTH = 90 * 86_400


def joined_folder(spark, sf, fact, tables, plan, deal, with_detail=False, dims=None):
    """A fact joined from the change log of some tables, and from order details as a topic."""
    log = fx.change_log(spark, sf, *tables)
    lines = deal(spark, "db", as_lines(log))
    sides = {"log": readers.read_changelog(spark, lines, delay=None).drop("pt")}
    if with_detail:
        details = deal(spark, "order-detail", as_lines(detail_rows(spark, sf)))
        sides["detail"] = readers.read_fact(spark, details, schemas.ORDER_DETAIL)
    return jobs.join_facts(sides, lambda **s: owned(plan(**s)), facts.REACH[fact], fact, width=WIDTH, dims=dims,
                           marked=True, spans=True)


def owned(fact):
    """A fact as it is published, with the time of its left-most row, which it belongs to."""
    return facts.published(fact.withColumn(jobs.OWN, F.unix_seconds("et")))


def detail_rows(spark, sf):
    """The published order details, worked out for some of the line ids at a time and stored, which bounds what lies
    in shuffles at once.  What an id is joined with by itself has the same id; orders are whole in each step."""
    at, where = shared_dir(spark, "lines"), shared_dir(spark, "details")
    lines = fx.timed_lines(spark, sf)
    lines.write.option("compression", "zstd").parquet(at)
    read = spark.read.schema(lines.schema).parquet(at)
    for k in range(PARTS):
        rows = facts.published(detail_fact(spark, sf, read.where(F.pmod(F.xxhash64(fx.line_id()), F.lit(PARTS)) == k)))
        rows.write.mode("append").option("compression", "zstd").parquet(where)
    files.delete(spark, at)
    return spark.read.schema(rows.schema).parquet(where)


def published_dictionary(spark, without=()):
    """The dictionary as a dimension that streams look up."""
    dic = DimVersions(spark, shared_dir(spark, "dic"), "dic_code string, dic_name string")
    dic.publish(fx.dictionary(spark).where(~F.col("dic_code").isin(*without)))
    return dic


def joined_stream(spark, *args, **more):
    return sinks.read_counted(spark, joined_folder(spark, *args, **more))


def order_detail_stream(spark, sf, deal=topic):
    tables = ["order_info", "order_detail", "order_detail_activity", "order_detail_coupon"]
    return joined_stream(spark, sf, "order_detail", tables, facts.order_detail, deal)


def order_cancel_stream(spark, sf, deal=topic):
    return joined_stream(spark, sf, "order_cancel", ["order_info"], facts.order_cancel, deal, True)


def pay_success_stream(spark, sf, deal=topic):
    return joined_stream(spark, sf, "pay_success", ["payment_info"], facts.pay_success, deal, True,
                         dims={"dic": published_dictionary(spark)})


def refund_stream(spark, sf, deal=topic):
    return joined_stream(spark, sf, "refund", ["order_info", "order_refund_info"], facts.refund, deal,
                         dims={"dic": published_dictionary(spark)})


def refund_pay_stream(spark, sf, deal=topic):
    return joined_stream(spark, sf, "refund_pay", ["order_info", "order_refund_info", "refund_payment"],
                         facts.refund_pay, deal, dims={"dic": published_dictionary(spark)})


for _name, _stream, _twin in (
        ("stream_order_detail", order_detail_stream, sql.ORDER_DETAIL),
        ("stream_order_cancel", order_cancel_stream, sql.ORDER_CANCEL),
        ("stream_pay_success", pay_success_stream, sql.PAY_SUCCESS),
        ("stream_refund", refund_stream, sql.REFUND),
        ("stream_refund_pay", refund_pay_stream, sql.REFUND_PAY)):
    query(_name, _twin)(_stream)
    query(f"{_name}_late", _twin)(functools.partial(_stream, deal=out_of_order))


@query("stream_cart_add", sql.CART_ADD)
def stream_cart_add(spark, sf):
    log = fx.change_log(spark, sf, "cart_info")
    lines = topic(spark, "db", as_lines(log))
    return jobs.run_available(facts.cart_add(readers.read_changelog(spark, lines, delay=None)), "cart-add")


@query("stream_comment", sql.COMMENT)
def stream_comment(spark, sf):
    rows = facts.comment(change_stream(spark, sf, "comment_info"), fx.dictionary(spark))
    return jobs.run_available(rows, "comment")


@query("stream_comment_live", sql.COMMENT + " WHERE dic_code <> '1203' OR o_orderkey % 3 = 0")
def stream_comment_live(spark, sf):
    """A code that is published between two rounds joins in the second one only."""
    dic, root, where = published_dictionary(spark, ["1203"]), shared_dir(spark, "comment"), shared_dir(spark, "topic-db")
    log = fx.change_log(spark, sf, "comment_info")
    second = F.col("data")["id"].cast("bigint") % 3 == 0
    for part in (log.where(~second), log.where(second)):
        part.select(json_record(*log.columns).alias("value")).write.mode("append").text(where)
        stream = readers.read_changelog(spark, Topic(where), delay=None)
        out = jobs.with_dims(stream, facts.comment, {"dic": dic}, "comment", root)
        dic.publish(fx.dictionary(spark))
    return out


for _name, _stream, _twin in (
        ("stream_page_view", page_view_stream, sql.page_view(10 * SECOND)),
        ("stream_home_detail_uv", home_detail_stream, sql.home_detail(HOUR)),
        ("stream_user_login", user_login_stream, sql.user_login(HOUR)),
        ("stream_cart_add_uu", cart_add_uu_stream, sql.cart_uu(HOUR))):
    query(_name, _twin)(_stream)
    query(f"{_name}_late", _twin)(functools.partial(_stream, deal=out_of_order))


def repeated_stream(spark, sf, deal=topic):
    rows = fx.repeated_details(spark, sf)
    lines = deal(spark, "repeats", as_lines(rows))
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return event_time(changelog.parse_json(readers.read_lines(spark, lines), shape), "s")


def province_stream(spark, sf, size, deal=topic):
    where = jobs.province_order(repeated_stream(spark, sf, deal), size, fx.TIE_BREAK, width=WIDTH)
    return trade.with_province(sinks.read_counted(spark, where), fx.provinces(spark, sf))


def sku_stream(spark, sf, size, deal=topic):
    where = jobs.sku_order(repeated_stream(spark, sf, deal), size, fx.TIE_BREAK, width=WIDTH)
    return trade.with_products(sinks.read_counted(spark, where), products(spark, sf))


for _label, _size, _ms in (("", "1 day", DAY), ("_w10", "10 seconds", 10 * SECOND)):
    for _name, _stream, _twin in (("stream_province_order", province_stream, sql.province_order),
                                  ("stream_sku_order", sku_stream, sql.sku_order)):
        query(_name + _label, _twin(_ms))(functools.partial(_stream, size=_size))
        query(f"{_name}{_label}_late", _twin(_ms))(functools.partial(_stream, size=_size, deal=out_of_order))


@query("stream_sku_order_by_clock", sql.SKU_TOTALS)
def stream_sku_order_by_clock(spark, sf):
    """Windows of the wall clock differ from run to run; what a product has in all of them does not."""
    where = jobs.sku_order_by_clock(repeated_stream(spark, sf, out_of_order), order=fx.TIE_BREAK, width=WIDTH)
    return spark.read.parquet(where).groupBy("sku_id").agg(
        *[F.sum(m).cast("decimal(38,4)").alias(m) for m in trade.SKU_MEASURES])


def most_files(spark, where):
    """As many files as a published batch has at most.  Each micro-batch behind reads the rows so far again, as its rows
    lie in all parts, so there should be as many of them as batches, however many files a larger table makes of one."""
    found = files.names(spark, f"{where}/batch_id=*/part-*", 2)
    batches = [f.split("/")[0] for f in found]
    return max(map(batches.count, {*batches}), default=1)


@query("stream_order_detail_to_sku", sql.detail_to_sku(DAY))
def stream_order_detail_to_sku(spark, sf):
    """Change log to order details to product windows: what the join takes back, the windows lose."""
    tables = ["order_info", "order_detail", "order_detail_activity", "order_detail_coupon"]
    details = joined_folder(spark, sf, "order_detail", tables, facts.order_detail, out_of_order)
    changes = readers.read_counted_changes(spark, details, schemas.fact_ddl(schemas.ORDER_DETAIL),
                                           maxFilesPerTrigger=str(most_files(spark, details)))
    where = jobs.sku_order(changes, "1 day", name="detail-sku", width=WIDTH)
    return trade.with_products(sinks.read_counted(spark, where), products(spark, sf))


@query("stream_upsert", sql.LATEST)
def stream_upsert(spark, sf):
    """Keyed table of order details: the latest row of each id."""
    order = ["ts", *fx.TIE_BREAK]
    where = jobs.run_batches(repeated_stream(spark, sf).drop("et"), "upsert",
                             lambda path: sinks.upsert(path, ["id"], order))
    columns = ["id", "order_id", "sku_id", "province_id", "split_total_amount", "ts"]
    return sinks.read_upserted(spark, where, ["id"], order, F.col("id") == "beat", columns).select(*columns)


@query("stream_dim_sync", sql.DIM_FOLD)
def stream_dim_sync(spark, sf):
    rows = numbered(fx.change_log(spark, sf, "customer_info"))
    lines = topic(spark, "db", as_lines(rows))
    where = jobs.sync_dims(readers.read_changelog(spark, lines), lambda: fx.dim_rules(spark),
                           fx.DATABASE)
    return dims.dim_table(sinks.read_dims(spark, where, name="dim_customer"), "dim_customer",
                          ["id", "name", "segment", "balance"])


@query("stream_dim_reset", sql.DIM_RESET)
def stream_dim_reset(spark, sf):
    """The dimension's rule is changed while the stream runs: its event comes in the third micro-batch."""
    rows = numbered(fx.change_log(spark, sf, "customer_info"))
    lines = out_of_order(spark, "db", as_lines(rows))
    rule = fx.dim_rules(spark).where("source_table = 'customer_info'")
    body, none = F.struct(*rule.columns), F.lit(None)

    def event(op, ms):
        old, new = (none, body) if op == "r" else (body, body)
        return rule.select(F.lit(op).alias("op"), old.alias("before"), new.alias("after"), F.lit(ms).alias("ts_ms"),
                           F.lit(ms).alias("offset")).select(json_record("op", "before", "after", "ts_ms", "offset").alias("value"))
    config = shared_dir(spark, "topic-config")
    for op, ms in (("r", 0), ("r", 1), ("u", 1_780_000_000_000)):
        event(op, ms).coalesce(1).write.mode("append").text(config)
    events = readers.read_config_changes(spark, Topic(config, options={"maxFilesPerTrigger": "1"}), schemas.DIM_RULE, True)
    where = jobs.sync_dims(readers.read_changelog(spark, lines, delay=None), lambda: fx.dim_rules(spark), fx.DATABASE, config=events)
    return dims.dim_table(sinks.read_dims(spark, where, name="dim_customer"), "dim_customer",
                          ["name", "segment", "balance"])


@query("stream_route_fact", sql.ROUTE_FACT)
def stream_route_fact(spark, sf):
    """Routing by rules that are looked at in every micro-batch; each rule event is read once."""
    return routed_facts(spark, sf)[0]


def routed_facts(spark, sf):
    rows = fx.change_log(spark, sf, "order_info", "payment_info", "comment_info")
    lines = topic(spark, "db", as_lines(rows))
    config = fx.rule_log(spark, sf).withColumnRenamed("event_id", "offset")
    rule_lines = topic(spark, "rules", config.select(json_record(*config.columns).alias("value")))
    book = RuleBook(spark, lambda: readers.read_config_changes(spark, rule_lines, stream=True), shared_dir(spark, "rules"),
                    ["source_table", "source_type"], ["ts_ms", "offset"])
    where = jobs.sync_facts(readers.read_changelog(spark, lines, delay=None), book.current)
    routed = spark.read.schema("sink_table string, data map<string,string>, ts bigint").parquet(where)
    return routed.select("sink_table", "ts", *[F.col("data")[c].alias(c) for c in (
        "id", "user_id", "order_id", "order_status", "appraise")]), book
