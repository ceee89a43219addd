"""DuckDB twins of the registered queries, over the same parquet tables."""

from __future__ import annotations

DT, D = "'%Y-%m-%d %H:%M:%S'", "'%Y-%m-%d'"
DAY = 86_400_000


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _bounds(ms: str, size_ms: int) -> str:
    start = f"epoch_ms(({ms}) // {size_ms} * {size_ms})"
    end = f"epoch_ms(({ms}) // {size_ms} * {size_ms} + {size_ms})"
    return (f"strftime({start}, {DT}) AS stt, strftime({end}, {DT}) AS edt, "
            f"strftime({start}, {D}) AS cur_date")


VISITS = f"""v AS (
  SELECT *, strftime(epoch_ms(ms), {D}) AS day FROM (
    SELECT event_id, k, event_type AS kind, 'mid_' || user_id AS mid,
      CASE WHEN k % 10 = 0 THEN '' ELSE user_id::VARCHAR END AS uid,
      CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END AS is_new,
      'v' || (k % 3) AS vc, 'c' || (k % 4) AS ch, 'a' || (user_id % 5) AS ar,
      CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail'
        WHEN 'signup' THEN 'mine' WHEN 'purchase' THEN 'trade' ELSE 'search_result' END AS page_id,
      CASE WHEN event_type = 'signup' THEN 'login' WHEN event_type = 'error' THEN 'search'
        WHEN event_type = 'view' AND k % 4 = 0 THEN NULL WHEN event_type = 'view' THEN 'mine'
        ELSE 'home' END AS last_page_id,
      CAST(round(value * 100) AS BIGINT) AS dur, epoch_us(ts) // 1000 AS ms
    FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INT) AS k FROM events)))"""


def page_view(size: int, closed: str = "") -> str:
    return _with(VISITS, """f AS (SELECT *, row_number() OVER (
        PARTITION BY mid, day ORDER BY ms, vc, ch, ar, is_new, event_id) AS rn FROM v)""") + f"""
    SELECT {_bounds('ms', size)}, vc, ch, ar, is_new,
      CAST(sum(CASE WHEN rn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS uv_ct,
      CAST(sum(CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END) AS BIGINT) AS sv_ct,
      count(*) AS pv_ct, CAST(sum(dur) AS BIGINT) AS dur_sum
    FROM f {closed} GROUP BY ms // {size}, stt, edt, cur_date, vc, ch, ar, is_new"""


def home_detail(size: int, closed: str = "") -> str:
    return _with(VISITS, """f AS (SELECT mid, page_id, day, min(ms) AS ms FROM v
        WHERE page_id IN ('home', 'good_detail') GROUP BY ALL)""") + f"""
    SELECT {_bounds('ms', size)},
      CAST(sum(CASE WHEN page_id = 'home' THEN 1 ELSE 0 END) AS BIGINT) AS home_uv_ct,
      CAST(sum(CASE WHEN page_id = 'good_detail' THEN 1 ELSE 0 END) AS BIGINT) AS good_detail_uv_ct
    FROM f {closed} GROUP BY stt, edt, cur_date"""


def user_login(size: int, closed: str = "") -> str:
    return _with(VISITS, """l AS (SELECT *, lag(day) OVER (PARTITION BY uid ORDER BY ms, event_id)
        AS before FROM v WHERE uid <> '' AND coalesce(last_page_id, '') IN ('', 'login'))""") + f"""
    SELECT {_bounds('ms', size)},
      CAST(sum(CASE WHEN date_diff('day', before::DATE, day::DATE) >= 8 THEN 1 ELSE 0 END)
        AS BIGINT) AS back_ct, count(*) AS uu_ct
    FROM l WHERE before IS DISTINCT FROM day {closed} GROUP BY stt, edt, cur_date"""


def cart_uu(size: int, closed: str = "") -> str:
    return f"""WITH f AS (SELECT user_id, strftime(ts, {D}) AS day, min(epoch_us(ts) // 1000000 * 1000) AS ms
      FROM events WHERE event_type IN ('click', 'view') GROUP BY ALL)
    SELECT {_bounds('ms', size)}, count(*) AS cart_add_uu_ct
    FROM f {closed} GROUP BY stt, edt, cur_date"""


def keyword(size: int, closed: str = "") -> str:
    return f"""WITH w AS (SELECT 1704067200000 + doc_id * 1000 AS ms,
        unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS keyword
      FROM documents WHERE doc_id % 2 = 0 AND doc_id % 3 <> 0)
    SELECT {_bounds('ms', size)}, keyword, count(*) AS keyword_count
    FROM w {closed} GROUP BY stt, edt, cur_date, keyword"""


DICTIONARY_WORDS = """
WITH tok AS (SELECT unnest(string_split(lower(p_name || ' ' || p_type), ' ')) AS w FROM part),
list AS (SELECT DISTINCT w FROM (SELECT w FROM tok UNION ALL SELECT w[1:3] FROM tok UNION ALL SELECT w[2:4] FROM tok)
  WHERE len(w) > 1),
pat AS (SELECT string_agg(w, '|' ORDER BY len(w) DESC, w) AS p FROM list),
hits AS (SELECT lang, unnest(regexp_extract_all(lower(text), (SELECT p FROM pat))) AS word FROM documents)
SELECT lang, word, count(*) AS n FROM hits GROUP BY lang, word"""


# The client log after its dirty lines are gone, with the repaired visitor flag.
LOG = f"""raw AS (SELECT * FROM v WHERE event_id % 97 <> 0),
first AS (SELECT mid, CASE WHEN is_new = '1' THEN day
    ELSE strftime(epoch_ms(ms - {DAY}), {D}) END AS first_day
  FROM (SELECT *, row_number() OVER (PARTITION BY mid ORDER BY ms, is_new, event_id) AS rn FROM raw)
  WHERE rn = 1),
log AS (SELECT raw.*, CASE WHEN is_new = '1' AND first_day <> day THEN '0' ELSE is_new END AS fixed,
    kind = 'purchase' AND k % 7 = 0 AS has_start, kind = 'error' AND k % 3 = 0 AS has_err
  FROM raw JOIN first USING (mid))"""
LOG_COLUMNS = "mid, uid, fixed AS is_new, vc, ch, ar, page_id, last_page_id, dur AS during_time"


def log(select: str) -> str:
    return _with(VISITS, LOG) + select


# First days that are forgotten a day after the row that set them: the next row starts a new term.
def log_with_ttl(select: str, ttl: int = DAY) -> str:
    return "WITH RECURSIVE" + _with(VISITS, f"""raw AS (SELECT * FROM v WHERE event_id % 97 <> 0),
terms AS (SELECT mid, min(ms) AS start FROM raw GROUP BY mid
  UNION ALL SELECT t.mid, min(r.ms) FROM terms t JOIN raw r ON r.mid = t.mid AND r.ms > t.start + {ttl} GROUP BY t.mid, t.start),
first AS (SELECT mid, start, CASE WHEN min(is_new) = '1' THEN strftime(epoch_ms(start), {D})
    ELSE strftime(epoch_ms(start - {DAY}), {D}) END AS first_day FROM terms JOIN raw USING (mid) WHERE ms = start GROUP BY mid, start),
log AS (SELECT raw.*, CASE WHEN is_new = '1' AND first_day <> day THEN '0' ELSE is_new END AS fixed,
    kind = 'purchase' AND k % 7 = 0 AS has_start, kind = 'error' AND k % 3 = 0 AS has_err
  FROM raw JOIN first ON raw.mid = first.mid AND ms BETWEEN start AND start + {ttl})""").removeprefix("WITH") + select


# --- change log --------------------------------------------------------------------------

ORDERS = """o AS (SELECT *, CAST(epoch(o_orderdate) AS BIGINT) + o_orderkey % 86400 AS t FROM orders
  LEFT JOIN customer ON o_custkey = c_custkey)"""
LINES = """lines AS (SELECT l.*, o.t, o.o_orderstatus, o.o_custkey, o.c_nationkey,
    l_orderkey * 10 + l_linenumber AS id,
    CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * (1 - CAST(l_discount AS DECIMAL(16,2))) AS DECIMAL(16,2)) AS tot,
    CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_discount AS DECIMAL(16,2)) AS DECIMAL(16,2)) AS act,
    CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_tax AS DECIMAL(16,2)) AS DECIMAL(16,2)) AS cou
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
      l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
      l_tax DESC, l_returnflag DESC) AS rn FROM lineitem) l
  JOIN o ON l_orderkey = o_orderkey WHERE rn = 1)"""
DETAIL = f"""det AS (SELECT CAST(id AS VARCHAR) AS id, CAST(l_orderkey AS VARCHAR) AS order_id,
    CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS sku_id, p_name AS sku_name,
    CAST(c_nationkey AS VARCHAR) AS province_id,
    CASE WHEN l_partkey % 3 = 0 AND l_partkey % 15 <= 10 THEN CAST(l_partkey % 10 AS VARCHAR) END AS activity_id,
    CASE WHEN l_partkey % 3 = 0 AND l_partkey % 15 <= 10 THEN CAST(l_partkey % 7 AS VARCHAR) END AS activity_rule_id,
    CASE WHEN l_suppkey % 5 = 0 AND l_suppkey % 12 <= 10 THEN CAST(l_suppkey % 9 AS VARCHAR) END AS coupon_id,
    strftime(make_timestamp((t + l_linenumber) * 1000000), {D}) AS date_id,
    strftime(make_timestamp((t + l_linenumber) * 1000000), {DT}) AS create_time,
    CAST(CAST(l_quantity AS INT) AS VARCHAR) AS sku_num,
    CAST(CAST(l_quantity AS DECIMAL(16,2)) * CAST(p_retailprice AS DECIMAL(16,2)) AS VARCHAR) AS split_original_amount,
    CAST(act AS VARCHAR) AS split_activity_amount, CAST(cou AS VARCHAR) AS split_coupon_amount,
    CAST(tot AS VARCHAR) AS split_total_amount, t + l_linenumber AS ts
  FROM lines JOIN part ON l_partkey = p_partkey)"""
DIC = """dic(dic_code, dic_name) AS (VALUES ('1101', 'wallet'), ('1102', 'bank card'),
  ('1103', 'union pay'), ('1201', 'good'), ('1202', 'fair'), ('1203', 'bad'),
  ('1501', 'refund only'), ('1502', 'return and refund'), ('1301', 'quality'),
  ('1302', 'wrong size'), ('1303', 'not as described'))"""
REFUNDS = "refunds AS (SELECT * FROM lines WHERE l_returnflag = 'R' AND o_orderstatus = 'P')"


def ts_text(seconds: str, fmt: str = DT) -> str:
    return f"strftime(make_timestamp(({seconds}) * 1000000), {fmt})"


ORDER_DETAIL = _with(ORDERS, LINES, DETAIL) + "SELECT * FROM det"
_CANCEL = "o.t + (o_orderkey % 60) * 60"
ORDER_CANCEL = _with(ORDERS, LINES, DETAIL) + f"""
  SELECT id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id,
    coupon_id, {ts_text(_CANCEL, D)} AS date_id, {ts_text(_CANCEL)} AS cancel_time, sku_num,
    split_original_amount, split_activity_amount, split_coupon_amount, split_total_amount,
    {_CANCEL} AS ts
  FROM det JOIN o ON order_id = CAST(o_orderkey AS VARCHAR)
  WHERE o_orderstatus = 'F' AND abs(det.ts - ({_CANCEL})) <= 1805"""
_PAID = "o.t + (o_orderkey % 40) * 60 - 10"
PAY_SUCCESS = _with(ORDERS, LINES, DETAIL, DIC) + f"""
  SELECT id AS order_detail_id, order_id, user_id, sku_id, sku_name, province_id, activity_id,
    activity_rule_id, coupon_id, dic_code AS payment_type_code, dic_name AS payment_type_name,
    {ts_text(_PAID)} AS callback_time, sku_num, split_original_amount, split_activity_amount,
    split_coupon_amount, split_total_amount AS split_payment_amount, {_PAID} AS ts
  FROM det JOIN o ON order_id = CAST(o_orderkey AS VARCHAR)
  JOIN dic ON dic_code = CAST(1101 + o_orderkey % 4 AS VARCHAR)
  WHERE o_orderstatus = 'O' AND det.ts BETWEEN {_PAID} - 1800 AND {_PAID} + 5"""
REFUND = _with(ORDERS, LINES, REFUNDS, DIC) + f"""
  SELECT CAST(id AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
    CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
    CAST(c_nationkey AS VARCHAR) AS province_id,
    {ts_text('t + 600 + l_linenumber % 8', D)} AS date_id,
    {ts_text('t + 600 + l_linenumber % 8')} AS create_time,
    d1.dic_code AS refund_type_code, d1.dic_name AS refund_type_name,
    d2.dic_code AS refund_reason_type_code, d2.dic_name AS refund_reason_type_name,
    'see type' AS refund_reason_txt, CAST(CAST(l_quantity AS INT) AS VARCHAR) AS refund_num,
    CAST(tot AS VARCHAR) AS refund_amount, t + 600 + l_linenumber % 8 AS ts
  FROM refunds JOIN dic d1 ON d1.dic_code = CAST(1501 + l_linenumber % 2 AS VARCHAR)
  JOIN dic d2 ON d2.dic_code = CAST(1301 + l_partkey % 4 AS VARCHAR)
  WHERE l_linenumber % 8 <= 5"""
# Two lines of one order may carry the same product, hence the self-join.
REFUND_PAY = _with(ORDERS, LINES, REFUNDS, DIC) + f"""
  SELECT CAST(a.id AS VARCHAR) AS id, CAST(a.o_custkey AS VARCHAR) AS user_id,
    CAST(a.l_orderkey AS VARCHAR) AS order_id, CAST(a.l_partkey AS VARCHAR) AS sku_id,
    CAST(a.c_nationkey AS VARCHAR) AS province_id, dic_code AS payment_type_code,
    dic_name AS payment_type_name, {ts_text('a.t + 1200 + a.l_linenumber % 8', D)} AS date_id,
    {ts_text('a.t + 1200 + a.l_linenumber % 8')} AS callback_time,
    CAST(CAST(b.l_quantity AS INT) AS VARCHAR) AS refund_num, CAST(a.tot AS VARCHAR) AS refund_amount,
    a.t + 1200 + a.l_linenumber % 8 AS ts
  FROM refunds a JOIN refunds b ON a.l_orderkey = b.l_orderkey AND a.l_partkey = b.l_partkey
  JOIN dic ON dic_code = CAST(1101 + a.l_linenumber % 4 AS VARCHAR)
  WHERE abs(a.l_linenumber % 8 - b.l_linenumber * 3 % 8) <= 5 AND a.l_linenumber % 8 <= 5"""
COMMENT = _with(ORDERS, DIC) + """
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
    CAST(o_orderkey % 1000 AS VARCHAR) AS sku_id, dic_code AS appraise, dic_name AS appraise_name,
    'comment ' || o_orderkey AS comment_txt, t + 3600 AS ts
  FROM o JOIN dic ON dic_code = CAST(1201 + o_orderkey % 4 AS VARCHAR)"""
CART_ADD = """
  SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS id, CAST(l_suppkey AS VARCHAR) AS user_id,
    CAST(l_partkey AS VARCHAR) AS sku_id, CAST(n AS VARCHAR) AS sku_num,
    CAST(epoch(l_shipdate) AS BIGINT) + l_orderkey % 86400 AS ts
  FROM (SELECT *, CAST(l_quantity AS INT) AS n FROM lineitem
    UNION ALL SELECT *, l_partkey % 7 - 3 AS n FROM lineitem
      WHERE l_linenumber % 2 = 0 AND l_partkey % 7 > 3)"""

# --- trade summaries ------------------------------------------------------------------------

REPEATS = """rep AS (SELECT *, lead(ts) OVER (PARTITION BY id ORDER BY ts, l_shipdate, l_partkey,
      l_suppkey, l_quantity, l_extendedprice) - ts <= 10 AS gone
  FROM (SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS id,
    CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
    CAST(c_nationkey AS VARCHAR) AS province_id,
    CAST(CAST(l_quantity AS INT) * CAST(l_extendedprice AS DECIMAL(16,2)) AS DECIMAL(16,2)) AS orig,
    CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * (1 - CAST(l_discount AS DECIMAL(16,2))) AS DECIMAL(16,2)) AS tot,
    CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_discount AS DECIMAL(16,2)) AS DECIMAL(16,2)) AS act,
    CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_tax AS DECIMAL(16,2)) AS DECIMAL(16,2)) AS cou,
    t + l_linenumber + l_suppkey % 25 AS ts, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice
  FROM lineitem JOIN o ON l_orderkey = o_orderkey))"""


def province_order(size: int) -> str:
    return _with(ORDERS, REPEATS, f"""s AS (SELECT {_bounds('ts * 1000', size)}, province_id,
        count(DISTINCT order_id) AS order_count,
        CAST(sum(CASE WHEN gone THEN 0 ELSE tot END) AS DECIMAL(38,4)) AS order_amount
      FROM rep GROUP BY stt, edt, cur_date, province_id)""") + """
    SELECT s.*, coalesce(n_name, '') AS province_name FROM s
    LEFT JOIN nation ON province_id = CAST(n_nationkey AS VARCHAR) AND n_nationkey <> 24"""


def sku_order(size: int, *rep: str) -> str:
    def total(c):
        return f"CAST(sum(CASE WHEN gone THEN 0 ELSE {c} END) AS DECIMAL(38,4))"
    return _with(ORDERS, *(rep or (REPEATS,)), f"""s AS (SELECT {_bounds('ts * 1000', size)}, sku_id,
        {total('orig')} AS original_amount, {total('act')} AS activity_reduce_amount,
        {total('cou')} AS coupon_reduce_amount, {total('tot')} AS order_amount
      FROM rep GROUP BY stt, edt, cur_date, sku_id)""") + """
    SELECT s.*, p_brand AS trademark_id, upper(p_brand) AS trademark_name,
      CAST(p_partkey % 27 AS VARCHAR) AS category3_id, n_name AS category3_name,
      CAST(n_regionkey AS VARCHAR) AS category2_id, r_name AS category2_name,
      CAST(r_regionkey % 2 AS VARCHAR) AS category1_id,
      CASE r_regionkey % 2 WHEN 0 THEN 'goods' WHEN 1 THEN 'services' END AS category1_name,
      p_name AS sku_name, CAST(p_size AS VARCHAR) AS spu_id,
      CASE WHEN p_size <> 7 THEN 'spu ' || p_size END AS spu_name
    FROM s LEFT JOIN part ON sku_id = CAST(p_partkey AS VARCHAR)
    LEFT JOIN nation ON p_partkey % 27 = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey"""


SKU_TOTALS = _with(ORDERS, REPEATS) + "SELECT sku_id, " + ", ".join(
    f"CAST(sum(CASE WHEN gone THEN 0 ELSE {c} END) AS DECIMAL(38,4)) AS {m}" for c, m in (
        ("orig", "original_amount"), ("act", "activity_reduce_amount"), ("cou", "coupon_reduce_amount"),
        ("tot", "order_amount"))) + " FROM rep GROUP BY sku_id"


def detail_to_sku(size: int) -> str:
    """Product windows over the order details themselves, which do not repeat."""
    return sku_order(size, LINES, DETAIL, """rep AS (SELECT id, sku_id, ts, false AS gone,
      CAST(split_original_amount AS DECIMAL(20,4)) AS orig, CAST(split_activity_amount AS DECIMAL(20,4)) AS act,
      CAST(split_coupon_amount AS DECIMAL(20,4)) AS cou, CAST(split_total_amount AS DECIMAL(20,4)) AS tot FROM det)""")


CANCEL_OUT = _with(ORDERS, REPEATS) + """
  SELECT id, order_id, sku_id, ts, CAST(sign * orig AS DECIMAL(20,4)) AS split_original_amount,
    CAST(sign * act AS DECIMAL(20,4)) AS split_activity_amount,
    CAST(sign * cou AS DECIMAL(20,4)) AS split_coupon_amount,
    CAST(sign * tot AS DECIMAL(20,4)) AS split_total_amount
  FROM rep, (VALUES (1), (-1)) s(sign) WHERE sign = 1 OR gone"""
LATEST = """
  SELECT id, order_id, sku_id, province_id, split_total_amount, ts FROM (
    SELECT *, CAST(tot AS VARCHAR) AS split_total_amount, row_number() OVER (PARTITION BY id ORDER BY
      ts DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
      l_extendedprice DESC) AS rn FROM rep) WHERE rn = 1"""
LATEST = _with(ORDERS, REPEATS) + LATEST

# --- rules, dims ------------------------------------------------------------------------------

RULES = f"""ev AS (SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, k,
    ['order_info', 'payment_info', 'comment_info', 'cart_info', 'coupon_use'][user_id % 5 + 1] AS source_table,
    ['insert', 'update'][k % 2 + 1] AS source_type,
    ['id,user_id', 'id,order_status,appraise', 'id,order_id, user_id'][k % 3 + 1] AS sink_columns
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INT) AS k FROM events)),
rules AS (SELECT source_table, source_type, 'fact_' || source_table || '_' || source_type AS sink_table,
    sink_columns FROM (SELECT *, row_number() OVER (PARTITION BY source_table, source_type
      ORDER BY ts_ms DESC, event_id DESC) AS rn FROM ev) WHERE rn = 1 AND k % 10 <> 9)"""
_COLUMNS = ["id", "user_id", "order_id", " user_id", "order_status", "appraise"]
_FACT_ROWS = """rec AS (
  SELECT 'order_info' AS tab, 'insert' AS typ, t AS ts, CAST(o_orderkey AS VARCHAR) AS id,
    CAST(o_custkey AS VARCHAR) AS user_id, NULL AS order_id, '1001' AS order_status, NULL AS appraise FROM o
  UNION ALL SELECT 'order_info', 'update', t + (o_orderkey % 60) * 60, CAST(o_orderkey AS VARCHAR),
    CAST(o_custkey AS VARCHAR), NULL, '1003', NULL FROM o WHERE o_orderstatus = 'F'
  UNION ALL SELECT 'order_info', 'update', t + 600 * n, CAST(o_orderkey AS VARCHAR),
    CAST(o_custkey AS VARCHAR), NULL, CAST(1004 + n AS VARCHAR), NULL
    FROM o, (VALUES (1), (2)) x(n) WHERE o_orderstatus = 'P'
  UNION ALL SELECT 'payment_info', 'update', t + (o_orderkey % 40) * 60 - 10, NULL,
    CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), NULL, NULL FROM o WHERE o_orderstatus = 'O'
  UNION ALL SELECT 'comment_info', 'insert', t + 3600, CAST(o_orderkey AS VARCHAR),
    CAST(o_custkey AS VARCHAR), NULL, NULL, CAST(1201 + o_orderkey % 4 AS VARCHAR) FROM o)"""
ROUTE_FACT = _with(ORDERS, RULES, _FACT_ROWS) + "SELECT sink_table, ts, " + ", ".join(
    f"CASE WHEN list_contains(string_split(sink_columns, ','), '{c}') THEN {c} END AS {c}"
    for c in ("id", "user_id", "order_id", "order_status", "appraise")) + """
  FROM rec JOIN rules ON tab = source_table AND typ = source_type"""
RULES_LATEST = _with(RULES) + "SELECT * FROM rules"
_CUSTOMER_LOG = """
  SELECT 'dim_customer' AS sink_table, CAST(c_custkey AS VARCHAR) AS row_key, op, 1700000000 + c_custkey + lag AS ts,
    CAST(c_custkey AS VARCHAR) AS id, CASE WHEN op = 'update' THEN NULL ELSE c_name END AS name,
    CASE op WHEN 'update' THEN '' ELSE CASE WHEN lag = 300000000 THEN 'BACK' ELSE c_mktsegment END END AS segment,
    CASE WHEN lag = 300000000 THEN NULL ELSE CAST(CAST(c_acctbal AS DECIMAL(16,2))
      + CASE WHEN op = 'update' THEN 1 ELSE 0 END AS VARCHAR) END AS balance
  FROM customer, (VALUES ('insert', 0, 1), ('update', 100000000, 3), ('delete', 200000000, 7),
    ('insert', 300000000, 21)) x(op, lag, every) WHERE c_custkey % every = 0"""
ROUTE_DIM = _with(ORDERS) + _CUSTOMER_LOG.replace("SELECT", "SELECT", 1) + """
  UNION ALL SELECT 'dim_order', CAST(o_orderkey AS VARCHAR), 'insert', t, CAST(o_orderkey AS VARCHAR), NULL, NULL, NULL FROM o
  UNION ALL SELECT 'dim_order', CAST(o_orderkey AS VARCHAR), 'update', t + (o_orderkey % 60) * 60,
    CAST(o_orderkey AS VARCHAR), NULL, NULL, NULL FROM o WHERE o_orderstatus = 'F'
  UNION ALL SELECT 'dim_order', CAST(o_orderkey AS VARCHAR), 'update', t + 600 * n,
    CAST(o_orderkey AS VARCHAR), NULL, NULL, NULL FROM o, (VALUES (1), (2)) x(n) WHERE o_orderstatus = 'P'"""
DIM_FOLD = """
  SELECT CAST(c_custkey AS VARCHAR) AS row_key, CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
    CASE WHEN c_custkey % 21 = 0 THEN 'BACK' ELSE c_mktsegment END AS segment,
    CASE WHEN c_custkey % 21 = 0 THEN NULL ELSE CAST(CAST(c_acctbal AS DECIMAL(16,2))
      + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS VARCHAR) END AS balance
  FROM customer WHERE c_custkey % 7 <> 0 OR c_custkey % 21 = 0"""
DIM_RESET = """
  SELECT CAST(c_custkey AS VARCHAR) AS row_key,
    CASE WHEN c_custkey % 21 = 0 THEN c_name END AS name,
    CASE WHEN c_custkey % 21 = 0 THEN 'BACK' END AS segment,
    CASE WHEN c_custkey % 21 = 0 THEN NULL ELSE CAST(CAST(c_acctbal AS DECIMAL(16,2)) + 1 AS VARCHAR) END AS balance
  FROM customer WHERE c_custkey % 3 = 0 AND (c_custkey % 7 <> 0 OR c_custkey % 21 = 0)"""

MIXED = """m AS (SELECT CAST(o_orderkey AS VARCHAR) AS id,
    ['insert', 'update', 'delete', 'bootstrap-start', 'bootstrap-insert', 'bootstrap-complete'][o_orderkey % 6 + 1] AS type,
    CASE WHEN o_orderkey % 11 = 0 THEN 'other' ELSE 'shop' END AS database,
    o_orderkey % 13 = 0 AS no_fields, o_orderkey % 17 = 0 AS no_data, t AS ts FROM o)"""
ETL_GATE = _with(ORDERS, MIXED) + """SELECT id, type, ts FROM m WHERE database = 'shop'
  AND type IN ('insert', 'update', 'delete', 'bootstrap-insert') AND NOT no_fields AND NOT no_data"""
DROP_BOOTSTRAP = _with(ORDERS, MIXED) + """
  SELECT CASE WHEN no_fields OR no_data THEN NULL ELSE id END AS id, type, database, ts
  FROM m WHERE NOT starts_with(type, 'bootstrap-')"""

JSON_OUT = """SELECT '{"event_id":' || event_id || ',"user_id":' || user_id
    || CASE WHEN event_id % 7 <> 0 THEN ',"event_type":"' || event_type || '"' ELSE '' END
    || ',"text":' || CAST(to_json('say "' || event_type || '" \\ ' || props) AS VARCHAR) || '}' AS value
    FROM events"""
