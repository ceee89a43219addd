"""Fact streams out of the change log.

Every function takes change-log rows (and, where a fact builds on another one, that
fact).  Batch and stream share one plan; on a stream both sides of a join need
``et`` with a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rillmart import schemas
from rillmart.functions.fields import money
from rillmart.functions.timefmt import date_of_text
from rillmart.operators.changelog import cart_additions, changes
from rillmart.operators.joins import NOW, WAS, interval_join, lookup_join, ttl_join

# Status codes of orders, payments and refunds, and how long (in
# seconds) the two sides of each join wait for one another.
UNPAID, CANCELLED, REFUNDING, REFUNDED = "1001", "1003", "1005", "1006"
PAID, REFUND_DONE = "1602", "0705"
DETAIL_TTL, CANCEL_TTL, REFUND_TTL = 10, 30 * 60 + 5, 5
PAY_EARLIEST, PAY_LATEST = -30 * 60, 5
# The most seconds between two rows that one row of the fact depends on: its sides lie within the
# times above of the left-most row, so on both sides of it.
REACH = {"order_detail": 2 * DETAIL_TTL, "order_cancel": CANCEL_TTL, "pay_success": -PAY_EARLIEST,
         "refund": REFUND_TTL, "refund_pay": 2 * REFUND_TTL}


def comment(log: DataFrame, dic: DataFrame) -> DataFrame:
    rows = changes(log, "comment_info", "insert",
                   ["id", "user_id", "sku_id", "appraise", "comment_txt"])
    return lookup_join(rows, dic, "appraise", "dic_code",
                       {"appraise_name": "dic_name"}).select(*schemas.COMMENT)


def cart_add(log: DataFrame) -> DataFrame:
    return cart_additions(log).select(*schemas.CART_ADD)


def order_detail(log: DataFrame) -> DataFrame:
    """Order lines with their order, and with activity and coupon if there are any."""
    detail = changes(log, "order_detail", "insert", [
        "id", "order_id", "sku_id", "sku_name", "create_time", "sku_num", "order_price",
        "split_total_amount", "split_activity_amount", "split_coupon_amount"])
    order = changes(log, "order_info", "insert",
                    {"_order": "id", "user_id": "user_id", "province_id": "province_id"}, keep=())
    activity = changes(log, "order_detail_activity", "insert",
                       {"_act": "order_detail_id", "activity_id": "activity_id",
                        "activity_rule_id": "activity_rule_id"}, keep=())
    coupon = changes(log, "order_detail_coupon", "insert",
                     {"_cou": "order_detail_id", "coupon_id": "coupon_id"}, keep=())
    wide = ttl_join(detail, order, [("order_id", "_order")], DETAIL_TTL)
    wide = ttl_join(wide, activity, [("id", "_act")], DETAIL_TTL, "left")
    wide = ttl_join(wide, coupon, [("id", "_cou")], DETAIL_TTL, "left")
    full_price = (money(F.col("sku_num")) * money(F.col("order_price"))).cast("string")
    return _fact(wide.withColumns({"split_original_amount": full_price,
                                   "date_id": date_of_text(F.col("create_time"))}),
                 schemas.ORDER_DETAIL)


def order_cancel(log: DataFrame, detail: DataFrame) -> DataFrame:
    cancel = changes(log, "order_info", "update", {"_order": "id", "cancel_time": "operate_time",
                                                   }, was={"order_status": UNPAID},
                     now={"order_status": CANCELLED}).withColumnRenamed("ts", "_ts")
    both = ttl_join(detail, cancel, [("order_id", "_order")], CANCEL_TTL)
    return _fact(both.withColumns({"date_id": date_of_text(F.col("cancel_time")),
                                   "ts": F.col("_ts")}), schemas.ORDER_CANCEL)


def pay_success(log: DataFrame, detail: DataFrame, dic: DataFrame) -> DataFrame:
    """Paid order lines: the line was written between 30 minutes before and five
    seconds after the payment."""
    paid = changes(log, "payment_info", "update", {
        "_order": "order_id", "payment_type_code": "payment_type",
        "callback_time": "callback_time"}, changed=["payment_status"],
        now={"payment_status": PAID}).withColumnRenamed("ts", "_ts")
    both = interval_join(paid, detail, [("_order", "order_id")], PAY_EARLIEST, PAY_LATEST)
    named = lookup_join(both, dic, "payment_type_code", "dic_code",
                        {"payment_type_name": "dic_name"})
    return _fact(named.withColumns({"ts": F.col("_ts"), "order_detail_id": F.col("id"),
                                    "split_payment_amount": F.col("split_total_amount")}),
                 schemas.PAY_SUCCESS)


def refund(log: DataFrame, dic: DataFrame) -> DataFrame:
    asked = changes(log, "order_refund_info", "insert", {
        "id": "id", "user_id": "user_id", "order_id": "order_id", "sku_id": "sku_id",
        "refund_type_code": "refund_type", "refund_num": "refund_num",
        "refund_amount": "refund_amount", "refund_reason_type_code": "refund_reason_type",
        "refund_reason_txt": "refund_reason_txt", "create_time": "create_time"})
    order = changes(log, "order_info", "update", {"_order": "id", "province_id": "province_id"},
                    changed=["order_status"], now={"order_status": REFUNDING}, keep=())
    both = ttl_join(asked, order, [("order_id", "_order")], REFUND_TTL)
    for code in ("refund_type", "refund_reason_type"):
        both = lookup_join(both, dic, f"{code}_code", "dic_code", {f"{code}_name": "dic_name"})
    return _fact(both.withColumn("date_id", date_of_text(F.col("create_time"))), schemas.REFUND)


def refund_pay(log: DataFrame, dic: DataFrame) -> DataFrame:
    paid = changes(log, "refund_payment", "update", {
        "id": "id", "order_id": "order_id", "sku_id": "sku_id",
        "payment_type_code": "payment_type", "callback_time": "callback_time",
        "refund_amount": "total_amount"}, changed=["refund_status"],
        now={"refund_status": PAID})
    done = changes(log, "order_refund_info", "update", {
        "_order1": "order_id", "_sku": "sku_id", "refund_num": "refund_num"},
        changed=["refund_status"], now={"refund_status": REFUND_DONE}, keep=())
    order = changes(log, "order_info", "update", {
        "_order2": "id", "user_id": "user_id", "province_id": "province_id"},
        changed=["order_status"], now={"order_status": REFUNDED}, keep=())
    both = ttl_join(paid, done, [("order_id", "_order1"), ("sku_id", "_sku")], REFUND_TTL)
    both = ttl_join(both, order, [("order_id", "_order2")], REFUND_TTL)
    named = lookup_join(both, dic, "payment_type_code", "dic_code",
                        {"payment_type_name": "dic_name"})
    return _fact(named.withColumn("date_id", date_of_text(F.col("callback_time"))),
                 schemas.REFUND_PAY)


def _fact(df: DataFrame, columns: list[str]) -> DataFrame:
    """The published columns; a stream keeps ``et`` for the joins behind it, and marks stay."""
    return df.select(*columns, *[c for c in ("et", NOW, WAS) if c in df.columns])


def published(fact: DataFrame) -> DataFrame:
    return fact.drop("et")


