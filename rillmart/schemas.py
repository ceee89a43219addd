"""Declared input and output shapes.  Nothing is ever inferred from data.

Fixed values: the column names below are the published record formats of the
topics and result tables, so that a job can be swapped without touching readers.
"""

from __future__ import annotations

# --- inputs -----------------------------------------------------------------
CHANGELOG = ("`database` string, `table` string, `type` string, ts bigint, "
             "data map<string,string>, old map<string,string>")
CLIENT_LOG = ("common map<string,string>, page map<string,string>, "
              "start map<string,string>, err map<string,string>, "
              "displays array<map<string,string>>, actions array<map<string,string>>, "
              "ts bigint")
PAGE_LOG = "common map<string,string>, page map<string,string>, ts bigint"
DIM_RULE = ("source_table string, sink_table string, sink_columns string, "
            "sink_family string, sink_row_key string")
FACT_RULE = "source_table string, source_type string, sink_table string, sink_columns string"


def config_change(rule: str) -> str:
    return f"op string, before struct<{_colons(rule)}>, after struct<{_colons(rule)}>, ts_ms bigint"


def _colons(ddl: str) -> str:
    return ", ".join("{}: {}".format(*part.split()) for part in ddl.split(","))


# --- fact streams (all text, ts in epoch seconds) -----------------------------
ORDER_DETAIL = ["id", "order_id", "user_id", "sku_id", "sku_name", "province_id",
                "activity_id", "activity_rule_id", "coupon_id", "date_id", "create_time",
                "sku_num", "split_original_amount", "split_activity_amount",
                "split_coupon_amount", "split_total_amount", "ts"]
ORDER_CANCEL = ["id", "order_id", "user_id", "sku_id", "sku_name", "province_id",
                "activity_id", "activity_rule_id", "coupon_id", "date_id", "cancel_time",
                "sku_num", "split_original_amount", "split_activity_amount",
                "split_coupon_amount", "split_total_amount", "ts"]
PAY_SUCCESS = ["order_detail_id", "order_id", "user_id", "sku_id", "sku_name", "province_id",
               "activity_id", "activity_rule_id", "coupon_id", "payment_type_code",
               "payment_type_name", "callback_time", "sku_num", "split_original_amount",
               "split_activity_amount", "split_coupon_amount", "split_payment_amount", "ts"]
REFUND = ["id", "user_id", "order_id", "sku_id", "province_id", "date_id", "create_time",
          "refund_type_code", "refund_type_name", "refund_reason_type_code",
          "refund_reason_type_name", "refund_reason_txt", "refund_num", "refund_amount", "ts"]
REFUND_PAY = ["id", "user_id", "order_id", "sku_id", "province_id", "payment_type_code",
              "payment_type_name", "date_id", "callback_time", "refund_num", "refund_amount",
              "ts"]
CART_ADD = ["id", "user_id", "sku_id", "sku_num", "ts"]
COMMENT = ["id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt", "ts"]

# --- window summaries -----------------------------------------------------------
BOUNDS = ["stt", "edt", "cur_date"]
CART_ADD_UU = BOUNDS + ["cart_add_uu_ct"]
PROVINCE_ORDER = BOUNDS + ["province_id", "province_name", "order_count", "order_amount"]
SKU_ORDER = BOUNDS + ["trademark_id", "trademark_name", "category1_id", "category1_name",
                      "category2_id", "category2_name", "category3_id", "category3_name",
                      "sku_id", "sku_name", "spu_id", "spu_name", "original_amount",
                      "activity_reduce_amount", "coupon_reduce_amount", "order_amount"]
HOME_DETAIL_UV = BOUNDS + ["home_uv_ct", "good_detail_uv_ct"]
KEYWORD_PV = BOUNDS + ["keyword", "keyword_count"]
PAGE_VIEW = BOUNDS + ["vc", "ch", "ar", "is_new", "uv_ct", "sv_ct", "pv_ct", "dur_sum"]
USER_LOGIN = BOUNDS + ["back_ct", "uu_ct"]


def fact_ddl(columns: list[str]) -> str:
    return ", ".join(f"{c} {'bigint' if c == 'ts' else 'string'}" for c in columns)
