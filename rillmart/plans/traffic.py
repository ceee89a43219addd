"""Page-log summaries.  Input: (common, page, ts in ms)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rillmart import schemas
from rillmart.functions.fields import is_blank
from rillmart.functions.text import explode_words
from rillmart.operators.keyed import first_per_day, login_days, repair_new_visitors
from rillmart.operators.logsplit import split_log
from rillmart.operators.windows import REFERENCE_SIZE, event_time, tumble

VISIT_KEYS = ["vc", "ch", "ar", "is_new"]
# Page names the summaries look at.
HOME, DETAIL = "home", "good_detail"
LOGIN, SEARCH, KEYWORD = "login", "search", "keyword"


def times(page_log: DataFrame) -> list[str]:
    """ts, and the event time with its watermark where a stream has set one."""
    return [c for c in ("ts", "et") if c in page_log.columns]


def visits(page_log: DataFrame) -> DataFrame:
    """Page views with their measures: sv opens a session, pv counts the page."""
    common, page = F.col("common"), F.col("page")
    return page_log.select(
        common["mid"].alias("mid"), *[common[k].alias(k) for k in VISIT_KEYS],
        F.when(is_blank(page["last_page_id"]), 1).otherwise(0).alias("sv"),
        F.lit(1).alias("pv"), page["during_time"].try_cast("bigint").alias("dur"), *times(page_log))


def page_view(page_log: DataFrame, size: str = REFERENCE_SIZE) -> DataFrame:
    """Views, sessions, durations and daily-unique visitors by version, channel,
    area and visitor kind.

    The visitor's flag sits on the first view of the day, so unique visitors need
    one row per (device, day) and the other measures need no device at all.  The
    two parts meet as partial sums instead of flagging every view by a window.
    """
    views = visits(page_log)
    zero = F.lit(0).cast("bigint")
    plain = views.select("ts", *VISIT_KEYS, "sv", "pv", "dur", zero.alias("uv"))
    firsts = first_per_day(views, ["mid"], VISIT_KEYS).select(
        "ts", *VISIT_KEYS, zero.alias("sv"), zero.alias("pv"),
        zero.alias("dur"), F.lit(1).cast("bigint").alias("uv"))
    return page_view_windows(event_time(plain.unionByName(firsts)), size)


def page_view_windows(measures: DataFrame, size: str) -> DataFrame:
    return tumble(measures, size, VISIT_KEYS,
                  [F.sum("uv").alias("uv_ct"), F.sum("sv").alias("sv_ct"),
                   F.sum("pv").alias("pv_ct"), F.sum("dur").alias("dur_sum")]
                  ).select(*schemas.PAGE_VIEW)


def home_detail_views(page_log: DataFrame) -> DataFrame:
    page_id = F.col("page")["page_id"]
    return page_log.where(page_id.isin(HOME, DETAIL)).select(
        F.col("common")["mid"].alias("mid"), page_id.alias("page_id"), *times(page_log))


def home_detail_uv(page_log: DataFrame, size: str = REFERENCE_SIZE) -> DataFrame:
    """Daily-unique visitors of the home page and of the product page."""
    firsts = first_per_day(home_detail_views(page_log), ["mid", "page_id"])
    return home_detail_windows(event_time(firsts), size)


def home_detail_windows(firsts: DataFrame, size: str, times: Column | None = None) -> DataFrame:
    """``times``: how often a row counts; below zero where it is taken back."""
    def hits(page: str) -> Column:
        return F.sum(F.when(F.col("page_id") == page, F.lit(1) if times is None else times).otherwise(0))
    return tumble(firsts, size, [], [hits(HOME).alias("home_uv_ct"),
                                     hits(DETAIL).alias("good_detail_uv_ct")]
                  ).select(*schemas.HOME_DETAIL_UV)


def logins(page_log: DataFrame) -> DataFrame:
    """Signed-in page views that start a visit or come from the login page."""
    uid, last = F.col("common")["uid"], F.col("page")["last_page_id"]
    return page_log.where(~is_blank(uid) & (is_blank(last) | (last == LOGIN))).select(
        uid.alias("uid"), *times(page_log))


def user_login(page_log: DataFrame, size: str = REFERENCE_SIZE) -> DataFrame:
    """Daily-unique users, and users back after eight or more days."""
    return user_login_windows(event_time(login_days(logins(page_log))), size)


def user_login_windows(days: DataFrame, size: str, times: Column | None = None) -> DataFrame:
    sums = [F.sum(F.col(c) if times is None else F.col(c) * times).alias(c) for c in ("back_ct", "uu_ct")]
    return tumble(days, size, [], sums).select(*schemas.USER_LOGIN)


def searches(page_log: DataFrame) -> DataFrame:
    page = F.col("page")
    return page_log.where((page["last_page_id"] == SEARCH) & (page["item_type"] == KEYWORD)
                          & page["item"].isNotNull()).select(page["item"].alias("fullword"), *times(page_log))


def keyword_pv(page_log: DataFrame, size: str = REFERENCE_SIZE,
               dictionary: list[str] | None = None) -> DataFrame:
    """How often each word was searched for."""
    spoken = explode_words(searches(page_log), "fullword", dictionary=dictionary)
    if "et" not in spoken.columns:
        spoken = event_time(spoken)
    return tumble(spoken, size, ["keyword"], [F.count("*").alias("keyword_count")]
                  ).select(*schemas.KEYWORD_PV)


def repaired_log(log: DataFrame) -> DataFrame:
    """Client log with the new-visitor flag of ``common`` corrected."""
    common = F.col("common")
    fixed = repair_new_visitors(log, common["mid"], common["is_new"], F.col("ts"))
    return fixed.withColumn("common", with_flag(common, F.col("is_new_fixed"))).drop("is_new_fixed")


def with_flag(common: Column, flag: Column) -> Column:
    return F.when(flag.isNull(), common).otherwise(F.map_concat(
        F.map_filter(common, lambda name, _: name != "is_new"),
        F.create_map(F.lit("is_new"), flag)))


def log_facts(log: DataFrame) -> dict[str, DataFrame]:
    """Repair, then split into the five traffic facts."""
    return split_log(repaired_log(log))
