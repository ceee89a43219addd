"""Trade summaries.  Input: order-detail or cart facts with ts in seconds."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rillmart import schemas
from rillmart.functions.fields import amount, total
from rillmart.operators.joins import enrich
from rillmart.operators.keyed import first_per_day, marked_moments, moment_changes
from rillmart.operators.windows import REFERENCE_SIZE, event_time, tumble
from rillmart.sources.readers import COUNT

Rows = Callable[[DataFrame], DataFrame]
REPEAT_TTL = 10
SKU_MEASURES = {"original_amount": "split_original_amount",
                "activity_reduce_amount": "split_activity_amount",
                "coupon_reduce_amount": "split_coupon_amount",
                "order_amount": "split_total_amount"}
SKU_DIMS = ["trademark_id", "trademark_name", "category1_id", "category1_name", "category2_id",
            "category2_name", "category3_id", "category3_name", "sku_name", "spu_id", "spu_name"]


def cart_add_uu(cart: DataFrame, size: str = REFERENCE_SIZE) -> DataFrame:
    """Daily-unique users who put something into the cart."""
    firsts = first_per_day(cart.select("user_id", (F.col("ts") * 1000).alias("ts")), ["user_id"])
    return cart_add_windows(event_time(firsts), size)


def cart_add_windows(firsts: DataFrame, size: str, times: Column | None = None) -> DataFrame:
    """``times``: how often a row counts; below zero where it is taken back."""
    users = F.sum(F.lit(1) if times is None else times).cast("bigint").alias("cart_add_uu_ct")
    return tumble(firsts, size, [], [users]).select(*schemas.CART_ADD_UU)


def net_measures(detail: DataFrame, by: Sequence[str], measures: dict[str, str],
                 order: Sequence[str], ttl: int | None, near: Sequence[str] = ()) -> DataFrame:
    """Rows whose measures sum up to the amounts without repeats.

    A repeated line cancels the one before it, in that one's window, so of all repeats
    only the row nothing supersedes counts.  The others are still there with zeros, since
    a window whose lines were all cancelled is reported too.
    """
    return marked_moments(detail, "id", by, order, ttl, {out: amount(F.col(src)) for out, src in measures.items()}, near=near)


def province_order(detail: DataFrame, province: DataFrame, size: str = REFERENCE_SIZE,
                   order: Sequence[str] = (), ttl: int | None = REPEAT_TTL) -> DataFrame:
    return with_province(province_windows(detail, size, order, ttl), province)


def province_windows(detail: DataFrame, size: str, order: Sequence[str], ttl: int | None) -> DataFrame:
    """Orders and order amount by province.  Amounts are summed per order first: that
    makes the distinct count a plain count, with both steps combined before their
    shuffles."""
    rows = net_measures(detail, ["province_id", "order_id"],
                        {"paid": "split_total_amount"}, order, ttl)
    return count_orders(event_time(rows, "s"), size)


def count_orders(rows: DataFrame, size: str) -> DataFrame:
    orders = (rows.groupBy(F.window("et", size).alias("_w"), "province_id", "order_id")
              .agg(F.sum("paid").alias("paid")))
    return tumble(orders, size, ["province_id"],
                  [F.count("order_id").alias("order_count"),
                   total(F.col("paid")).alias("order_amount")], time="_w")


def province_changes(detail: DataFrame, size: str, order: Sequence[str], ttl: int, asked: Rows | None = None) -> DataFrame:
    """``province_windows`` of the rows with ``_now`` less those of the rows with ``_was``, with counts; or of the windows
    whose rows ``asked`` picks."""
    rows = moment_changes(detail, "id", ["province_id", "order_id"], order, ttl, {"paid": amount(F.col("split_total_amount"))})
    rows = asked(rows) if asked else rows
    orders = event_time(rows, "s").groupBy(F.window("et", size).alias("_w"), "province_id", "order_id").agg(
        *[x for s in SIDES for x in (F.max(F.col(s).isNotNull()).alias(f"_{s}"), F.sum(f"{s}.paid").alias(f"_{s}_paid"))])
    return window_changes(orders, size, "province_id", lambda s: {
        "order_count": F.count(F.when(F.col(f"_{s}"), F.col("order_id"))),
        "order_amount": total(F.col(f"_{s}_paid"))}, lambda s: F.max(f"_{s}"), "_w")


def with_province(summed: DataFrame, province: DataFrame) -> DataFrame:
    named = enrich(summed, province, "province_id", "id", {"province_name": "name"})
    return named.withColumn("province_name", F.coalesce("province_name", F.lit(""))) \
        .select(*schemas.PROVINCE_ORDER)


def sku_order(detail: DataFrame, products: DataFrame, size: str = REFERENCE_SIZE,
              order: Sequence[str] = (), ttl: int | None = REPEAT_TTL,
              time_mode: str = "event", near: Sequence[str] = ()) -> DataFrame:
    """Amounts by product, summed before the product attributes are joined.
    ``products`` is ``flatten_products`` output.  ``near`` names columns by which the rows already lie together,
    for instance from a join: their repeats are reduced where they are then.  It has no say in the result."""
    return with_products(sku_windows(detail, size, order, ttl, time_mode, near), products)


def sku_windows(detail: DataFrame, size: str, order: Sequence[str], ttl: int | None,
                time_mode: str = "event", near: Sequence[str] = ()) -> DataFrame:
    return sku_sums(event_time(net_measures(detail, ["sku_id"], SKU_MEASURES, order, ttl, near), "s"), size, time_mode)


def sku_sums(rows: DataFrame, size: str, time_mode: str = "event") -> DataFrame:
    return tumble(rows, size, ["sku_id"], [total(F.col(m)).alias(m) for m in SKU_MEASURES], time_mode=time_mode)


def sku_changes(detail: DataFrame, size: str, order: Sequence[str], ttl: int, asked: Rows | None = None) -> DataFrame:
    """``sku_windows`` of the rows with ``_now`` less those of the rows with ``_was``, with counts; or of the windows whose
    rows ``asked`` picks."""
    rows = moment_changes(detail, "id", ["sku_id"], order, ttl, {out: amount(F.col(src)) for out, src in SKU_MEASURES.items()})
    rows = asked(rows) if asked else rows
    return window_changes(event_time(rows, "s"), size, "sku_id", lambda s: {m: total(F.col(s)[m]) for m in SKU_MEASURES},
                          lambda s: F.max(F.col(s).isNotNull()))


SIDES = {"now": 1, "was": -1}


def window_changes(rows: DataFrame, size: str, key: str, sums: Callable[[str], dict[str, Column]],
                   there: Callable[[str], Column], time: str = "et") -> DataFrame:
    """Windows as they are now, and as they were, with counts, where the two differ; one group holds both."""
    both = tumble(rows, size, [key], [F.struct(there(s).alias("there"), *[c.alias(m) for m, c in sums(s).items()]).alias(s)
                                      for s in SIDES], time)
    kept = F.filter(F.array(*[F.struct(f"{s}.*", F.lit(n).cast("bigint").alias(COUNT)) for s, n in SIDES.items()]),
                    lambda x: x["there"])
    return both.where(~F.col("now").eqNullSafe(F.col("was"))).select(
        *[c for c in both.columns if c not in SIDES], F.explode(kept).alias("_x")).select("*", "_x.*").drop("_x", "there")


def with_products(summed: DataFrame, products: DataFrame) -> DataFrame:
    return enrich(summed, products, "sku_id", "sku_id",
                  {c: c for c in SKU_DIMS}).select(*schemas.SKU_ORDER)
