"""Text, money, JSON and naming helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

MONEY = "decimal(16,2)"
AMOUNT = "decimal(38,4)"


def is_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def money(c: Column) -> Column:
    """Text to a two-digit amount; text that is not a number gives null."""
    return c.try_cast(MONEY)


def amount(c: Column) -> Column:
    """Text to a four-digit measure for sums; text that is not a number gives null."""
    return c.try_cast("decimal(20,4)")


def total(c: Column) -> Column:
    return F.sum(c).cast(AMOUNT)


def pair_key(a: Column, b: Column) -> Column:
    return F.concat_ws(":", a, b)


def json_record(*columns: str | Column) -> Column:
    """One JSON line from the given columns; null fields are left out."""
    return F.to_json(F.struct(*columns))


def camel_columns(df: DataFrame) -> DataFrame:
    """order_detail_id -> orderDetailId, for readers of typed objects."""
    return df.toDF(*[re.sub(r"_(\w)", lambda m: m.group(1).upper(), c) for c in df.columns])


def keep_listed(data: Column, listed: Column) -> Column:
    """Map entries whose name is in a comma list.  Names are compared exactly:
    no trimming, so "a, b" lists "a" and " b"."""
    names = F.split(listed, ",")
    return F.map_filter(data, lambda name, _: F.array_contains(names, name))
