"""Epoch numbers, timestamps and text, all in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Text forms of dates and times in topics and result tables.
DATE = "yyyy-MM-dd"
DATETIME = "yyyy-MM-dd HH:mm:ss"
COMPACT_DATE = "yyyyMMdd"

DAY_MS = 24 * 60 * 60 * 1000


def from_seconds(ts: Column) -> Column:
    return F.timestamp_seconds(ts)


def from_millis(ts: Column) -> Column:
    return F.timestamp_millis(ts)


def text_to_millis(text: Column) -> Column:
    return F.unix_millis(F.to_timestamp(text, DATETIME))


def date_to_millis(text: Column) -> Column:
    """Midnight of a ``yyyy-MM-dd`` text."""
    return F.unix_millis(F.to_timestamp(text, DATE))


def millis_to_date(ts: Column) -> Column:
    return F.date_format(from_millis(ts), DATE)


def millis_to_datetime(ts: Column) -> Column:
    return F.date_format(from_millis(ts), DATETIME)


def millis_to_compact_date(ts: Column) -> Column:
    return F.date_format(from_millis(ts), COMPACT_DATE)


def date_of_text(text: Column) -> Column:
    """Date part of a ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.date_format(F.to_timestamp(text, DATETIME), DATE)


def window_text(window: Column) -> list[Column]:
    """stt, edt and cur_date of a window column."""
    return [F.date_format(window["start"], DATETIME).alias("stt"),
            F.date_format(window["end"], DATETIME).alias("edt"),
            F.date_format(window["start"], DATE).alias("cur_date")]
