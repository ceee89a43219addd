"""Event time and tumbling windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rillmart.functions.timefmt import window_text

REFERENCE_SIZE = "10 seconds"


def event_time(df: DataFrame, unit: str = "ms", delay: str | None = None,
               ts: str = "ts") -> DataFrame:
    """Add ``et`` from an epoch column (``unit`` 's' or 'ms') and, on a stream,
    a watermark that allows ``delay`` of disorder."""
    convert = F.timestamp_seconds if unit == "s" else F.timestamp_millis
    out = df.withColumn("et", convert(F.col(ts)))
    return out.withWatermark("et", delay) if delay is not None and df.isStreaming else out


def tumble(df: DataFrame, size: str, keys: Sequence[str], aggregates: Sequence[Column],
           time: str = "et", time_mode: str = "event") -> DataFrame:
    """Tumbling, left-closed, epoch-aligned windows with text bounds.

    Partial aggregation runs before the shuffle, so neither a global window nor
    a hot key puts more than one row per task and group on the wire.
    ``time_mode='processing'`` takes the wall clock instead of ``time``; on a stream, that of
    the micro-batch, and a window is sent once a later micro-batch starts after its end.
    """
    if time_mode == "processing":
        df, time = df.withColumn("_pt", F.current_timestamp()), "_pt"
        if df.isStreaming:
            df = df.withWatermark("_pt", "0 seconds")
    clock = F.col(time)
    return (df.groupBy(F.window(clock, size).alias("_w"), *keys).agg(*aggregates)
            .select(*window_text(F.col("_w")), "*").drop("_w"))
