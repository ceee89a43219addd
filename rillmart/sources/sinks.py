"""Where results go.

Micro-batch writers put each batch into its own ``batch_id=N`` folder and overwrite
that folder, so a batch that is run again after a failure leaves one copy.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rillmart.functions.fields import json_record
from rillmart.operators.dims import merge_cells, rows_of, to_cells
from rillmart.operators.keyed import latest_per_key
from rillmart.sources import files
from rillmart.sources.readers import COUNT

Writer = Callable[[DataFrame, int], None]
# So many hashes of eight bytes are small enough to be sent to every task.
FEW = 500_000


def to_lines(df: DataFrame, key: str | None = None, topic: str | Column | None = None,
             deleted: Column | None = None) -> DataFrame:
    """Rows as (topic, key, value) messages: value is the JSON of all columns.  The
    topic may be a constant or a column, which sends each row to its own target.  A row for
    which ``deleted`` holds is a tombstone: its key with a null value."""
    value = json_record(*df.columns)
    if deleted is not None:
        value = F.when(~F.coalesce(deleted, F.lit(False)), value)
    out = [value.alias("value")]
    if key:
        out.insert(0, json_record(key).alias("key"))
    if topic is not None:
        out.insert(0, (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"))
    return df.select(*out)


def write_lines(lines: DataFrame, checkpoint: str, where: str | None = None, fmt: str = "text",
                **options: str):
    """A streaming writer of messages: text files, or Kafka with its options.  File
    output is exactly once; it is split by ``topic`` when the messages have one."""
    writer = (lines.writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint).options(**options))
    if fmt != "kafka" and "topic" in lines.columns:
        writer = writer.partitionBy("topic")
    return writer.option("path", where) if where else writer


def console(df: DataFrame, name: str):
    """A print tap for looking at a stream while developing."""
    return df.writeStream.format("console").queryName(name).outputMode("append")


def write_batches(where: str, fmt: str = "parquet", split_by: Sequence[str] = ()) -> Writer:
    """Append every micro-batch as files, optionally split by target columns.  Rows are gathered
    by target first, so that a batch adds few files, and a target with many rows is cut."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if split_by:
            batch = batch.hint("rebalance", *split_by)
        writer = batch.write.mode("overwrite").format(fmt)
        if split_by:
            writer = writer.partitionBy(*split_by)
        writer.save(f"{where}/batch_id={batch_id}")
    return write


def fan_out(targets: dict[str, Callable[[DataFrame], DataFrame]], where: str,
            fmt: str = "json") -> Writer:
    """Write several derived frames of one micro-batch, which is computed once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for name, derive in targets.items():
                derive(kept).write.mode("overwrite").format(fmt).save(
                    f"{where}/{name}/batch_id={batch_id}")
        finally:
            kept.unpersist()
    return write


def upsert(where: str, keys: Sequence[str], order: Sequence[str]) -> Writer:
    """Keyed table: each micro-batch adds its latest row per key.  ``read_upserted``
    folds the batches; ``compact_upserted`` replaces them by one."""
    inner = write_batches(where)
    return lambda batch, batch_id: inner(latest_per_key(batch, keys, order), batch_id)


def read_upserted(spark: SparkSession, where: str, keys: Sequence[str], order: Sequence[str],
                  deleted: Column | None = None, columns: Sequence[str] = ()) -> DataFrame:
    """Current rows of a keyed table; rows for which ``deleted`` holds are tombstones.  With ``columns``,
    only those are read, beside keys and order."""
    stored = spark.read.parquet(where).drop("batch_id")
    if columns:
        stored = stored.select(*dict.fromkeys([*keys, *order, *columns]))
    rows = latest_per_key(stored, keys, order)
    return rows if deleted is None else rows.where(~F.coalesce(deleted, F.lit(False)))


def compact_upserted(spark: SparkSession, where: str, into: str, keys: Sequence[str],
                     order: Sequence[str]) -> None:
    read_upserted(spark, where, keys, order).write.parquet(f"{into}/batch_id=-1")


def count_rows(rows: DataFrame) -> DataFrame:
    """Equal rows as one with the sum of their counts; those that cancel out are left out."""
    own = [c for c in rows.columns if c != COUNT]
    return rows.groupBy(*own).agg(F.sum(COUNT).alias(COUNT)).where(F.col(COUNT) != 0)


def read_counted(spark: SparkSession, where: str) -> DataFrame:
    """Current rows of a table whose batches add and take back rows, each as often as it counts.  Only rows
    that may have been taken back have to be compared; when those are few, their hashes go to all tasks."""
    rows = spark.read.parquet(where).drop("batch_id")
    hashed = rows.withColumn("_hash", F.xxhash64(*[c for c in rows.columns if c != COUNT]))
    taken = hashed.where(F.col(COUNT) < 0).select("_hash").distinct()
    found = taken.limit(FEW + 1).count()
    if found > FEW:
        rows = count_rows(rows)
    elif found:
        rest, may = [hashed.join(F.broadcast(taken), "_hash", how).select(*rows.columns) for how in ("left_anti", "left_semi")]
        rows = rest.unionByName(count_rows(may))
    return rows.withColumn(COUNT, F.explode(F.sequence(F.lit(1), F.col(COUNT)))).drop(COUNT)


def sum_rows(rows: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """One row per key.  A row all of whose sums come to nothing is no row."""
    summed = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    left = F.lit(False)
    for c in sums:
        left |= F.coalesce(F.col(c) != 0, F.lit(False))
    return summed.where(left)


def read_summed(spark: SparkSession, where: str, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Current rows of a summary whose batches add to sums, or take from them."""
    return sum_rows(spark.read.parquet(where), keys, sums)


def store_dims(where: str, order: Sequence[str]) -> Writer:
    """Dimension sink: each micro-batch of routed changes adds its folded cells,
    laid out by dimension so that a reader of one opens only its files."""
    inner = write_batches(where, split_by=["sink_table"])
    return lambda batch, batch_id: inner(to_cells(batch, order), batch_id)


FENCE = "sink_table string, reset_ms bigint"


def store_fences(where: str) -> Writer:
    """When rule changes emptied dimensions, beside the cells of ``store_dims``."""
    return write_batches(f"{where}/_fences")


def read_dims(spark: SparkSession, where: str, resets: DataFrame | None = None,
              name: str | None = None, ts: str = "ts") -> DataFrame:
    """Current dimension rows (sink_table, row_key, data), behind the last fence or reset of each."""
    cells = spark.read.parquet(where).drop("batch_id")
    if name:
        cells = cells.where(F.col("sink_table") == name)
    fences = [] if resets is None else [resets.select("sink_table", "reset_ms")]
    if files.exists(spark, f"{where}/_fences"):
        # A path below the folder's name is read although the name starts with an underscore.
        fences += [spark.read.schema(FENCE).parquet(f"{where}/_fences/{f}") for f in files.names(spark, f"{where}/_fences/batch_id=*")]
    last = functools.reduce(DataFrame.unionByName, fences).groupBy("sink_table").agg(
        F.max("reset_ms").alias("reset_ms")) if fences else None
    return rows_of(merge_cells(cells), last, ts)


def compact_dims(spark: SparkSession, where: str, into: str) -> None:
    """One batch of folded cells instead of many; writing goes on in ``into``."""
    cells = merge_cells(spark.read.parquet(where).drop("batch_id"))
    cells.write.partitionBy("sink_table").parquet(f"{into}/batch_id=-1")
