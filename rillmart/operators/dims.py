"""Dimension tables as folded cells.

A dimension is kept as one row per (table, row key, column): the newest non-empty
value and when it was written, plus one marker per row key for its last deletion.
Folding takes maxima, so cells of different batches can be folded in any grouping:
a stream only appends the folded cells of its batch, and readers or a compaction
fold again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rillmart.functions.fields import is_blank
from rillmart.operators.joins import enrich

CELL = ["sink_table", "row_key", "column"]


def to_cells(routed: DataFrame, order: Sequence[str]) -> DataFrame:
    """Routed changes to folded cells.  A put writes its non-empty fields only; a
    delete leaves a marker whose column is null.  ``order`` starts with the time in seconds
    and must tell a row's changes of one second apart by their arrival: (ts, offset).

    Cells are sorted in the task that makes them, so changes are dealt out evenly before: a task's memory
    does not follow from how the input was split."""
    routed = routed.hint("rebalance")
    at = F.struct(*order).alias("at")
    puts = (routed.where(F.col("op") != "delete")
            .select("sink_table", "row_key", F.explode("data").alias("column", "value"), at)
            .where(~is_blank(F.col("value"))))
    deletes = (routed.where(F.col("op") == "delete")
               .select("sink_table", "row_key", F.lit(None).cast("string").alias("column"),
                       F.lit(None).cast("string").alias("value"), at))
    return merge_cells(puts.unionByName(deletes))


def merge_cells(cells: DataFrame) -> DataFrame:
    newest = F.max_by(F.struct("at", "value"), "at").alias("_n")
    return cells.groupBy(*CELL).agg(newest).select(*CELL, "_n.*")


def rows_of(cells: DataFrame, resets: DataFrame | None = None,
            ts: str = "ts") -> DataFrame:
    """Folded cells to current rows (sink_table, row_key, data).

    Only cells newer than the row's last deletion count, and newer than the last
    reset of their dimension when ``resets`` is given (``ts`` of the cells in
    seconds).  One group holds no more rows than the dimension has columns.
    """
    if resets is not None:
        cells = (cells.join(resets, "sink_table", "left")
                 .where(F.col("reset_ms").isNull()
                        | (F.col("at")[ts] * 1000 > F.col("reset_ms"))).drop("reset_ms"))
    deleted = F.max(F.when(F.col("column").isNull(), F.col("at"))).alias("_deleted")
    written = F.collect_list(F.when(F.col("column").isNotNull(),
                                    F.struct("column", "value", "at"))).alias("_written")
    alive = F.filter("_written", lambda c: F.col("_deleted").isNull()
                     | (c["at"] > F.col("_deleted")))
    data = F.map_from_entries(F.transform(alive, lambda c: F.struct(c["column"], c["value"])))
    return (cells.groupBy("sink_table", "row_key").agg(deleted, written)
            .select("sink_table", "row_key", data.alias("data"))
            .where(F.size("data") > 0))


def fold_dims(routed: DataFrame, order: Sequence[str],
              resets: DataFrame | None = None) -> DataFrame:
    return rows_of(to_cells(routed, order), resets, order[0])


def dim_table(rows: DataFrame, name: str, fields: Sequence[str]) -> DataFrame:
    """One dimension with its fields as columns, keyed by ``row_key``."""
    return rows.where(F.col("sink_table") == name).select(
        "row_key", *[F.col("data")[f].alias(f) for f in fields])


def flatten_products(sku: DataFrame, spu: DataFrame, trademark: DataFrame, category3: DataFrame,
                     category2: DataFrame, category1: DataFrame) -> DataFrame:
    """The product snowflake as one row per sku, so that facts are joined once.
    A hop whose dimension row is missing leaves nulls, also in the hops behind it."""
    out = sku.withColumnRenamed("tm_id", "trademark_id")
    hops = [(spu, "spu_id", {"spu_name": "spu_name"}),
            (trademark, "trademark_id", {"trademark_name": "tm_name"}),
            (category3, "category3_id", {"category3_name": "name", "category2_id": "category2_id"}),
            (category2, "category2_id", {"category2_name": "name", "category1_id": "category1_id"}),
            (category1, "category1_id", {"category1_name": "name"})]
    for dim, on, fields in hops:
        out = enrich(out, dim, on, "id", fields)
    return out.withColumnRenamed("id", "sku_id")
