"""Result tables of summary streams: one row a window, whatever is sent again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillmart.functions.fields import json_record
from rillmart.sources import files, sinks
from rillmart.streaming.store import PartStore

DAY = "cur_date"
LATEST = 1 << 62


class ResultTable:
    """Windows by (bounds, dimensions) with their sums, in parts by day.

    ``changes`` is the folder of a job's changes to windows, as ``publish`` fills it.  Each file there
    is a load, labelled by its batch and name.  The table's index lists the labels it holds, together
    with the parts that hold them, so a load that comes again, from a new checkpoint, in other
    micro-batches or after a failure, is left out.  Batches that are in with all their files, as all
    before them are, count as one label.
    """

    def __init__(self, spark: SparkSession, where: str, shape: DataFrame, sums: Sequence[str]):
        self.spark, self.columns, self.sums = spark, shape.columns, list(sums)
        self.keys = [c for c in shape.columns if c not in sums]
        self.schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shape.schema)
        self.store = PartStore(spark, where, self.schema, [DAY])

    def load(self, changes: str, checkpoint: str, **options: str) -> None:
        """Take in what the folder has and the checkpoint has not seen."""
        stream = self.spark.readStream.schema(f"{self.schema}, batch_id int").options(**options).parquet(changes)
        named = stream.withColumn("_file", F.col("_metadata.file_name"))
        (named.writeStream.foreachBatch(lambda batch, _: self._write(batch, changes))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())

    def _write(self, batch: DataFrame, changes: str) -> None:
        # A turn of its own counts the loads: another checkpoint counts batches from zero.
        notes = self.store.index(LATEST)["notes"]
        turn, through, held = notes.get("turn", -1) + 1, notes.get("through", -1), notes.get("files", [])
        self.store.clean(turn)
        fresh = batch.where((F.col("batch_id") > through) & ~F.col("_file").isin(held))
        held = {*held, *(r["_file"] for r in fresh.select("_file").distinct().collect())}
        wanted = self.store.part_names(fresh)
        rows = self.store.read(turn, wanted).select(*self.columns).unionByName(fresh.select(*self.columns))
        while files.exists(self.spark, f"{changes}/batch_id={through + 1}"):
            whole = set(files.names(self.spark, f"{changes}/batch_id={through + 1}/part-*"))
            # Files without rows never turn up.
            if any(self._has_rows(f"{changes}/batch_id={through + 1}/{w}") for w in whole - held):
                break
            held, through = held - whole, through + 1
        self.store.replace(turn, sinks.sum_rows(rows, self.keys, self.sums).select(*self.columns), wanted,
                           {"turn": turn, "through": through, "files": sorted(held)})

    def _has_rows(self, file: str) -> bool:
        return not self.spark.read.schema(self.schema).parquet(file).isEmpty()

    def rows(self) -> DataFrame:
        return self.store.read(LATEST).select(*self.columns)

    def lines(self) -> DataFrame:
        """The rows as the JSON records a store is sent."""
        return self.rows().select(json_record(*self.columns).alias("value"))
