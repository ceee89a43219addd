"""Tables that micro-batches keep, cut into parts that are read and replaced as a whole.

A part is a folder named by its partition columns (a slice of time, a day, a bucket of keys).  A
micro-batch reads the parts its rows fall in and writes those it changes anew, old and new rows
together, so a part never holds more than a few files: what a batch reads follows from its own
rows, not from how many batches came before.  A large part that only grows takes the new rows in as one
more folder, of a bounded number.  An index for each batch names the batch that wrote
each live part.  It is written last, so a batch that is run again starts from the same index and
overwrites what it left; folders that no later run can need are deleted when the next batch starts.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType

from rillmart.sources import files


# Parts below this many bytes are written anew when they grow; larger ones have up to so many folders.
SMALL, FOLDERS = 4 << 20, 8


class PartStore:
    """``schema``: all columns; ``by``: those that name a part, never null."""

    def __init__(self, spark: SparkSession, where: str, schema: StructType | str, by: Sequence[str]):
        self.spark, self.where, self.by = spark, where, list(by)
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def index(self, batch_id: int) -> dict:
        """What was live when the batch started: ``parts`` (folder to the batch that wrote it last), ``older`` (to
        the batches before whose rows it has, too) and ``notes``."""
        numbers = [int(n) for n in files.names(self.spark, f"{self.where}/index/*") if n.isdigit()]
        before = max((n for n in numbers if n < batch_id), default=None)
        if before is None:
            return {"parts": {}, "older": {}, "notes": {}}
        return json.loads(files.read_text(self.spark, f"{self.where}/index/{before}"))

    def clean(self, batch_id: int) -> None:
        """Delete what only batches before the last one could read."""
        numbers = sorted(int(n) for n in files.names(self.spark, f"{self.where}/index/*") if n.isdigit())
        live = self._folders(self.index(batch_id))
        for old in [n for n in numbers if n < batch_id][:-1]:
            for folder in self._folders(json.loads(files.read_text(self.spark, f"{self.where}/index/{old}"))) - live:
                files.delete(self.spark, f"{self.where}/data/{folder}")
            files.delete(self.spark, f"{self.where}/index/{old}")

    def _folders(self, index: dict, wanted: set[str] | None = None) -> set[str]:
        return {f"version={n}/{p}" for p, v in index["parts"].items() if wanted is None or p in wanted
                for n in (v, *index["older"].get(p, ()))}

    def part_names(self, parts: DataFrame) -> set[str]:
        """The folders of some parts; their number is bounded by that of the parts there are."""
        return {"/".join(f"{c}={r[c]}" for c in self.by) for r in parts.select(*self.by).distinct().collect()}

    def sizes(self, batch_id: int, wanted: set[str]) -> dict[str, int]:
        """Bytes of those of the wanted parts that there were when the batch started."""
        index = self.index(batch_id)
        return {p: sum(files.size(self.spark, f"{self.where}/data/{f}") for f in self._folders(index, {p}))
                for p in wanted & index["parts"].keys()}

    def read(self, batch_id: int, wanted: set[str] | None = None) -> DataFrame:
        """The rows of the wanted parts, or of all, when the batch started."""
        paths = sorted(f"{self.where}/data/{f}" for f in self._folders(self.index(batch_id), wanted))
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        schema = StructType([*self.schema.fields, StructField("version", IntegerType())])
        return self.spark.read.schema(schema).option("basePath", f"{self.where}/data").parquet(*paths).drop("version")

    def write(self, rows: DataFrame, folder: str, order: Sequence[str] = ()) -> set[str]:
        """Write rows as parts below a folder, few files each; returns the names of the parts."""
        dealt = rows.select(*self.schema.names).hint("rebalance", *self.by)
        if order:
            dealt = dealt.sortWithinPartitions(*self.by, *order)
        dealt.write.mode("overwrite").option("compression", "zstd").partitionBy(*self.by).parquet(folder)
        return set(files.names(self.spark, f"{folder}/" + "/".join(f"{c}=*" for c in self.by), len(self.by)))

    def add(self, batch_id: int, fresh: str, parts: set[str], notes: Mapping | None = None, order: Sequence[str] = ()) -> None:
        """Take in the parts that ``write`` has written below the folder ``fresh``, moving what needs no writing."""
        before, folder = self.index(batch_id), f"{self.where}/data/version={batch_id}"
        files.delete(self.spark, folder)
        older = {p: [before["parts"][p], *before["older"].get(p, ())] for p in parts if p in before["parts"]}

        def grown(p: str) -> int:
            return sum(files.size(self.spark, x) for x in (f"{fresh}/{p}", *(f"{self.where}/data/version={v}/{p}" for v in older[p])))
        anew = {p for p, v in older.items() if len(v) >= FOLDERS or grown(p) < SMALL}
        if anew:
            came = self.spark.read.schema(self.schema).option("basePath", fresh).parquet(*sorted(f"{fresh}/{p}" for p in anew))
            self.write(self.read(batch_id, anew).unionByName(came), folder, order)
        for p in parts - anew:
            files.make_folder(self.spark, f"{folder}/{p}".rsplit("/", 1)[0])
            files.rename(self.spark, f"{fresh}/{p}", f"{folder}/{p}")
        kept = {p: v for p, v in before["older"].items() if p not in parts} | {p: v for p, v in older.items() if p not in anew}
        self._set_index(batch_id, before, before["parts"] | dict.fromkeys(parts, batch_id), kept, notes)

    def _set_index(self, batch_id: int, before: dict, parts: dict, older: dict, notes: Mapping | None) -> None:
        index = {"parts": parts, "older": older, "notes": {**before["notes"], **(notes or {})}}
        files.write_text(self.spark, f"{self.where}/index/{batch_id}", json.dumps(index))

    def replace(self, batch_id: int, rows: DataFrame, wanted: set[str], notes: Mapping | None = None,
                expired: Callable[[dict[str, str]], bool] | None = None, order: Sequence[str] = ()) -> None:
        """Let ``rows`` be all the rows of the wanted parts.  Parts that ``expired`` holds for, by the
        values in their names, are forgotten.  ``order`` sorts files, which lets readers skip some."""
        before, folder = self.index(batch_id), f"{self.where}/data/version={batch_id}"
        written = self.write(rows, folder, order) if wanted else set()
        parts = {p: v for p, v in before["parts"].items() if p not in wanted} | dict.fromkeys(written, batch_id)
        if expired:
            parts = {p: v for p, v in parts.items() if not expired(dict(c.split("=", 1) for c in p.split("/")))}
        older = {p: v for p, v in before["older"].items() if p in parts and p not in wanted}
        self._set_index(batch_id, before, parts, older, notes)


def publish(rows: DataFrame | Sequence[DataFrame], where: str, batch_id: int) -> None:
    """Add a micro-batch's rows as ``batch_id=N``, all at once, for streams that read the folder.  A
    batch that is run again finds its rows there and leaves them.  Several frames are worked out one after another."""
    frames = [rows] if isinstance(rows, DataFrame) else rows
    spark, done = frames[0].sparkSession, f"{where}/batch_id={batch_id}"
    if files.exists(spark, f"{done}/_SUCCESS"):
        return
    files.delete(spark, done)
    for n, frame in enumerate(frames):
        frame.write.mode("append" if n else "overwrite").option("compression", "zstd").parquet(f"{where}/_writing/batch_id={batch_id}")
    files.rename(spark, f"{where}/_writing/batch_id={batch_id}", done)
