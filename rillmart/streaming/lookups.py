"""Tables that change while streams run: dimension versions and rules folded up to a position."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillmart.operators.keyed import latest_per_key
from rillmart.sources import files
from rillmart.streaming.store import PartStore


class DimVersions:
    """A dimension that is published as whole versions and read in the newest one.

    A stream that calls ``current`` in every micro-batch joins what is true when it looks.  The
    version found may be used again for ``max_age`` seconds, as a cache with that expiry would.
    """

    def __init__(self, spark: SparkSession, where: str, schema: str, max_age: float = 0):
        self.spark, self.where, self.schema, self.max_age = spark, where, schema, max_age
        self.version, self.found_at = None, None

    def newest(self) -> int | None:
        numbers = [int(n.removeprefix("version=")) for n in files.names(self.spark, f"{self.where}/version=*")]
        return max(numbers, default=None)

    def publish(self, rows: DataFrame, keep: int = 2) -> int:
        """Add a version; readers see all of it or none.  The last ``keep`` stay, for those who
        have just looked."""
        number = (self.newest() or 0) + 1
        rows.write.mode("overwrite").parquet(f"{self.where}/_writing/version={number}")
        files.rename(self.spark, f"{self.where}/_writing/version={number}", f"{self.where}/version={number}")
        for name in files.names(self.spark, f"{self.where}/version=*"):
            if int(name.removeprefix("version=")) <= number - keep:
                files.delete(self.spark, f"{self.where}/{name}")
        return number

    def current(self) -> DataFrame:
        now = time.monotonic()
        if self.found_at is None or now - self.found_at >= self.max_age:
            self.version, self.found_at = self.newest(), now
        if self.version is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.where}/version={self.version}")


class RuleBook:
    """The rules in force, folded from a stream of rule events that are each read once.

    ``events`` makes the stream; its checkpoint is the position the folded rules stand for.  Looking
    reads the events behind that position and folds them into the stored last event of each key.
    The last event of a removed rule is kept, so that what an initial snapshot repeats, or an event
    that was sent twice, does not bring it back.
    """

    def __init__(self, spark: SparkSession, events: Callable[[], DataFrame], root: str, keys: Sequence[str],
                 order: Sequence[str], max_age: float = 0):
        self.spark, self.events, self.root = spark, events, root
        self.keys, self.order, self.max_age = list(keys), list(order), max_age
        stream = events()
        self.columns = stream.columns
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema)
        self.store = PartStore(spark, f"{root}/rules", f"{fields}, part int", ["part"])
        self.looked_at = None

    def refresh(self) -> None:
        def fold(batch: DataFrame, batch_id: int) -> None:
            self.store.clean(batch_id)
            batch = batch.persist()
            try:
                read = self.store.index(batch_id)["notes"].get("events", 0) + batch.count()
                known = self.store.read(batch_id).select(*self.columns)
                last = latest_per_key(known.unionByName(batch), self.keys, self.order)
                self.store.replace(batch_id, last.withColumn("part", F.lit(0)), {"part=0"}, {"events": read})
            finally:
                batch.unpersist()

        (self.events().writeStream.foreachBatch(fold).option("checkpointLocation", f"{self.root}/checkpoint")
         .trigger(availableNow=True).start().awaitTermination())

    def current(self) -> DataFrame:
        now = time.monotonic()
        if self.looked_at is None or now - self.looked_at >= self.max_age:
            self.refresh()
            self.looked_at = now
        rest = [c for c in self.columns if c not in (*self.order, "op")]
        return self.store.read(1 << 62).where(F.col("op") != "d").select(*rest)

    def events_read(self) -> int:
        return self.store.index(1 << 62)["notes"].get("events", 0)
