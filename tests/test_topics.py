"""Topics that the registered streams read, and the differences that window jobs publish."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rillmart import registry
from rillmart.plans import trade
from rillmart.sources import files, readers, sinks

T = 1_704_067_200


def test_topics_are_compressed_and_read_in_order(spark):
    """One pass writes all parts: a quarter of the bytes of plain lines, one micro-batch for each slice of time."""
    lines = spark.range(4000).repartition(7).select((F.col("id") * 3).alias("ts"), F.lit("same text " * 20).alias("text"))
    for deal in (registry.topic, registry.out_of_order):
        topic = deal(spark, "t", registry.as_lines(lines))
        found = [files.names(spark, f"{topic.where}/part={k}/*", 2) for k in range(registry.PARTS)]
        assert {str(len(f)) for f in found} == {topic.options["maxFilesPerTrigger"]}
        assert all(f.endswith(".gz") or "/none-" in f for own in found for f in own)
        assert readers.read_lines(spark, topic, False).count() == 4000
    topic, seen = registry.topic(spark, "t", registry.as_lines(lines)), []

    def write(batch, _):
        seen.append([int(r.ts) for r in batch.select(F.get_json_object("value", "$.ts").alias("ts")).collect()])
    readers.read_lines(spark, topic).writeStream.foreachBatch(write).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == registry.PARTS and sum(map(len, seen)) == 4000
    assert all(max(a) < min(b) for a, b in zip(seen, seen[1:]))


def test_topics_without_rows(spark):
    none = spark.createDataFrame([], "ts bigint, x string")
    topic = registry.out_of_order(spark, "none", registry.as_lines(none))
    assert readers.read_lines(spark, topic, False).count() == 0


def test_keyed_tables_are_read_by_column(spark, tmp_path):
    table = spark.createDataFrame([("a", 1, "x", "p"), ("a", 2, "y", "q"), ("b", 1, None, "r")], "id string, ts int, v string, w string")
    sinks.upsert(str(tmp_path / "t"), ["id"], ["ts"])(table, 0)
    got = sinks.read_upserted(spark, str(tmp_path / "t"), ["id"], ["ts"], columns=["v"])
    assert got.columns == ["id", "ts", "v"] and rows(got) == [("a", 2, "y"), ("b", 1, None)]


@pytest.mark.parametrize("job, windows, changes", [("sku", trade.sku_windows, trade.sku_changes),
                                                   ("province", trade.province_windows, trade.province_changes)])
def test_differences_of_windows(spark, job, windows, changes):
    """Rows with nulls, repeats, and some that were there, are there, or both."""
    rng, made = random.Random(5), []
    for _ in range(400):
        paid = rng.choice([None, "x", "1.5", "2", "7.25"])
        made.append((rng.choice([None, "a", "b", "c", "d"]), rng.choice([None, "o1", "o2"]), rng.choice(["s1", "s2", None]),
                     rng.choice(["p", None]), *[paid] * 4, T + rng.randrange(1500), rng.choice([None, "1", "2"]),
                     *rng.choice([(True, True), (True, False), (False, True)])))
    detail = spark.createDataFrame(made, "id string, order_id string, sku_id string, province_id string, " + ", ".join(
        f"{c} string" for c in trade.SKU_MEASURES.values()) + ", ts bigint, tie string, _now boolean, _was boolean")
    for size in ("10 seconds", "1 day"):
        now, was = [windows(detail.where(s).drop("_now", "_was"), size, ["tie"], 10) for s in ("_now", "_was")]
        got = changes(detail, size, ["tie"], 10)
        added, dropped = [got.where(F.col("_count") == n).drop("_count") for n in (1, -1)]
        assert added.columns == now.columns and got.count() == added.count() + dropped.count()
        assert rows(added) == rows(now.exceptAll(was)) and rows(dropped) == rows(was.exceptAll(now))
