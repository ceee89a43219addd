"""What a task holds does not grow with the input."""

import random

from pyspark.sql import functions as F

from rillmart.functions import text
from rillmart.operators import dims, routing


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_changes_are_dealt_out_before_they_are_sorted_as_cells(spark):
    routed = spark.range(5000).coalesce(1).select(
        F.lit("d").alias("sink_table"), F.col("id").cast("string").alias("row_key"), F.lit("insert").alias("op"),
        F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")).alias("data"), F.col("id").alias("ts"), F.lit(0).alias("offset"))
    cells = dims.to_cells(routed, ["ts", "offset"])
    assert "RebalancePartitions" in plan_of(cells) and cells.count() == 10_000


def test_a_log_is_routed_without_a_shuffle(spark):
    """Also when the history of the rules looks too large to be sent around."""
    log = spark.range(1000).select(F.lit("t").alias("table"), F.lit("insert").alias("type"),
                                   F.create_map(F.lit("id"), F.col("id").cast("string")).alias("data"), F.col("id").alias("ts"))
    events = spark.range(100).selectExpr("'t' source_table", "'insert' source_type", "'s' sink_table", "'id' sink_columns",
                                         "'c' op", "id ts_ms")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = routing.route_facts(log, routing.latest_rules(events, ["source_table", "source_type"], ["ts_ms"]))
        assert out.count() == 1000 and "SortMergeJoin" not in plan_of(out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_runs_are_cut_a_part_at_a_time(monkeypatch):
    rng, sizes = random.Random(3), []
    trie = text.WordTrie(["ab", "abc", "ca", "b"])
    runs = ["".join(rng.choices("abcx", k=rng.randrange(1, 40))) for _ in range(300)]
    want = [list(trie.cut(run)) for run in runs]
    whole = trie.longest_at
    monkeypatch.setattr(trie, "longest_at", lambda codes: sizes.append(len(codes)) or whole(codes))
    for chars in (1, 100, 1 << 20):
        sizes.clear()
        assert list(trie.cut_runs(runs, chars)) == want and max(sizes) <= max(chars + 40, sum(map(len, runs)) + 300)
        assert chars > 100 or max(sizes) <= chars + 40
    assert list(trie.cut_runs([])) == []
