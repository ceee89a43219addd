"""Configuration-driven routing of the change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rillmart.functions.fields import keep_listed
from rillmart.operators.keyed import latest_per_key

# Fixed value: configuration changes that empty the dimension they are about.
EMPTYING_OPS = ["u", "d"]


def rule_events(config: DataFrame) -> DataFrame:
    """(op, before, after, ts_ms) envelopes to flat rule rows with their op.
    A removed rule is described by ``before``, any other by ``after``."""
    rule = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    rest = [c for c in config.columns if c not in ("before", "after")]
    return config.select(*rest, rule.alias("_rule")).select(*rest, "_rule.*")


def latest_rules(events: DataFrame, keys: Sequence[str],
                 order: Sequence[str]) -> DataFrame:
    """The rules in force: the last event of each key, unless it removes the rule.  ``order``
    must tell the events of one moment apart, for instance (ts_ms, offset)."""
    rest = [c for c in events.columns if c not in keys and c not in order]
    last = latest_per_key(events, keys, order)
    return last.where(F.col("op") != "d").select(*keys, *[c for c in rest if c != "op"])


def dim_resets(events: DataFrame) -> DataFrame:
    """When each dimension was last emptied by a rule change, in epoch ms."""
    return (events.where(F.col("op").isin(EMPTYING_OPS))
            .groupBy("sink_table").agg(F.max("ts_ms").alias("reset_ms")))


def route_dims(log: DataFrame, rules: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Change-log rows whose table has a dimension rule: target, row key, operation
    and the payload fields the rule lists.  ``keep``: the columns that order changes."""
    ruled = log.join(rules, F.col("table") == F.col("source_table"))
    return ruled.select(
        "sink_table", F.element_at("data", F.col("sink_row_key")).alias("row_key"),
        F.col("type").alias("op"), keep_listed(F.col("data"), F.col("sink_columns")).alias("data"),
        *keep)


def route_facts(log: DataFrame, rules: DataFrame) -> DataFrame:
    """Change-log rows whose (table, type) has a fact rule: target and payload, with
    the record's ts added to the payload.

    There are as many rules as tables and types, however long their history, and a shuffle by those would
    put a table's whole log into one task: the one place that asks for a broadcast."""
    ruled = log.join(F.broadcast(rules), (F.col("table") == F.col("source_table"))
                     & (F.col("type") == F.col("source_type")))
    listed = keep_listed(F.col("data"), F.col("sink_columns"))
    without_ts = F.map_filter(listed, lambda name, _: name != "ts")
    stamp = F.create_map(F.lit("ts"), F.col("ts").cast("string"))
    return ruled.select("sink_table", F.map_concat(without_ts, stamp).alias("data"), "ts")
