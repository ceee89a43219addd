"""Dimension versions, folded rules and fences while streams run."""

import json

from conftest import rows
from test_streaming import Feed

from rillmart import registry, schemas
from rillmart.operators import dims, routing
from rillmart.plans import facts
from rillmart.session import shared_dir
from rillmart.sources import readers, sinks
from rillmart.streaming import jobs
from rillmart.streaming.lookups import DimVersions, RuleBook

SF = "/root/testdata/sf0.001"
DIC = "dic_code string, dic_name string"


def test_a_stream_sees_the_newest_version(spark, tmp_path):
    feed, root = Feed(tmp_path / "in"), shared_dir(spark, "live")
    dic = DimVersions(spark, str(tmp_path / "dic"), DIC)

    def run(n):
        data = {"id": str(n), "appraise": "1", "comment_txt": "x"}
        feed.send({"database": "d", "table": "comment_info", "type": "insert", "ts": n, "data": data, "offset": n})
        log = readers.read_changelog(spark, feed.topic, delay=None)
        return sorted((r.id, r.appraise_name) for r in jobs.with_dims(log, facts.comment, {"dic": dic}, "live", root).collect())

    assert run(1) == []
    dic.publish(spark.createDataFrame([("1", "good")], DIC))
    assert run(2) == [("2", "good")]
    dic.publish(spark.createDataFrame([("1", "fine"), ("2", "bad")], DIC))
    assert run(3) == [("2", "good"), ("3", "fine")]


def test_a_version_is_used_for_its_age(spark, tmp_path):
    first = spark.createDataFrame([("1", "a")], DIC)
    held = DimVersions(spark, str(tmp_path), DIC, max_age=3600)
    held.publish(first)
    assert held.current().count() == 1
    other = DimVersions(spark, str(tmp_path), DIC)
    other.publish(spark.createDataFrame([("1", "a"), ("2", "b")], DIC))
    assert held.current().count() == 1 and other.current().count() == 2
    held.found_at -= 4000
    assert held.current().count() == 2
    other.publish(first)
    assert sorted(p.name for p in tmp_path.glob("version=*")) == ["version=2", "version=3"]


def rule(op, table, columns, at, offset):
    body = {"source_table": table, "source_type": "insert", "sink_table": f"to_{table}", "sink_columns": columns}
    return {"op": op, "before": body if op in "ud" else None, "after": body if op != "d" else None, "ts_ms": at, "offset": offset}


def test_rules_are_folded_from_where_the_last_look_ended(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    book = RuleBook(spark, lambda: readers.read_config_changes(spark, feed.topic, stream=True), str(tmp_path / "rules"),
                    ["source_table", "source_type"], ["ts_ms", "offset"])

    def look():
        return sorted((r.source_table, r.sink_columns) for r in book.current().collect())

    assert look() == []
    feed.send(rule("r", "a", "x", 1, 1), rule("r", "b", "x", 1, 2))
    assert look() == [("a", "x"), ("b", "x")]
    # A change, a removal, and what the snapshot had said once more.
    feed.send(rule("u", "a", "y", 5, 3), rule("d", "b", "x", 6, 4), rule("r", "b", "x", 1, 2))
    assert look() == [("a", "y")] and book.events_read() == 5
    feed.send(rule("r", "b", "x", 1, 2))
    assert look() == [("a", "y")] and look() == [("a", "y")] and book.events_read() == 6
    feed.send(rule("c", "b", "z", 9, 9))
    assert look() == [("a", "y"), ("b", "z")]


def test_each_rule_event_is_read_once(spark):
    out, book = registry.routed_facts(registry.tune(spark, "UTC"), SF)
    assert out.count() > 0
    assert book.events_read() == spark.read.parquet(f"{SF}/events.parquet").count()


def test_a_rule_change_empties_a_dimension(spark, tmp_path):
    data, config, root = Feed(tmp_path / "data"), Feed(tmp_path / "config"), shared_dir(spark, "fence")
    rules = [("t", "dim_t", "id,name", "info", "id")]
    fields = "source_table string, sink_table string, sink_columns string, sink_family string, sink_row_key string"

    def put(i, ts, **more):
        return {"database": "d", "table": "t", "type": "insert", "ts": ts, "data": {"id": i, **more}, "offset": ts}

    def run():
        events = readers.read_config_changes(spark, config.topic, schemas.DIM_RULE, True)
        where = jobs.sync_dims(readers.read_changelog(spark, data.topic, delay=None),
                               lambda: spark.createDataFrame(rules, fields), "d", "fence", root=root, config=events)
        out = dims.dim_table(sinks.read_dims(spark, where, name="dim_t"), "dim_t", ["id", "name"])
        return sorted((r.row_key, r.name) for r in out.collect())

    body = dict(zip(["source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key"], rules[0]))
    data.send(put("1", 10, name="a"), put("2", 11, name="b"))
    config.send({"op": "r", "before": None, "after": body, "ts_ms": 1, "offset": 1})
    assert run() == [("1", "a"), ("2", "b")]
    config.send({"op": "u", "before": body, "after": body, "ts_ms": 20_000, "offset": 2})
    assert run() == []
    # Written behind the fence, and late from before it.
    data.send(put("2", 21), put("3", 12, name="c"), put("4", 30, name="d"))
    assert run() == [("2", None), ("4", "d")]
    config.send({"op": "d", "before": body, "after": None, "ts_ms": 15_000, "offset": 3})
    assert run() == [("2", None), ("4", "d")]
    assert json.dumps(rows(routing.dim_resets(spark.createDataFrame([("u", "x", 5), ("u", "x", 9), ("c", "x", 11)],
                      "op string, sink_table string, ts_ms bigint")))) == '[["x", 9]]'
