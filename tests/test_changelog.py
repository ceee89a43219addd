"""Parsing, filters, routing and log splitting on hand-made records."""

import json
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.functions import fields, text, timefmt
from rillmart.operators import changelog, logsplit, routing
from rillmart.plans import traffic


def lines(spark, *records):
    return spark.createDataFrame([(r if r is None or isinstance(r, str) else json.dumps(r),)
                                  for r in records], "value string")


def log(spark, *records):
    return changelog.parse_json(lines(spark, *records), schemas.CHANGELOG)


UPDATE = {"table": "depot", "type": "update", "ts": 1733011200,
          "data": {"id": 77, "city": "Porto", "lanes": "12", "opened": None}, "old": {"city": "Braga"}}


def test_update_record_parses_to_text(spark):
    row = log(spark, UPDATE, None).collect()
    assert len(row) == 1 and row[0].data == {**UPDATE["data"], "id": "77"}
    assert row[0].old == UPDATE["old"]


def test_bad_record_fails_or_goes_aside(spark):
    src = lines(spark, UPDATE, "not json {", None)
    with pytest.raises(Exception):
        changelog.parse_json(src, schemas.CHANGELOG).collect()
    assert changelog.parse_json(src, schemas.CHANGELOG, "drop").count() == 1
    assert rows(changelog.dirty_records(src, schemas.CHANGELOG)) == [("not json {",)]


def test_changed_to_value_needs_the_field_in_old(spark):
    def change(old):
        return {"table": "t", "type": "update", "ts": 1, "data": {"id": str(old), "s": "2"}, "old": old}
    df = log(spark, change({"s": "1"}), change({"x": "1"}), change({"s": "9"}))
    touched = changelog.changes(df, "t", "update", ["id"], changed=["s"], now={"s": "2"})
    assert touched.count() == 2
    exact = changelog.changes(df, "t", "update", ["id"], was={"s": "1"}, now={"s": "2"})
    assert exact.count() == 1


def test_cart_quantities(spark):
    def cart(id_, kind, num, old=None):
        return {"table": "cart_info", "type": kind, "ts": 1, "old": old,
                "data": {"id": id_, "user_id": "u", "sku_id": "s", "sku_num": num}}
    df = log(spark, cart("a", "insert", "2"), cart("b", "update", "5", {"sku_num": "2"}),
             cart("c", "update", "2", {"sku_num": "5"}), cart("d", "update", "5", {"x": "1"}),
             cart("e", "delete", "5"))
    assert rows(changelog.cart_additions(df).select("id", "sku_num")) == [("a", "2"), ("b", "3")]


def test_gate_and_bootstrap(spark):
    def rec(db, kind, data):
        return {"database": db, "table": "t", "type": kind, "ts": 1, "data": data}
    df = log(spark, rec("shop", "insert", {"id": "1"}), rec("other", "insert", {"id": "2"}),
             rec("shop", "bootstrap-insert", {"id": "3"}), rec("shop", "bootstrap-start", {"id": "4"}),
             rec("shop", "update", {}), rec("shop", "update", None))
    assert rows(changelog.etl_gate(df, "shop").select(F.col("data")["id"])) == [("1",), ("3",)]
    assert changelog.drop_bootstrap(df).count() == 4


def test_columns_are_not_trimmed(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"}, "a, b")], "d map<string,string>, cols string")
    assert df.select(fields.keep_listed(F.col("d"), F.col("cols"))).collect()[0][0] == {"a": "1"}


def test_rules_in_force(spark):
    rule = {"source_table": "t", "source_type": "insert", "sink_table": "x", "sink_columns": "id"}
    other = {**rule, "source_type": "update"}
    events = [{"op": "r", "before": None, "after": rule, "ts_ms": 1},
              {"op": "r", "before": None, "after": other, "ts_ms": 1},
              {"op": "u", "before": rule, "after": {**rule, "sink_columns": "id,v"}, "ts_ms": 2},
              {"op": "d", "before": other, "after": None, "ts_ms": 3}]
    df = changelog.parse_json(lines(spark, *events), schemas.config_change(schemas.FACT_RULE))
    flat = routing.rule_events(df)
    assert flat.where("op = 'd'").collect()[0].source_type == "update"
    live = routing.latest_rules(flat, ["source_table", "source_type"], ["ts_ms"])
    assert [r.asDict() for r in live.collect()] == [
        {**rule, "sink_columns": "id,v"}]
    data = log(spark, {"table": "t", "type": "insert", "ts": 9, "data": {"id": "1", "v": "2", "w": "3"}},
               {"table": "t", "type": "update", "ts": 9, "data": {"id": "1"}})
    assert [r.asDict() for r in routing.route_facts(data, live).collect()] == [
        {"sink_table": "x", "data": {"id": "1", "v": "2", "ts": "9"}, "ts": 9}]


COMMON = {"mid": "m", "uid": "u", "is_new": "0"}


def client(spark, *records):
    return changelog.parse_json(lines(spark, *records), schemas.CLIENT_LOG, "drop")


def test_log_split_rules(spark):
    page = {"common": COMMON, "page": {"page_id": "home"}, "ts": 5}
    df = client(spark, {**page, "err": {"code": "1"}, "displays": [{"i": "1"}, {"i": "2"}], "actions": []},
                {"common": COMMON, "start": {"entry": "icon"}, "err": {"code": "2"}, "ts": 6,
                 "displays": [{"i": "3"}]}, page)
    out = logsplit.split_log(df)
    assert {k: v.count() for k, v in out.items()} == {
        "err": 2, "start": 1, "display": 2, "action": 0, "page": 2}
    assert "ts" not in out["action"].columns and "err" not in out["page"].columns
    sent = {}
    for r in logsplit.split_log_json(df).collect():
        sent.setdefault(r.topic, []).append(json.loads(r.value))
    assert {k: len(v) for k, v in sent.items()} == {"err": 2, "start": 1, "display": 2, "page": 2}
    assert {**page, "actions": []} in sent["page"] and page in sent["page"]
    assert "err" not in sent["start"][0] and "displays" in sent["start"][0]


def test_visit_measures(spark):
    df = client(spark, {"common": COMMON, "page": {"during_time": "x"}, "ts": 1},
                {"common": COMMON, "page": {"last_page_id": "", "during_time": 7}, "ts": 1},
                {"common": COMMON, "page": {"last_page_id": "a", "during_time": "8"}, "ts": 1})
    assert rows(traffic.visits(df).select("sv", "dur")) == [(0, 8), (1, 7), (1, None)]


def test_words(spark):
    df = spark.createDataFrame([("红色连衣裙夏季新款5G外套 Hello, WORLD",), (None,)], "t string")
    assert df.select(text.words("t")).collect()[0][0] == [
        *"红色连衣裙夏季新款", "5g", "外", "套", "hello", "world"]
    known = ["红色", "连衣", "连衣裙", "夏季", "新款", "外套"]
    assert df.select(text.dictionary_words(F.col("t"), known)).collect()[0][0] == [
        "红色", "连衣裙", "夏季", "新款", "5g", "外套", "hello", "world"]
    text.register_words(spark)
    assert spark.sql("SELECT word FROM segment_words('a b')").count() == 2


def test_times_follow_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        row = spark.range(1).select(
            timefmt.text_to_millis(F.lit("2025-03-08 23:15:05")).alias("ms"),
            timefmt.millis_to_datetime(F.lit(1_741_446_905_000)).alias("text"),
            timefmt.date_to_millis(F.lit("2025-03-08")).alias("midnight")).collect()[0]
        assert (row.ms, row.text, row.midnight) == (
            1_741_446_905_000, "2025-03-08 23:15:05", 1_741_363_200_000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_names_and_json(spark):
    df = spark.createDataFrame([("1", None)], "order_detail_id string, sku_name string")
    assert fields.camel_columns(df).columns == ["orderDetailId", "skuName"]
    assert df.select(fields.json_record(*df.columns)).collect()[0][0] == '{"order_detail_id":"1"}'
    assert df.select(fields.pair_key(F.lit("a"), F.lit("b"))).collect()[0][0] == "a:b"


def test_trie_against_regular_expressions():
    """Leftmost-longest cuts; signs of several planes, words that begin other words, line ends."""
    rnd = random.Random(1)
    for _ in range(200):
        listed = {"".join(rnd.choice("ab中文😀") for _ in range(rnd.randrange(1, 5))) for _ in range(rnd.randrange(8))}
        line = "".join(rnd.choice("ab中文😀\nc") for _ in range(rnd.randrange(40)))
        pattern = "|".join(sorted(map(re.escape, listed), key=lambda w: -len(w)))
        assert list(text.WordTrie(listed).cut(line)) == ([m.span() for m in re.finditer(pattern, line)] if listed else [])


def test_words_everywhere(spark):
    df = spark.createDataFrame([("Undergrowth 研究生命 x", ), (None,), ("",)], "t string")
    cut = text.dictionary_words(F.col("t"), ["grow", "under", "und", "研究", "研究生", "命"], everywhere=True)
    assert [r[0] for r in df.select(cut).collect()] == [["under", "grow", "th", "研究生", "命", "x"], None, []]


def test_word_lists_are_bounded(spark):
    words = spark.createDataFrame([("Aa",), ("aa",), ("",), (None,), ("b",)], "w string")
    assert text.word_list(words) == ["aa", "b"]
    with pytest.raises(ValueError):
        text.word_list(words, limit=2)
