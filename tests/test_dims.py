"""Dimension folding against a plain-Python store."""

import random

from conftest import rows
from pyspark.sql import functions as F

from rillmart.operators import dims, routing
from rillmart.sources import sinks

SHAPE = "sink_table string, row_key string, op string, data map<string,string>, ts bigint"


def history(seed, n=400):
    rnd = random.Random(seed)
    out = []
    for ts in range(1, n + 1):
        key = "hot" if rnd.random() < 0.34 else f"k{rnd.randrange(30)}"
        data = {c: rnd.choice([None, "", f"{c}{ts}"]) for c in "abc" if rnd.random() < 0.7}
        op = rnd.choice(["insert", "update", "bootstrap-insert", "delete"])
        out.append((rnd.choice(["dim_x", "dim_y"]), key, op, data, ts))
    return out


def model(events, reset=None):
    store = {}
    for table, key, op, data, ts in events:
        if reset and table == reset[0] and ts * 1000 <= reset[1]:
            continue
        if op == "delete":
            store.pop((table, key), None)
            continue
        written = {c: v for c, v in data.items() if v}
        if written:
            store.setdefault((table, key), {}).update(written)
    return sorted((t, k, sorted(d.items())) for (t, k), d in store.items())


def shown(df):
    return sorted((r.sink_table, r.row_key, sorted(r.data.items())) for r in df.collect())


def test_fold_equals_store(spark):
    for seed in (1, 2):
        events = history(seed)
        df = spark.createDataFrame(events, SHAPE).repartition(7)
        assert shown(dims.fold_dims(df, ["ts"])) == model(events)


def test_changes_of_one_second_go_by_arrival(spark):
    shape = SHAPE + ", offset bigint"
    events = [("d", "k", "insert", {"name": "zzz", "x": "1"}, 5, 1), ("d", "k", "update", {"name": "aaa"}, 5, 2),
              ("d", "j", "insert", {"name": "old", "x": "1"}, 5, 3), ("d", "j", "delete", {"name": "old"}, 5, 4),
              ("d", "j", "insert", {"name": "new"}, 5, 5)]
    out = dims.fold_dims(spark.createDataFrame(events, shape).repartition(5), ["ts", "offset"])
    assert shown(out) == [("d", "j", [("name", "new")]), ("d", "k", [("name", "aaa"), ("x", "1")])]


def test_reset_empties_one_dimension(spark):
    events = history(3)
    changes = spark.createDataFrame([("r", "dim_x", 1), ("u", "dim_x", 200_000), ("c", "dim_y", 9)],
                                    "op string, sink_table string, ts_ms bigint")
    out = dims.fold_dims(spark.createDataFrame(events, SHAPE), ["ts"], resets=routing.dim_resets(changes))
    assert shown(out) == model(events, ("dim_x", 200_000))


def test_batches_fold_like_one(spark, tmp_path):
    """Micro-batches, one of them written twice, then a compaction."""
    events = history(4)
    write = sinks.store_dims(str(tmp_path / "dims"), ["ts"])
    for n in range(4):
        batch = spark.createDataFrame(events[n * 100:(n + 1) * 100], SHAPE)
        write(batch, n)
        if n == 2:
            write(batch, n)
    stored = sinks.read_dims(spark, str(tmp_path / "dims"))
    assert shown(stored) == model(events)
    sinks.compact_dims(spark, str(tmp_path / "dims"), str(tmp_path / "small"))
    assert shown(sinks.read_dims(spark, str(tmp_path / "small"))) == model(events)
    only = sinks.read_dims(spark, str(tmp_path / "dims"), name="dim_x")
    assert shown(only) == [r for r in model(events) if r[0] == "dim_x"]
    assert dims.dim_table(only, "dim_x", ["a"]).columns == ["row_key", "a"]


def test_upserts(spark, tmp_path):
    where = str(tmp_path / "up")
    write = sinks.upsert(where, ["id"], ["ts"])
    shape = "id string, ts bigint, v string"
    write(spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x")], shape), 0)
    write(spark.createDataFrame([("a", 3, None), ("c", 1, "z")], shape), 1)
    live = sinks.read_upserted(spark, where, ["id"], ["ts"], deleted=F.col("v").isNull())
    assert rows(live) == [("b", 1, "x"), ("c", 1, "z")]
    sinks.compact_upserted(spark, where, str(tmp_path / "up2"), ["id"], ["ts"])
    assert sinks.read_upserted(spark, str(tmp_path / "up2"), ["id"], ["ts"]).count() == 3


def test_upserts_carry_any_type(spark, tmp_path):
    shape = "id string, ts bigint, data map<string,string>"
    sinks.upsert(str(tmp_path / "m"), ["id"], ["ts"])(spark.createDataFrame([("a", 1, {"x": "1"}), ("a", 2, {"y": "2"})], shape), 0)
    assert [r.data for r in sinks.read_upserted(spark, str(tmp_path / "m"), ["id"], ["ts"]).collect()] == [{"y": "2"}]


def test_missing_hop_gives_nulls_behind_it(spark):
    def dim(data, cols):
        return spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols))
    wide = dims.flatten_products(
        dim([("1", "s", "p", "t", "c3"), ("2", "s", "p", "t", "none")],
            ["id", "sku_name", "spu_id", "tm_id", "category3_id"]),
        dim([("p", "spu")], ["id", "spu_name"]), dim([("t", "tm")], ["id", "tm_name"]),
        dim([("c3", "C3", "c2")], ["id", "name", "category2_id"]),
        dim([("c2", "C2", "c1")], ["id", "name", "category1_id"]), dim([("c1", "C1")], ["id", "name"]))
    got = {r.sku_id: (r.trademark_name, r.category3_name, r.category1_name) for r in wide.collect()}
    assert got == {"1": ("tm", "C3", "C1"), "2": ("tm", None, None)}
