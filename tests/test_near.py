"""Sums of moments that are reduced where their rows lie."""

import random

from conftest import rows

from rillmart.plans import trade

T = 1_704_067_200


def test_near_rows_are_reduced_where_they_lie(spark):
    """Sums do not depend on ``near``, ids in several places and null ids included; rows that were joined by it
    are shuffled once less."""
    rng = random.Random(8)
    made = [(rng.choice([None, "a", "b", "c"]), rng.randrange(3), rng.choice(["s", "t"]), *[rng.choice([None, "x", "1.5", "2"])] * 4,
             T + rng.randrange(40), rng.choice([None, "1", "2"])) for _ in range(300)]
    made += [(i, 3 - place, *rest) for i, place, *rest in made[:100]]
    detail = spark.createDataFrame(made, "id string, place bigint, sku_id string, " + ", ".join(
        f"{c} string" for c in trade.SKU_MEASURES.values()) + ", ts bigint, tie string")
    for ttl in (10, None):
        want, got = [trade.sku_windows(detail, "10 seconds", ["tie"], ttl, near=near) for near in ((), ["place"])]
        assert rows(got) == rows(want)
    joined = detail.repartition(4, "place")
    plans = [trade.sku_windows(joined, "10 seconds", ["tie"], 10, near=near)._jdf.queryExecution().executedPlan().toString()
             for near in ((), ["place"])]
    assert plans[0].count("Exchange ") == plans[1].count("Exchange ") + 1
