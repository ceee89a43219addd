"""Shapes of physical plans that matter at scale."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
BATCH = [n for n in entry.queries() if not n.startswith("stream")]


def plan(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_global_window(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "SinglePartition" not in text
    assert "PythonUDF" not in text and "BatchEvalPython" not in text


def test_scan_reads_only_what_it_needs(spark):
    text = plan(spark, "join_inner")
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text
    assert "struct<c_custkey:bigint,c_name:string>" in text


def test_filters_reach_the_scan(spark):
    assert "EqualTo(o_orderstatus,O)" in plan(spark, "changes_to_value")


def test_partial_aggregation_before_every_shuffle_of_a_summary(spark):
    for name in ("page_view_w10", "home_detail_uv_w1h", "cart_add_uu_w1h", "keyword_pv"):
        lines = [l for l in plan(spark, name).splitlines() if l.strip()]
        for above, below in zip(lines, lines[1:]):
            if "Exchange hashpartitioning" in above:
                assert "Aggregate" in below or "InputAdapter" in below or "Sort" in below, above
