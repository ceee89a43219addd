"""Registered queries against their SQL twins on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as entry
import checks

SF = "/root/testdata/sf0.001"
# Streams take seconds each; ``checks.py`` runs them all.
STREAMS = {"stream_page_view", "stream_order_detail", "stream_province_order", "stream_log_split_late",
           "stream_dim_sync", "stream_route_fact"}
NAMES = [n for n in entry.queries() if not n.startswith("stream") or n in STREAMS]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in checks.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    assert got
    if name not in entry.oracle_sql():
        return
    cur = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert checks.rows_of(df.columns, got) == checks.rows_of(cols, cur.fetchall())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
