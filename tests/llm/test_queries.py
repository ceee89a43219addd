"""The registered queries against SQL, and the pipeline against its operators' decisions."""

import duckdb
import pytest

import __spark_entry__ as entry
import checks
import corpus_pipeline
from rillmart.llm import queries, toxicity
from tests.llm import test_bytebpe, test_decontam, test_simhash

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(got) == docs or name in ("op10_chat_format", "op12_hard_negatives")
    if name not in queries.ORACLE_SQL:
        return
    con = duckdb.connect()
    for t in checks.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert checks.rows_of(df.columns, got) == checks.rows_of(columns, cur.fetchall())


def test_pipeline(spark):
    """Each stage against a brute-force version on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))

    def clean(rows):
        return {i for i, t in rows if toxicity.margin_of((t or "").encode(), model) < 0}

    def last_of_equals(rows):
        return set({"".join(c.lower() if c.isascii() else c for c in t): i for i, t in sorted(rows)}.values())

    def first_of_linked(rows):
        return set(test_simhash.brute([(i, test_simhash.plain(t)) for i, t in rows]))

    def uncontaminated(rows):
        found = {i: test_decontam.brute(t, items) for i, t in rows}
        return {i for i, (n, hit, _) in found.items() if not hit or 20 * hit < n}

    wanted = [clean, last_of_equals, first_of_linked, uncontaminated]
    for (name, stage), brute in zip(corpus_pipeline.STAGES[:-1], wanted):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        assert {r.doc_id for r in docs.collect()} == brute(rows), name
    left = {r.doc_id: r.text for r in docs.collect()}
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} == set(left) and all(r.round_trip for r in out)
    for r in out:
        assert list(r.token_ids) == test_bytebpe.LIBRARY.encode_ordinary(left[r.doc_id])
