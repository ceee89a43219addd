"""Rows of the registered queries that have no SQL, and pipeline stages on odd tables, by brute force."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from rillmart.llm import pii
from rillmart.llm.queries import QUERIES
from tests.llm import test_bytebpe, test_pii, test_simhash
from tests.llm.helpers import ODD

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows_of(spark, name):
    return {r.doc_id: r for r in QUERIES[name](spark, SF).collect()}


def test_op4(spark, texts):
    got = rows_of(spark, "op4_byte_bpe")
    for i, text in texts.items():
        ids = test_bytebpe.LIBRARY.encode_ordinary(text)
        assert tuple(got[i]) == (i, len(ids), sha(",".join(map(str, ids))), sha(text))


def test_op6(spark, texts):
    got = rows_of(spark, "op6_simhash")
    prints = [(i, test_simhash.plain(t)) for i, t in texts.items()]
    for (i, value), component in zip(prints, test_simhash.brute(prints)):
        assert tuple(got[i]) == (i, f"{value:016x}", component)


def test_op7(spark, texts):
    library, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    got = rows_of(spark, "op7_token_files")
    for i, text in sorted(texts.items()):
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [1], "<u4")
        assert tuple(got[i]) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_op9(spark, texts):
    got = rows_of(spark, "op9_personal_data")
    for i, text in texts.items():
        base = [f"{k}:{a}:{b}" for k in pii.KINDS for a, b in test_pii.brute(k, text)]
        spans = got[i].spans.split(",") if got[i].spans else []
        assert got[i].base_sha256 == sha(",".join(base)) and set(base) <= set(spans)
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(s.startswith(k + ":") for s in spans) for k in pii.KINDS]


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("rows", [ODD, []], ids=["odd", "empty"])
def test_stages(spark, rows):
    """Null and repeated ids, empty and very long texts, copies, no rows; columns that operators add by name."""
    table = [(i, t, None, "s", len(t or ""), "x", "y") for i, t in rows]
    docs = spark.createDataFrame(table, COLUMNS + ", kept string, score string").repartition(3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        left, given = out.collect(), [tuple(r) for r in docs.collect()]
        assert all(tuple(r) in given for r in left), name
        if name == "exact_dedup":
            assert len(left) == len({lowered(t) for _, t in rows})
    out = corpus_pipeline.encode(spark, docs, SF).collect()
    assert len(out) == len(rows) and all(r.round_trip for r in out)
