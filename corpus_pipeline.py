"""A pipeline over ``documents``: filter, deduplicate, decontaminate, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and
read again as the next stage's docs.  All stages but the last return the columns of documents,
whatever else ``docs`` holds, and keep rows as they are.  Null texts count as empty; ids may be null
or repeat; an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rillmart.llm import bytebpe, decontam, exact, simhash, toxicity
from rillmart.llm.common import prepare, stored, table

RANKS = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learner does not call toxic."""
    prepare(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z in lower case) the one with the largest id."""
    prepare(spark)
    return exact.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked SimHash fingerprints the one with the least id."""
    prepare(spark)
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a benchmark window."""
    prepare(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its bytes.

    Needs the columns of documents and ignores others.  A null or empty text has no ids.
    """
    prepare(spark)
    path = public_tokenizers.path(RANKS)
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars")
    coded = bytebpe.encode_decode(rows, path)
    exact_bytes = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", "n_chars", "token_ids",
                        F.size("token_ids").cast("long").alias("n_tokens"), exact_bytes.alias("round_trip"))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("simhash_near_dedup", drop_near_copies),
          ("decontamination", drop_contaminated), ("byte_bpe", encode)]
# No SQL: the learner, the fingerprints and the encoding are outside it.  Tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
