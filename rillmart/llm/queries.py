"""The registered queries of this package, with their SQL twins where SQL can express them."""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

import public_tokenizers

from . import bytebpe, chat, covertree, decontam, exact, merkle, oracle, phrases, pii, quality, simhash, suffix, tokenfile, toxicity
from .sampling import fold
from .common import shared_dir, table, temporary, texts_of


def _lower_digests(batches):
    for batch in batches:
        lowered = pc.ascii_lower(batch.column("text").cast(pa.string()))
        digest = [hashlib.sha256(t).hexdigest() for t in texts_of(lowered)]
        rest = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + [pa.array(digest, pa.string())],
                                         rest + ["text_sha256"])


def op1_exact_dedup(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact.duplicate_groups(docs).mapInArrow(
        _lower_digests, "doc_id long, keep_id long, group_size long, kept boolean, text_sha256 string")


def op2_decontaminate(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontam.mark(docs, table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontam.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def op3_phrase_dedup(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return phrases.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


RANKS = "byte_bpe_multi_50k.tiktoken"


def op4_byte_bpe(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path(RANKS)
    return bytebpe.encode_decode(docs, path).select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_simhash(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    prints = simhash.fingerprints(docs).select("doc_id", "simhash")
    return simhash.near_duplicates(prints).select(
        "doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


TOKENIZER = "word_bpe_49k.json"


def _id_digests(batches):
    for batch in batches:
        crc = [zlib.crc32(i) for i in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays(batch.columns[:3] + [pa.array(crc, pa.int64())],
                                         ["doc_id", "start", "n_tokens", "ids_crc32"])


def op7_token_files(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = temporary(spark, shared_dir(spark, "token-files"))
    tokenfile.write_tokens(docs, public_tokenizers.path(TOKENIZER), path)
    return tokenfile.read_tokens(spark, path).mapInArrow(
        _id_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _scored(spark, sf_dir, module) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = module.train(docs, table(spark, sf_dir, "labels"))
    held_out = (fold(F.col("doc_id"), module.FOLDS) == module.HELD_OUT).alias("held_out")
    return module.score(docs, model).select("doc_id", held_out, "score", "predicted")


def op5_quality(spark, sf_dir) -> DataFrame:
    return _scored(spark, sf_dir, quality)


def op8_toxicity(spark, sf_dir) -> DataFrame:
    return _scored(spark, sf_dir, toxicity)


def op9_personal_data(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.personal_data(docs)
    kinds = F.transform("pii", lambda s: s.kind)
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}")
              for k in pii.KINDS]
    base = pii.span_list(F.filter("pii", lambda s: s.base))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"),
                        pii.span_list(F.col("pii")).alias("spans"))


EXTRA_TURN = "\\### Assistant: </turn> ok"


def op10_chat_format(spark, sf_dir) -> DataFrame:
    """A conversation whose texts look like marks goes through the same template."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(EXTRA_TURN).alias("text"))
    out = chat.render(chat.fold(chat.log_of_turns(turns.unionByName(extra))))
    read = out.select("conv_id", "n_turns", "formatted", chat.parse(F.col("formatted")).alias("turns"),
                      chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    said = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def op11_merkle(spark, sf_dir) -> DataFrame:
    """Every row's proof, checked against its row with ``n_chars`` changed in one row of seven."""
    docs = table(spark, sf_dir, "documents")
    changed = F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 7) == 0)
    forged = merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text"))
    made = merkle.manifest(docs, carry={"forged": F.when(changed, forged)})
    folded = made.withColumn("folded_root", merkle.fold(
        F.coalesce("forged", "leaf"), F.col("sides"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_hard_negatives(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return covertree.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_suffix_dedup(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


QUERIES = {"op1_exact_dedup": op1_exact_dedup, "op2_decontaminate": op2_decontaminate,
           "op3_phrase_dedup": op3_phrase_dedup, "op4_byte_bpe": op4_byte_bpe, "op5_quality": op5_quality, "op6_simhash": op6_simhash,
           "op7_token_files": op7_token_files, "op8_toxicity": op8_toxicity,
           "op9_personal_data": op9_personal_data, "op10_chat_format": op10_chat_format,
           "op11_merkle": op11_merkle, "op12_hard_negatives": op12_hard_negatives,
           "op13_suffix_dedup": op13_suffix_dedup}
ORACLE_SQL = {"op1_exact_dedup": oracle.EXACT, "op2_decontaminate": oracle.DECONTAMINATE,
              "op3_phrase_dedup": oracle.PHRASES,
              "op10_chat_format": oracle.CHAT, "op11_merkle": oracle.MERKLE,
              "op12_hard_negatives": oracle.HARD_NEGATIVES}
