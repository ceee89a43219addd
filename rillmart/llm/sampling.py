"""Bounded samples of labelled and unlabelled texts, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fold(id_column: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds


def first_ids(ids: DataFrame, limit: int) -> DataFrame:
    """``limit`` ids at most, by a hash of the id, so that the choice does not follow the order of
    the table.  Partial: each task sends its own first ones only."""
    return ids.where("id IS NOT NULL").distinct().orderBy(F.xxhash64("id"), "id").limit(limit)


def labelled_ids(labels: DataFrame, id_col: str, label_col: str, wanted: Column) -> DataFrame:
    """(id, label) of the ids that have one label, 0 or 1; ids whose rows disagree are left out."""
    rows = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"))
    return rows.where(wanted & F.col("label").isin(0, 1)).groupBy("id").agg(
        F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").select("id", "label")


def texts_by_id(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One text of each sampled id.  ``ids`` is a bounded sample, so it is broadcast."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.join(F.broadcast(ids), "id").groupBy(*ids.columns).agg(F.max("text").alias("text"))
