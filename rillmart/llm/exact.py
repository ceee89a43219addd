"""Exact duplicates by distributed most-significant-digit radix partitioning.

The first digit is a text's length and its first block, each later digit the bytes of the next
block, eight times as wide as the one before (up to ``MAX_WIDTH`` characters).  A round splits every
group by its digit: a partial aggregate counts (group, digit), so a group that holds a third of all
rows is one row per map task, and a join tells each row its new group; both sides of that join are
fresh shuffles, which lets Spark slice a hot group.  A group of one row is done, and so is a group
whose texts have ended.  Only the others go on, so a text is read as far as it agrees with another.
Equality is decided by the bytes alone.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, functions as F

from rillmart.operators.joins import attach_marks

from .common import ascii_lower, discard, free, free_name, new_names, stored

FIRST_WIDTH, GROWTH, MAX_WIDTH = 32, 8, 1 << 20


def _digit(text: Column, at: int, width: int) -> Column:
    return ascii_lower(F.substring(text, at + 1, width)).cast("binary")


def _split(rows: DataFrame, text: Column, at: int, width: int, *measures: Column) -> DataFrame:
    """Rows with the size of their digit's group and what else is measured of it."""
    keyed = rows.withColumn("_digit", _digit(text, at, width))
    groups = keyed.groupBy("_group", "_digit").agg(F.count("*").alias("_size"), *measures)
    return attach_marks(keyed, groups, ["_group", "_digit"]).drop("_group", "_digit")


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     first_width: int = FIRST_WIDTH) -> DataFrame:
    """Every row of ``docs`` with ``keep_id``, ``group_size`` and ``kept``.

    Texts are equal when identical after lower-casing A-Z.  Null counts as empty.  Of equal texts
    the row with the largest id is kept; of rows that tie there exactly one.  A null id is less
    than any other.  All columns of ``docs`` stay; a new column whose name is taken gets
    underscores in front.  An empty table gives an empty table.
    """
    own = [f"c{k}" for k in range(len(docs.columns))]
    key = own[docs.columns.index(id_col)]
    text = F.coalesce(F.col(own[docs.columns.index(text_col)]), F.lit(""))
    keep = F.max(key).alias("_keep")
    rows = docs.toDF(*own).withColumns({
        "_chars": F.char_length(text), "_group": F.char_length(text).cast("long")})
    # The first round only takes single rows out.  The others start again with a wider digit, now
    # that each has a number that stays, as the written table has it.
    number = F.monotonically_increasing_id()
    level = stored(_split(rows, text, 0, first_width, keep).withColumns({
        "_row": number, "_ended": F.col("_size") == 1}).withColumn("_into", F.col("_row")), "radix", by="_ended")
    done, live = [level.where("_ended")], level.where("NOT _ended")
    rows = live.select(*own, "_row", "_chars", F.col("_chars").cast("long").alias("_group"))
    at, width = 0, first_width * GROWTH
    name = F.coalesce(F.max_by("_row", key), F.max("_row")).alias("_into")
    while not live.isEmpty():
        ended = (F.col("_size") == 1) | (F.col("_chars") <= at + width)
        before, level = level, stored(
            _split(rows, text, at, width, keep, name).withColumn("_ended", ended), "radix", by="_ended")
        discard(before, "_ended=false")
        done.append(level.where("_ended"))
        live = level.where("NOT _ended")
        rows = live.select(*own, "_row", "_chars", F.col("_into").alias("_group"))
        at, width = at + width, min(width * GROWTH, MAX_WIDTH)
    free(docs.sparkSession)
    new = {"keep_id": F.col("_keep"), "group_size": F.col("_size"),
           "kept": F.col("_row") == F.col("_into")}
    return functools.reduce(DataFrame.unionByName, done).select(
        *own, *new.values()).toDF(*docs.columns, *new_names(docs, *new))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of equal texts, with its columns.

    Null counts as empty, so one null or empty text stays.  Ids may be null or repeat; columns may
    have the operator's names.  An empty table gives none.
    """
    kept = free_name(docs.columns, "kept")
    return duplicate_groups(docs, id_col, text_col).where(F.col(f"`{kept}`")).select(
        *[F.col(f"`{c}`") for c in docs.columns])
