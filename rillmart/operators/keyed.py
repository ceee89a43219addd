"""Batch forms of the keyed-state operators.

Each of them could be written as one analytic window per key, which would put a
hot key into one task.  None is: rows are reduced by (key, day), (key, second) or key
before they are shuffled, and a key is cut along time where order matters, so that a
key with a third of all rows still spreads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rillmart.functions.timefmt import DATE, DAY_MS, millis_to_date
from rillmart.operators.joins import attach_marks

RETURN_AFTER_DAYS = 8


def first_per_day(df: DataFrame, keys: Sequence[str], carry: Sequence[str] = (),
                  ts: str = "ts") -> DataFrame:
    """The first row of each (key, day): key, day, ts and the ``carry`` columns.

    ``ts`` is in epoch milliseconds.  Rows of one key with the same ts are
    ordered by their carry columns, which makes the choice repeatable.

    The first aggregate keeps only numbers in its buffer and so runs as a hash
    aggregate before the shuffle; what is left for the second is one row per
    (key, day, carried values).
    """
    day = millis_to_date(F.col(ts))
    least = df.groupBy(*keys, day.alias("day"), *carry).agg(F.min(ts).alias(ts))
    if not carry:
        return least
    first = F.min(F.struct(ts, *carry)).alias("_f")
    return least.groupBy(*keys, "day").agg(first).select(*keys, "day", "_f.*")


def login_days(df: DataFrame, user: str = "uid", ts: str = "ts") -> DataFrame:
    """One row per (user, day) with uu_ct = 1 and back_ct = 1 when the login day
    before lies eight or more days back."""
    days = first_per_day(df, [user], ts=ts)
    # At most one row per user and calendar day reaches this window.
    before = F.lag("day").over(Window.partitionBy(user).orderBy("day"))
    gap = F.date_diff(F.to_date("day", DATE), F.to_date(before, DATE))
    return days.select(user, ts, F.lit(1).alias("uu_ct"),
                       F.when(gap >= RETURN_AFTER_DAYS, 1).otherwise(0).alias("back_ct"))


def first_days(df: DataFrame, device: Column, is_new: Column, ts: Column) -> DataFrame:
    """(_mid, _first_day, _from) of each device, ``_from`` being its first row's time.  A device whose
    first row is not flagged new was known before, so its first day counts as the day before that row.

    Rows with the same ts and device are ordered with the flag '1' last.
    """
    flagged = F.coalesce(is_new, F.lit("")) == "1"
    seen = df.select(device.alias("_mid"), flagged.alias("_new"), ts.alias("_ts"))
    return (seen.where(F.col("_mid").isNotNull())
              .groupBy("_mid", "_new").agg(F.min("_ts").alias("_ts"))
              .groupBy("_mid").agg(F.min(F.struct("_ts", "_new")).alias("_f"))
              .select("_mid", millis_to_date(
                  F.when(F.col("_f._new"), F.col("_f._ts"))
                  .otherwise(F.col("_f._ts") - DAY_MS)).alias("_first_day"), F.col("_f._ts").alias("_from")))


def repair_new_visitors(df: DataFrame, device: Column, is_new: Column, ts: Column,
                        firsts: DataFrame | None = None) -> DataFrame:
    """Add ``is_new_fixed``: the flag '1' becomes '0' on every day but the device's first.
    ``firsts`` gives the first days where they are known from elsewhere.  Rows without a device
    keep their flag."""
    flagged = F.coalesce(is_new, F.lit("")) == "1"
    firsts = first_days(df, device, is_new, ts) if firsts is None else firsts
    joined = attach_marks(df.withColumn("_mid", device), firsts.select("_mid", "_first_day"), ["_mid"], "left")
    stale = flagged & (F.col("_first_day") != millis_to_date(ts))
    return joined.withColumn("is_new_fixed", F.when(stale, "0").otherwise(is_new)) \
        .drop("_mid", "_first_day")


def repair_by_terms(df: DataFrame, device: Column, is_new: Column, ts: Column, terms: DataFrame) -> DataFrame:
    """``repair_new_visitors`` with first days that hold for a time: ``terms`` are (_mid, _first_day,
    _from, _until), and each row of a device lies in just one of the device's."""
    flagged = F.coalesce(is_new, F.lit("")) == "1"
    inside = (F.col("_mid") == F.col("_of")) & ts.between(F.col("_from"), F.col("_until"))
    joined = df.withColumn("_mid", device).join(terms.withColumnRenamed("_mid", "_of"), inside, "left")
    stale = flagged & (F.col("_first_day") != millis_to_date(ts))
    return joined.withColumn("is_new_fixed", F.when(stale, "0").otherwise(is_new)) \
        .drop("_mid", "_of", "_first_day", "_from", "_until")


def flag_first_of_day(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                      flag: str = "uv_ct", ts: str = "ts") -> DataFrame:
    """Keep every row; ``flag`` is 1 on the first row of its key and day (``ts`` in
    milliseconds, then ``order``, which must tell rows of one moment apart)."""
    day = millis_to_date(F.col(ts))
    rank = F.struct(ts, *order)
    firsts = df.groupBy(*keys, day.alias("_day")).agg(F.min(rank).alias("_first"))
    rows = df.withColumn("_day", day)
    return (attach_marks(rows, firsts, [*keys, "_day"], "left")
            .withColumn(flag, F.when(rank.eqNullSafe(F.col("_first")), 1).otherwise(0))
            .select(*df.columns, flag))


def moment_lasts(df: DataFrame, key: str, order: Sequence[str], ttl: int | None,
                 carry: Sequence[str] = (), ts: str = "ts",
                 slice_seconds: int = 600, near: Sequence[str] = ()) -> DataFrame:
    """The last row of each (key, second), with ``kept``: no later second of the key
    follows within ``ttl`` seconds (``ttl=None``: no later second at all), and ``alone``: no row
    of the second differs from it in ``order``.

    Rows of one second are reduced to one before the shuffle, so copies of a record
    cost nothing.  Then a key is cut into slices of time; the first seconds of a slice
    are shown to the slice before as well, which makes each slice complete on its own.
    A window group therefore holds at most ``slice_seconds + ttl + 1`` rows.

    ``near`` names columns by which ``df`` already lies together and of which a key has one value.  Moments
    are then found where the rows are, without a shuffle.
    """
    rest = [c for c in carry if c not in (key, ts, *order)]
    rank = F.struct(*order)
    moments = df.groupBy(key, ts, *near).agg(
        F.max(F.struct(*order, *rest)).alias("_last"), (F.min(rank) == F.max(rank)).alias("alone"))
    if ttl is None:
        moments = moments.drop(*near)
        newest = moments.groupBy(key).agg(F.max(ts).alias("_newest"))
        return attach_marks(moments, newest, [key]).withColumn("kept", F.col(ts) == F.col("_newest")) \
            .drop("_newest")
    width = max(slice_seconds, ttl + 1)
    into = F.pmod(F.col(ts), F.lit(width))
    home = F.col(ts) - into
    shown = F.when(into <= ttl, F.array(home, home - width)).otherwise(F.array(home))
    spread = moments.withColumn("_slice", F.explode(shown))
    following = F.lead(ts).over(Window.partitionBy(*near, key, "_slice").orderBy(ts))
    return (spread.withColumn("_next", following).where(F.col("_slice") == home)
            .withColumn("kept", F.coalesce(F.col("_next") - F.col(ts) > ttl, F.lit(True)))
            .drop("_slice", "_next", *near))


def marked_moments(df: DataFrame, key: str, by: Sequence[str], order: Sequence[str], ttl: int | None,
                   measures: dict[str, Column], ts: str = "ts", slice_seconds: int = 600,
                   near: Sequence[str] = ()) -> DataFrame:
    """One row per (key, second, values of ``by``): ``by``, ts, and of its last row the measures if
    no later row of the key follows within ``ttl`` seconds, zeros if one does.

    A measure is null where no row of the second had it.  One pass over ``df``; slices of time are
    cut as in ``moment_lasts``, so a window group is bounded by what one key sends in them.

    ``near`` names columns by which ``df`` already lies together.  With a ``ttl``, moments are then reduced
    where they are instead of being shuffled for it; one that lies in several places comes out as several
    rows with the same sums, of which at most one is kept.
    """
    last = F.max(F.struct(*order, *[c.alias(f"_{m}") for m, c in measures.items()])).alias("_last")
    had = [F.max(c.isNotNull()).alias(f"_had_{m}") for m, c in measures.items()]
    places = () if ttl is None else near
    moments = df.groupBy(key, ts, *by, *places).agg(last, *had).drop(*places)
    rank = F.struct(F.col(ts), F.col("_last"), *by)
    if ttl is None:
        newest = moments.groupBy(key).agg(F.max(rank).alias("_newest"))
        marked = attach_marks(moments, newest, [key]).withColumn("kept", rank.eqNullSafe(F.col("_newest")))
    else:
        width = max(slice_seconds, ttl + 1)
        into = F.pmod(F.col(ts), F.lit(width))
        home = F.col(ts) - into
        shown = F.when(into <= ttl, F.array(home, home - width)).otherwise(F.array(home))
        spread = moments.withColumn("_slice", F.explode(shown))
        following = F.lead(ts).over(Window.partitionBy(key, "_slice").orderBy(ts, "_last", *by))
        marked = spread.withColumn("_next", following).where(F.col("_slice") == home).withColumn(
            "kept", F.coalesce(F.col("_next") - F.col(ts) > ttl, F.lit(True)))
    zero = {m: F.when(F.col(f"_had_{m}"), F.lit(0)) for m in measures}
    return marked.select(*by, ts, *[
        F.when(F.col("kept"), F.coalesce(F.col("_last")[f"_{m}"], zero[m])).otherwise(zero[m]).cast("decimal(20,4)").alias(m)
        for m in measures])


def moment_changes(df: DataFrame, key: str, by: Sequence[str], order: Sequence[str], ttl: int,
                   measures: dict[str, Column], ts: str = "ts", slice_seconds: int = 600) -> DataFrame:
    """``marked_moments`` of the rows with ``_now`` and of those with ``_was``, in one pass: ``by``, ts, a struct
    ``now`` and a struct ``was`` of the measures, null where the moment does not exist.

    A row is in one of three kinds (both, added, dropped), and a moment holds the last row of each, so
    that a row's values are shuffled once.
    """
    now, was = F.col("_now"), F.col("_was")
    kinds = {"both": now & was, "added": now & ~was, "dropped": ~now & was}
    last = F.struct(*order, *[c.alias(f"_{m}") for m, c in measures.items()])
    had = F.struct(*[c.isNotNull().alias(m) for m, c in measures.items()])
    moments = df.groupBy(key, ts, *by).agg(
        *[F.max(F.when(when, last)).alias(f"_{k}") for k, when in kinds.items()],
        *[F.max(F.when(when, had[m])).alias(f"_{k}_{m}") for k, when in kinds.items() for m in measures])
    width = max(slice_seconds, ttl + 1)
    into = F.pmod(F.col(ts), F.lit(width))
    home = F.col(ts) - into
    shown = F.when(into <= ttl, F.array(home, home - width)).otherwise(F.array(home))
    marked = moments.withColumn("_slice", F.explode(shown)).withColumns(
        {"_last_now": F.greatest("_both", "_added"), "_last_was": F.greatest("_both", "_dropped")})
    for side in ("now", "was"):
        there = F.col(f"_last_{side}").isNotNull()
        following = F.lead(F.when(there, F.col(ts))).over(
            Window.partitionBy(key, "_slice").orderBy(~there, ts, f"_last_{side}", *by))
        marked = marked.withColumn(f"_next_{side}", following)
    marked = marked.where(F.col("_slice") == home)

    def values(side: str, kind: str) -> Column:
        kept = F.coalesce(F.col(f"_next_{side}") - F.col(ts) > ttl, F.lit(True))
        rest = []
        for m in measures:
            zero = F.when(F.coalesce(F.col(f"_both_{m}"), F.lit(False)) | F.coalesce(F.col(f"_{kind}_{m}"), F.lit(False)), F.lit(0))
            rest.append(F.when(kept, F.coalesce(F.col(f"_last_{side}")[f"_{m}"], zero)).otherwise(zero)
                        .cast("decimal(20,4)").alias(m))
        return F.when(F.col(f"_last_{side}").isNotNull(), F.struct(*rest)).alias(side)

    return marked.select(*by, ts, values("now", "added"), values("was", "dropped"))


def mark_superseded(df: DataFrame, key: str, order: Sequence[str], ttl: int | None,
                    ts: str = "ts", near: Sequence[str] = (), carry: Sequence[str] = ()) -> DataFrame:
    """Add ``superseded``: true when the same key has a later row no more than ``ttl``
    seconds after this one (``ts`` in epoch seconds; ``order`` tells rows of one
    second apart).  Rows without a key or a time drop out.

    Only the seconds with a superseded row are sent back to the rows.  ``near``: as in ``moment_lasts``.
    ``carry`` names the columns of ``df`` that nothing here reads: where they are listed, both passes
    over ``df`` ask for the same columns and Spark makes its shuffles once.
    """
    known = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    marks = moment_lasts(known, key, order, ttl, carry, ts, near=near)
    some = marks.where(~(F.col("kept") & F.col("alone"))).drop("alone")
    last = F.struct(*[F.col("_last")[c].alias(c) for c in order])
    stays = F.col("kept").isNull() | (F.col("kept") & F.struct(*order).eqNullSafe(last))
    return (attach_marks(known, some, [key, ts], "left")
            .withColumn("superseded", ~stays)
            .select(*df.columns, "superseded"))


def reversals(marked: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Every row of ``mark_superseded``, plus a copy with negated measures of each superseded one."""
    signs = F.when(F.col("superseded"), F.array(F.lit(1), F.lit(-1))).otherwise(F.array(F.lit(1)))
    signed = marked.withColumn("_sign", F.explode(signs)).drop("superseded")
    return signed.withColumns({m: F.when(F.col("_sign") < 0, -F.col(m)).otherwise(F.col(m))
                               for m in measures}).drop("_sign")


def cancel_out(df: DataFrame, key: str, measures: Sequence[str], order: Sequence[str],
               ttl: int | None = 10, ts: str = "ts") -> DataFrame:
    """Every row, plus a copy with negated measures of each row that a later row
    of the same key replaces within ``ttl`` seconds."""
    return reversals(mark_superseded(df, key, order, ttl, ts), measures)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key, combined before the shuffle.

    ``order`` must tell a key's rows apart, for instance (ts, offset).  The other columns are
    carried, not compared, so they may be of any type, maps too.
    """
    carried = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*carried), F.struct(*order)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*").select(*df.columns)
