"""Time-bounded, lookup and plain joins.

No join here carries a broadcast hint: the planner broadcasts a side whose size, estimated or measured at run time, is below
``spark.sql.autoBroadcastJoinThreshold``, and shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Marks of a row: it is there now, it was there before.  The time-bounded joins carry them on.
NOW, WAS = "_now", "_was"


def attach_marks(rows: DataFrame, marks: DataFrame, keys: Sequence[str],
                 how: str = "inner") -> DataFrame:
    """Join every row with the one mark of its key, where ``marks`` was aggregated by
    the same keys.

    Such a side is already partitioned by the key, and AQE slices a hot key only
    between two fresh shuffles.  The keys' hash as one more join key makes the planner
    shuffle the (narrow) marks again, so that a hot key's rows can be sliced; marks that
    turn out small are broadcast instead.
    """
    hashed = F.hash(*keys)
    return (rows.withColumn("_h", hashed).join(marks.withColumn("_h", hashed), [*keys, "_h"], how)
            .drop("_h"))


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                  lower: int, upper: int, how: str = "inner", unit: str = "SECONDS",
                  left_time: str = "et", right_time: str = "et",
                  sliced: bool = False) -> DataFrame:
    """Rows with equal keys and  left_time + lower <= right_time <= left_time + upper.

    Bounds are inclusive whole numbers of ``unit``.  On a stream the same condition
    lets the watermarks drop old state.  Columns must have distinct names except
    for the time columns: the right one is dropped.

    ``sliced=True`` is for keys with many rows on *both* sides.  Time is cut into
    slices as long as the interval; a left row lives in its own slice, a right row
    in the (at most two) slices whose left rows it can meet.  The slice joins the
    key, so a hot key spreads over time and is never paired all with all.

    Two sides that are marked (``NOW``, ``WAS``) give the join of the rows that are there now and that
    of those that were, in one pass: see ``_marked_join``.
    """
    if {NOW, WAS} <= {*left.columns} & {*right.columns}:
        return _marked_join(left, right, on, lower, upper, how, unit, left_time, right_time, sliced)
    if sliced and how in ("right", "full"):
        raise ValueError("a sliced right row stands in several slices; use sliced=False")
    bound = right.withColumnRenamed(right_time, "_rt")
    lt, rt = F.col(left_time), F.col("_rt")
    near = ((rt >= lt + _interval(lower, unit)) & (rt <= lt + _interval(upper, unit)))
    match = near
    for l, r in on:
        match &= left[l] == bound[r]
    if sliced and not left.isStreaming:
        micros = _MICROS[unit]
        width = max(upper - lower, 1) * micros

        def start(at: Column) -> Column:
            return at - F.pmod(at, F.lit(width))

        left = left.withColumn("_slice", start(F.unix_micros(left_time)))
        met = F.sequence(start(F.unix_micros("_rt") - upper * micros),
                         start(F.unix_micros("_rt") - lower * micros), F.lit(width))
        bound = bound.withColumn("_rslice", F.explode(met))
        match = near & (F.col("_slice") == F.col("_rslice"))
        for l, r in on:
            match &= left[l] == bound[r]
        return left.join(bound, match, how).drop("_slice", "_rslice", "_rt")
    joined = left.join(bound, match, how)
    if how in ("right", "full"):
        joined = joined.withColumn(left_time, F.coalesce(left_time, "_rt"))
    return joined.drop("_rt")


def _marked_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], lower: int, upper: int,
                 how: str, unit: str, left_time: str, right_time: str, sliced: bool) -> DataFrame:
    """``interval_join`` of marked rows.  A pair is there when both its rows are.

    In a left join the row without a match, too, comes out when it is there now or was.  Where a left row
    meets right ones, the first of them stands for it: it knows the time before it and the next time with
    a row that is there now, or was.  Those are found in slices of time that see both their neighbours'
    edges, so a hot key spreads over time.
    """
    if how not in ("inner", "left"):
        raise ValueError("marked rows are joined inner or left")
    marked = right.withColumnsRenamed({NOW: "_rnow", WAS: "_rwas"})
    now, was = F.col(NOW), F.col(WAS)
    if how == "inner":
        pairs = interval_join(left, marked, on, lower, upper, how, unit, left_time, right_time, sliced)
        return pairs.withColumns({NOW: now & F.col("_rnow"), WAS: was & F.col("_rwas")}) \
            .where(F.col(NOW) | F.col(WAS)).drop("_rnow", "_rwas")
    known = marked.where(" AND ".join(f"`{r}` IS NOT NULL" for _, r in on)).withColumn("_at", F.unix_micros(right_time))
    at, span = F.col("_at"), (upper - lower) * _MICROS[unit]
    width = max(600_000_000, span + 1)
    into = F.pmod(at, F.lit(width))
    home = at - into
    cuts = F.array_compact(F.array(home, F.when(into <= span, home - width), F.when(into >= width - span, home + width)))
    back = Window.partitionBy(*[r for _, r in on], "_cut").orderBy(at.desc())
    known = known.withColumn("_cut", F.explode(cuts)).withColumns({
        "_before": F.lead(at).over(back), "_next_now": F.min(F.when(F.col("_rnow"), at)).over(back),
        "_next_was": F.min(F.when(F.col("_rwas"), at)).over(back)}).where(F.col("_cut") == home).drop("_cut")
    pairs = interval_join(left, known, on, lower, upper, "left", unit, left_time, right_time, sliced)
    met, t = at.isNotNull(), F.unix_micros(left_time)
    first = met & F.coalesce(F.col("_before") < t + lower * _MICROS[unit], F.lit(True))

    def without(following: str) -> Column:
        return F.coalesce(F.col(following) > t + upper * _MICROS[unit], F.lit(True))

    def form(pair: bool, is_now: Column, is_was: Column) -> Column:
        return F.struct(F.lit(pair).alias("pair"), is_now.alias(NOW), is_was.alias(WAS))
    forms = F.array(form(True, now & F.coalesce("_rnow", F.lit(True)), was & F.coalesce("_rwas", F.lit(True))),
                    F.when(first, form(False, now & without("_next_now"), was & without("_next_was"))))
    there = F.filter(forms, lambda x: x[NOW] | x[WAS])
    own = [c for c in left.columns if c not in (NOW, WAS)]
    other = [c for c in right.columns if c not in (NOW, WAS, right_time)]
    return pairs.withColumn("_form", F.explode(there)).select(
        *own, *[F.when(F.col("_form.pair"), F.col(c)).alias(c) for c in other], f"_form.{NOW}", f"_form.{WAS}")


_MICROS = {"MILLISECONDS": 1_000, "SECONDS": 1_000_000}


def _interval(n: int, unit: str) -> Column:
    return F.expr(f"INTERVAL '{n * _MICROS[unit] / 1_000_000:.6f}' SECOND")


def ttl_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], ttl: int,
             how: str = "inner", **names: str) -> DataFrame:
    """A regular join whose sides remember rows for ``ttl`` seconds of event time:
    two rows meet when their times differ by no more than that.  An unmatched left
    row of a left join comes out once, with nulls, when no match can arrive."""
    return interval_join(left, right, on, -ttl, ttl, how, **names)


def lookup_join(df: DataFrame, dim: DataFrame, on: str, dim_key: str,
                fields: Mapping[str, str]) -> DataFrame:
    """Inner join with the current dimension snapshot; ``fields`` maps output
    names to dimension columns.  Rows without a dimension row drop out."""
    return _attach(df, dim, on, dim_key, fields, "inner")


def enrich(df: DataFrame, dim: DataFrame, on: str, dim_key: str,
           fields: Mapping[str, str]) -> DataFrame:
    """Like ``lookup_join``, but a row without a dimension row passes with nulls."""
    return _attach(df, dim, on, dim_key, fields, "left")


def _attach(df, dim, on, dim_key, fields, how):
    side = dim.select(F.col(dim_key).alias("_dim_key"),
                      *[F.col(src).alias(out) for out, src in fields.items()])
    return df.join(side, F.col(on) == F.col("_dim_key"), how).drop("_dim_key")


def regular_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                 how: str = "inner") -> DataFrame:
    """Inner, left, right and full equality joins of bounded inputs.

    AQE can slice a hot left key of an inner or left join, but not of a full one,
    so right and full joins are the inner or left join plus the right rows no left
    key meets.  Left keys are made distinct before they are shuffled for that.
    """
    def match(l, r):
        test = F.lit(True)
        for a, b in on:
            test &= l[a] == r[b]
        return test

    matched = left.join(right, match(left, right), "left" if how in ("left", "full") else "inner")
    if how in ("inner", "left"):
        return matched
    keys = left.select(*[F.col(a).alias(f"_k{i}") for i, (a, _) in enumerate(on)]).distinct()
    unmet = F.lit(True)
    for i, (_, b) in enumerate(on):
        unmet &= keys[f"_k{i}"] == right[b]
    alone = right.join(keys, unmet, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)
