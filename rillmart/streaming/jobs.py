"""The jobs as streams.

Stateless ones are plain stream plans.  What needs earlier rows works on whole micro-batches
against tables of its own (``store.PartStore``): no watermark, no late row, no state in Python.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce as fold

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rillmart import schemas
from rillmart.operators import keyed
from rillmart.operators.changelog import dirty_records, etl_gate, parse_json
from rillmart.operators.joins import NOW, WAS
from rillmart.operators.logsplit import split_log_json
from rillmart.operators.routing import dim_resets, route_dims, route_facts
from rillmart.operators.windows import REFERENCE_SIZE, event_time
from rillmart.plans import trade, traffic
from rillmart.session import shared_dir
from rillmart.sources import files, readers, sinks
from rillmart.streaming.lookups import DimVersions
from rillmart.streaming.store import PartStore, publish

SLICES = 256
# A micro-batch of a fact join is worked out in spans of time that have about so many bytes of stored and new rows.
SPAN = 1 << 30
# The time, in seconds, by which a result row belongs to a span.
OWN = "_own"
MILLIS = {"10 seconds": 10_000, "1 hour": 3_600_000, "1 day": 86_400_000}


def run_available(stream: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """Run a stream over the input there is, into a table in the shared folder, and
    read that table.  Exactly once: the file sink and its checkpoint see to that."""
    root = root or shared_dir(stream.sparkSession, name)
    _run(stream.writeStream.format("parquet").option("path", f"{root}/data"), root,
         stream.sparkSession)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/data")


def run_batches(stream: DataFrame, name: str, writer: Callable[[str], sinks.Writer],
                root: str | None = None) -> str:
    """Run a stream through a micro-batch writer; returns the folder it wrote."""
    root = root or shared_dir(stream.sparkSession, name)
    _run(stream.writeStream.foreachBatch(writer(f"{root}/data")), root, stream.sparkSession)
    return f"{root}/data"


def _run(writer, root: str, spark: SparkSession) -> None:
    # The number of state partitions is ``spark.sql.shuffle.partitions`` when a query first
    # starts, and stays: set it for the cluster the query will grow to.
    writer.outputMode("append").option("checkpointLocation", f"{root}/checkpoint") \
        .trigger(availableNow=True).start().awaitTermination()


# --- daily-unique rows ------------------------------------------------------------------------

Rows = Callable[[DataFrame], DataFrame]


def keyed_changes(rows: DataFrame, batch_id: int, held: PartStore, keys: Sequence[str], reduce: Rows,
                  derive: Rows) -> DataFrame:
    """What a micro-batch adds to and takes back from ``derive(reduce(all rows so far))``, with counts.

    ``reduce`` keeps few rows of each key, and the same few of its own results; ``held`` stores those,
    in parts whose columns ``reduce`` gives too.  ``derive`` looks at one key at a time.
    """
    held.clean(batch_id)
    where = f"{held.where}/fresh"
    reduce(rows).select(*held.schema.names).write.mode("overwrite").parquet(where)
    fresh = rows.sparkSession.read.schema(held.schema).parquet(where)
    wanted = held.part_names(fresh)
    old = held.read(batch_id, wanted)
    marks = fresh.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()
    same = fold(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    touched = old.join(marks, same, "left_semi")
    now = derive(reduce(touched.unionByName(fresh))).withColumn(sinks.COUNT, F.lit(1).cast("bigint"))
    was = derive(touched).withColumn(sinks.COUNT, F.lit(-1).cast("bigint"))
    changed = sinks.count_rows(now.unionByName(was))
    held.replace(batch_id, reduce(old.unionByName(fresh)), wanted)
    return changed


def daily(stream: DataFrame, name: str, root: str | None, kept: str, by: Sequence[str], keys: Sequence[str],
          prepare: Rows, reduce: Rows, derive: Rows, windows: Callable[[DataFrame, DataFrame], DataFrame]) -> str:
    """A summary of daily-unique rows, kept up to date without a watermark: a row that comes late
    takes back what a later row of its key and day has added.  Returns the folder of the windows'
    changes; ``sinks.read_summed`` reads it."""
    def writer(where: str) -> sinks.Writer:
        held = PartStore(stream.sparkSession, f"{where}/keys", kept, by)

        def write(batch: DataFrame, batch_id: int) -> None:
            rows = prepare(batch).where("ts IS NOT NULL").persist()
            try:
                changed = keyed_changes(rows, batch_id, held, keys, reduce, derive)
                publish(windows(rows, changed), f"{where}/windows", batch_id)
            finally:
                rows.unpersist()
        return write
    return run_batches(stream, name, writer, root) + "/windows"


def bucket(buckets: int, *keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _firsts(keys: Sequence[str], carry: Sequence[str], buckets: int) -> Rows:
    return lambda rows: keyed.first_per_day(rows, keys, carry).withColumn("bucket", bucket(buckets, *keys))


def _same(rows: DataFrame) -> DataFrame:
    return rows


def page_view(page_log: DataFrame, size: str = REFERENCE_SIZE, name: str = "page-view", root: str | None = None,
              buckets: int = 1) -> str:
    """Views, sessions and durations are summed straight away; only each device's first view of a
    day is kept, in parts by day and by ``buckets`` of devices."""
    def windows(views: DataFrame, firsts: DataFrame) -> DataFrame:
        zero = F.lit(0).cast("bigint")
        plain = views.select("ts", *traffic.VISIT_KEYS, "sv", "pv", "dur", zero.alias("uv"))
        unique = firsts.select("ts", *traffic.VISIT_KEYS, zero.alias("sv"), zero.alias("pv"), zero.alias("dur"),
                               F.col(sinks.COUNT).alias("uv"))
        return traffic.page_view_windows(event_time(plain.unionByName(unique)), size)

    kept = "mid string, day string, ts bigint, vc string, ch string, ar string, is_new string, bucket int"
    return daily(page_log, name, root, kept, ["day", "bucket"], ["mid", "day"], traffic.visits,
                 _firsts(["mid"], traffic.VISIT_KEYS, buckets), _same, windows)


def home_detail_uv(page_log: DataFrame, size: str = REFERENCE_SIZE, name: str = "home-detail",
                   root: str | None = None, buckets: int = 1) -> str:
    def windows(_, firsts: DataFrame) -> DataFrame:
        return traffic.home_detail_windows(event_time(firsts), size, F.col(sinks.COUNT))

    return daily(page_log, name, root, "mid string, page_id string, day string, ts bigint, bucket int",
                 ["day", "bucket"], ["mid", "page_id", "day"], traffic.home_detail_views,
                 _firsts(["mid", "page_id"], [], buckets), _same, windows)


def user_login(page_log: DataFrame, size: str = REFERENCE_SIZE, name: str = "user-login",
               root: str | None = None, buckets: int = 1) -> str:
    """Login days are kept for good, in parts by ``buckets`` of users: a user may come back at any time."""
    def windows(_, days: DataFrame) -> DataFrame:
        return traffic.user_login_windows(event_time(days), size, F.col(sinks.COUNT))

    return daily(page_log, name, root, "uid string, day string, ts bigint, bucket int", ["bucket"], ["uid"],
                 traffic.logins, _firsts(["uid"], [], buckets), keyed.login_days, windows)


def cart_add_uu(cart: DataFrame, size: str = REFERENCE_SIZE, name: str = "cart-add-uu", root: str | None = None,
                buckets: int = 1) -> str:
    def windows(_, firsts: DataFrame) -> DataFrame:
        return trade.cart_add_windows(event_time(firsts), size, F.col(sinks.COUNT))

    return daily(cart, name, root, "user_id string, day string, ts bigint, bucket int", ["day", "bucket"],
                 ["user_id", "day"], lambda rows: rows.select("user_id", (F.col("ts") * 1000).alias("ts")),
                 _firsts(["user_id"], [], buckets), _same, windows)


# --- client log -------------------------------------------------------------------------------

FIRST_DAYS = "_mid string, _first_day string, _from bigint, bucket int"
EVER = (1 << 62) - 1


def first_day_terms(fresh: DataFrame, old: DataFrame, ttl: int | None, where: str) -> DataFrame:
    """(_mid, _first_day, _from, _until) for a micro-batch's rows of devices (_mid, _is_new, ts).

    The terms stored for a device come first; a row behind the end of a term starts the next one,
    with the rule for a device not seen before.  Every round starts one term for each device that
    still has rows behind its last one, as an aggregate over those rows, so the rounds are as many
    as terms fit into the time of one micro-batch.
    """
    spark, until = fresh.sparkSession, F.col("_from") + F.lit(ttl) if ttl else F.lit(EVER)

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{where}/{name}={len(terms)}")
        return spark.read.schema(rows.schema).parquet(f"{where}/{name}={len(terms)}")

    columns = ["_mid", "_first_day", "_from", until.alias("_until"), F.col("_from").alias("_at")]
    # What comes late falls into the stored term, as far as that is known.
    terms = [old.select(*columns).withColumn("_from", F.lit(-EVER))]
    ends = old.select(F.col("_mid").alias("_of"), until.alias("_until"))
    behind = fresh.join(ends, F.col("_mid") == F.col("_of"), "left").where("_until IS NULL OR ts > _until")
    while True:
        behind = written(behind.select(*fresh.columns), "behind")
        started = written(keyed.first_days(behind, F.col("_mid"), F.col("_is_new"), F.col("ts")), "started")
        if started.isEmpty():
            return fold(DataFrame.unionByName, terms)
        terms.append(started.select(*columns))
        ends = started.select(F.col("_mid").alias("_of"), until.alias("_until"))
        behind = behind.join(ends, F.col("_mid") == F.col("_of")).where("ts > _until")


def split_log(lines: DataFrame, name: str = "log-split", root: str | None = None, fmt: str = "json",
              buckets: int = 1, ttl: int | None = None) -> str:
    """Raw client-log lines to the five traffic facts, below ``facts/topic=...``, and lines that
    are not records to ``dirty``, in one job.  Returns the folder.

    No line is late: a micro-batch's visitor flags are corrected as a whole, against the first
    days stored so far.  A device's first micro-batch sets its first day, a row per device is
    all that is kept, in ``buckets`` of devices of one folder each, and rows without a device pass.

    With ``ttl`` a first day is forgotten that many milliseconds of event time after the row that set
    it, and the next row sets it anew; what the store holds then shrinks to devices seen lately.  Time
    goes on with the newest row: one that comes later than ``ttl`` behind it may start a term too.
    """
    def writer(where: str) -> sinks.Writer:
        held = PartStore(lines.sparkSession, f"{where}/first_days", FIRST_DAYS, ["bucket"])
        facts, dirty = sinks.write_batches(f"{where}/facts", fmt, ["topic"]), sinks.write_batches(f"{where}/dirty", "text")

        def write(batch: DataFrame, batch_id: int) -> None:
            batch = batch.persist()
            log = parse_json(batch, schemas.CLIENT_LOG, "drop")
            mid, is_new, ts = F.col("common")["mid"], F.col("common")["is_new"], F.col("ts")
            seen = log.select(mid.alias("_mid"), is_new.alias("_is_new"), "ts").where(
                "_mid IS NOT NULL AND ts IS NOT NULL").withColumn("bucket", bucket(buckets, "_mid")).persist()
            try:
                held.clean(batch_id)
                wanted = held.part_names(seen)
                old = held.read(batch_id, wanted)
                here = old.join(seen.select("_mid").distinct(), "_mid", "left_semi")
                terms = first_day_terms(seen.drop("bucket"), here, ttl, f"{where}/terms")
                fixed = keyed.repair_by_terms(log, mid, is_new, ts, terms.drop("_at"))
                fixed = fixed.withColumn("common", traffic.with_flag(F.col("common"), F.col("is_new_fixed")))
                facts(split_log_json(fixed.drop("is_new_fixed")), batch_id)
                dirty(dirty_lines(batch), batch_id)
                # The last term of each device; with a time to live, none that is over for all of them.
                newest = max(held.index(batch_id)["notes"].get("newest", -EVER), seen.agg(F.max("ts")).first()[0] or -EVER)
                begun = terms.select("_mid", "_first_day", F.col("_at").alias("_from")).withColumn("bucket", bucket(buckets, "_mid"))
                kept = keyed.latest_per_key(old.unionByName(begun), ["_mid"], ["_from"])
                if ttl:
                    kept = kept.where(F.col("_from") >= newest - ttl)
                held.replace(batch_id, kept, wanted, {"newest": newest})
            finally:
                batch.unpersist()
                seen.unpersist()
        return write
    return run_batches(lines, name, writer, root)


def dirty_lines(lines: DataFrame) -> DataFrame:
    return dirty_records(lines, schemas.CLIENT_LOG)


# --- facts ----------------------------------------------------------------------------------

Span = tuple[int | None, int | None]


def time_spans(sizes: Mapping[int, float], width: int, reach: int) -> list[Span]:
    """Cut time where parts of these bytes, ``width`` seconds each, come to ``SPAN``.  Larger parts are cut inside, but no
    finer than twice the ``reach``, since a span is worked out from the rows so far around it."""
    cuts, held = [], 0.0
    for part, size in sorted(sizes.items()):
        pieces = max(1, min(math.ceil(size / SPAN), width // (2 * max(reach, 1))))
        for k in range(pieces):
            if held and held + size / pieces > SPAN:
                cuts.append(part * width + k * width // pieces)
                held = 0.0
            held += size / pieces
    return [*zip([None, *cuts], [*cuts, None])]


def within(time: Column, span: Span, more: int = 0) -> Column:
    """Whether a time lies in a span, or up to ``more`` seconds around it."""
    start, end = span
    yes = F.lit(True)
    if start is not None:
        yes &= time >= start - more
    if end is not None:
        yes &= time < end + more
    return yes


def join_facts(sides: Mapping[str, DataFrame], plan: Callable[..., DataFrame], reach: int, name: str,
               root: str | None = None, width: int = 86_400, keep: int | None = None,
               keys: Mapping[str, Column] | None = None, buckets: int = 1,
               dims: Mapping[str, DimVersions] | None = None,
               changed: Callable[[DataFrame, Span], DataFrame] | None = None,
               marked: bool = False, spans: bool = False) -> str:
    """Rows derived from streams with ``et``, row for row the batch ``plan`` of all their rows so far.
    Returns the folder; ``sinks.read_counted`` reads it, ``readers.read_counted_changes`` as a stream.

    No row is late: sides are stored, and a micro-batch puts its rows together with all stored ones
    near them in event time.  ``reach`` is the most seconds between two rows that one result row, or
    its being unmatched, depends on.  What the micro-batch adds to the result is written with a count
    above zero, what it takes back (an unmatched row of a left join whose match came) below.  A side
    may carry such counts itself: rows it takes back disappear from the stored ones.

    Stored rows lie in parts by ``width`` seconds (``reach`` at least) and, where ``keys`` names a
    value that all sides' rows of one result share, by ``buckets`` of it.  A micro-batch reads the
    parts near its rows and rewrites those its rows fall in.  With ``keep``, parts more than that many
    seconds older than the newest row of the batches before are deleted, and rows that old are
    written to ``late`` instead.  ``plan`` also gets ``dims``, each in the version that is the newest
    when the micro-batch starts; results of earlier batches stay as they were.

    ``changed``, for one side, is the difference of two plans in one pass: from rows that the plan sees
    ``_now``, ``_was`` given, or both, to the counted rows to publish that belong to a span of time.  ``marked`` says that ``plan`` carries such
    marks from its sides, none of them counted, to its result, as the facts' plans do: it is worked out once then,
    and the rows that come or go are published without being compared.

    With ``spans``, a large micro-batch is worked out in spans of time, one after another, so that what it shuffles
    at a time is bounded.  Each result row belongs to one: ``changed`` is asked for those of a span, and ``plan`` gives
    them by a column ``OWN``, a time no more than ``reach`` from any row that the result row depends on.
    """
    width = max(width, reach)
    counted = {s for s, side in sides.items() if sinks.COUNT in side.columns}
    if marked and counted:
        raise ValueError("marks do not say how often a counted row is there")
    hashed = {s: F.xxhash64((keys or {}).get(s, F.lit(0))) for s in sides}
    rows = fold(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
        side.select(F.struct(*[c for c in side.columns if c != sinks.COUNT]).alias(s), F.unix_seconds("et").alias("_at"),
                    F.pmod(hashed[s], F.lit(buckets)).cast("int").alias("bucket"),
                    (F.col(sinks.COUNT) if s in counted else F.lit(1).cast("bigint")).alias("_n"))
        for s, side in sides.items()]).withColumn("part", F.floor(F.col("_at") / width).cast("int"))
    rows = rows.where("_at IS NOT NULL")
    # Slices are wide enough that their names, which the parts bound, are a small table.
    wide = max(reach, width // SLICES)
    at, time_slice = F.col("_at"), F.floor(F.col("_at") / wide)

    def summed(some: DataFrame) -> DataFrame:
        """One row for equal rows of the sides that are counted, none where nothing is left."""
        parts = [some.where(F.col(s).isNotNull()) for s in sides if s not in counted]
        for s in counted:
            own = some.where(F.col(s).isNotNull())
            others = [c for c in some.columns if c != "_n"]
            parts.append(own.groupBy(*[c for c in others if c in (s, "_at", "bucket", "part")])
                         .agg(F.sum("_n").alias("_n")).where("_n <> 0"))
        return fold(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).select(*some.columns)

    def owned(found: DataFrame, span: Span) -> DataFrame:
        return found.where(within(F.col(OWN), span)).drop(OWN) if spans else found

    def result(near: DataFrame, sign: int, looked_up: dict[str, DataFrame], span: Span) -> DataFrame:
        parts = dict(looked_up)
        for s in sides:
            own = near.where(F.col(s).isNotNull())
            if s in counted:
                own = own.where("_n > 0").withColumn("_n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))))
            parts[s] = own.select(f"{s}.*")
        return owned(plan(**parts), span).withColumn(sinks.COUNT, F.lit(sign).cast("bigint"))

    def tag(near: DataFrame, new: DataFrame) -> DataFrame:
        yes = F.lit(True)
        return near.withColumns({NOW: yes, WAS: yes}).unionByName(new.withColumns({NOW: yes, WAS: ~yes}))

    def marked_changes(near: DataFrame, new: DataFrame, looked_up: dict[str, DataFrame], span: Span) -> DataFrame:
        tagged = tag(near, new)
        got = plan(**{s: tagged.where(F.col(s).isNotNull()).select(f"{s}.*", NOW, WAS) for s in sides}, **looked_up)
        return owned(got, span).where(F.col(NOW) != F.col(WAS)).withColumn(
            sinks.COUNT, F.when(F.col(NOW), 1).otherwise(-1).cast("bigint")).drop(NOW, WAS)

    def difference(near: DataFrame, new: DataFrame, span: Span) -> DataFrame:
        (s,), tagged = sides, tag(near, new)
        if counted:
            tagged = tagged.groupBy(s, "_at", "bucket", "part").agg(
                (F.sum("_n") > 0).alias(NOW), F.max(WAS).alias(WAS)).where(F.col(NOW) | F.col(WAS))
        return changed(tagged.where(F.col(s).isNotNull()).select(f"{s}.*", NOW, WAS), span)

    def writer(where: str) -> sinks.Writer:
        held = PartStore(rows.sparkSession, f"{where}/sides", rows.schema, ["part", "bucket"])

        def write(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            held.clean(batch_id)
            # What only grows is written once, as it will be stored.
            incoming, came = f"{where}/incoming", None
            if keep is None and not counted:
                came = held.write(batch, incoming, ["_at"])
            else:
                batch.write.mode("overwrite").parquet(incoming)
            new = spark.read.schema(rows.schema).parquet(incoming).select(*rows.columns)
            newest = held.index(batch_id)["notes"].get("newest")
            horizon = None if keep is None or newest is None else newest - keep
            if horizon is not None:
                new.where(at < horizon).write.mode("overwrite").parquet(f"{where}/late/batch_id={batch_id}")
                new = new.where(at >= horizon)
            met = new.select(time_slice.alias("_s"), "bucket").distinct().collect()
            slices = sorted({(r["_s"] + k, r["bucket"]) for r in met for k in (-1, 0, 1)})
            own = held.part_names(new) if came is None else came
            wanted = {f"part={end // width}/bucket={b}" for s, b in slices for end in (s * wide, (s + 1) * wide - 1)}
            looked_up = {d: v.current() for d, v in (dims or {}).items()}

            def changes(span: Span) -> DataFrame:
                """What changes in a span of time, from the rows in it and within reach of it."""
                start, end = (None if t is None else (t + more) // width for t, more in zip(span, (-reach, reach)))
                inside = {p for p in wanted if (start is None or start <= _part(p)) and (end is None or _part(p) <= end)}
                # A table that the planner knows to be small.
                some = spark.createDataFrame(pa.table({"_slice": pa.array([s for s, _ in slices], pa.int64()),
                                                       "bucket": pa.array([b for _, b in slices], pa.int32())}))
                old = held.read(batch_id, inside).where(within(at, span, reach)).withColumn("_slice", time_slice)
                near = old.join(some, ["_slice", "bucket"]).select(*rows.columns)
                # The part's column names folders, which are left out unread.
                fresh = new.where(within(at, span, reach))
                fresh = fresh if start is None else fresh.where(F.col("part") >= start)
                fresh = fresh if end is None else fresh.where(F.col("part") <= end)
                if changed:
                    return difference(near, fresh, span)
                if marked:
                    return marked_changes(near, fresh, looked_up, span)
                now = near.unionByName(fresh)
                both = result(summed(now) if counted else now, 1, looked_up, span).unionByName(result(near, -1, looked_up, span))
                return sinks.count_rows(both)

            cut: list[Span] = [(None, None)]
            if spans:
                sizes: dict[int, float] = {}
                for p, size in held.sizes(batch_id, wanted).items():
                    sizes[_part(p)] = sizes.get(_part(p), 0) + size
                for p in own:
                    size = files.size(spark, incoming) / len(own) if came is None else files.size(spark, f"{incoming}/{p}")
                    sizes[_part(p)] = sizes.get(_part(p), 0) + size
                cut = time_spans(sizes, width, reach)
            publish([changes(span) for span in cut], f"{where}/facts", batch_id)
            last = new.agg(F.max(at)).first()[0]
            newest = max((n for n in (last, newest) if n is not None), default=None)
            if came is not None:
                held.add(batch_id, incoming, came, {"newest": newest}, ["_at"])
                return
            # A row at the horizon still needs what lies ``reach`` behind it.
            end = None if keep is None or newest is None else newest - keep - reach
            kept = held.read(batch_id, own).unionByName(new)
            held.replace(batch_id, summed(kept) if counted else kept, own, {"newest": newest},
                         None if end is None else lambda p: (int(p["part"]) + 1) * width <= end, ["_at"])
        return write
    return run_batches(rows, name, writer, root) + "/facts"


def _part(name: str) -> int:
    return int(name.split("/")[0].removeprefix("part="))


def with_dims(stream: DataFrame, plan: Callable[..., DataFrame], dims: Mapping[str, DimVersions], name: str,
              root: str | None = None) -> DataFrame:
    """A row-wise fact whose lookups see the dimension versions of each micro-batch's moment."""
    shape = plan(stream, **{d: v.current() for d, v in dims.items()}).schema

    def writer(where: str) -> sinks.Writer:
        return lambda batch, n: publish(plan(batch, **{d: v.current() for d, v in dims.items()}), f"{where}/facts", n)

    where = run_batches(stream, name, writer, root)
    return stream.sparkSession.read.schema(shape).parquet(f"{where}/facts").drop("batch_id")


# --- trade ------------------------------------------------------------------------------------
#
# A micro-batch works the windows its rows fall in out again, from the stored rows, and takes the
# windows back as they were: repeats and taken-back lines need no state of their own.

def needed(detail: DataFrame, *columns: str) -> DataFrame:
    """What windows read of order details; the rest is not worth storing."""
    counts = [c for c in detail.columns if c == sinks.COUNT]
    return detail.select(*dict.fromkeys(["id", *columns, "ts", "et", *counts]))


def starting(size: str, span: Span) -> Rows | None:
    """The rows whose windows start in a span."""
    if span == (None, None):
        return None
    return lambda rows: rows.where(within(F.col("ts") - F.pmod(F.col("ts"), F.lit(MILLIS[size] // 1000)), span))


def province_order(detail: DataFrame, size: str = REFERENCE_SIZE, order: Sequence[str] = (),
                   ttl: int = trade.REPEAT_TTL, name: str = "province", **store) -> str:
    """Windows by province; ``trade.with_province`` names the provinces when they are read."""
    def plan(detail: DataFrame) -> DataFrame:
        return trade.province_windows(detail, size, order, ttl)

    def changed(detail: DataFrame, span: Span) -> DataFrame:
        return trade.province_changes(detail, size, order, ttl, starting(size, span))
    side = needed(detail, "order_id", "province_id", "split_total_amount", *order)
    return join_facts({"detail": side}, plan, MILLIS[size] // 1000 + ttl, name, changed=changed, spans=True, **store)


def sku_order(detail: DataFrame, size: str = REFERENCE_SIZE, order: Sequence[str] = (),
              ttl: int = trade.REPEAT_TTL, name: str = "sku", **store) -> str:
    """Windows by product; ``trade.with_products`` adds the attributes when they are read."""
    def plan(detail: DataFrame) -> DataFrame:
        return trade.sku_windows(detail, size, order, ttl)

    def changed(detail: DataFrame, span: Span) -> DataFrame:
        return trade.sku_changes(detail, size, order, ttl, starting(size, span))
    side = needed(detail, "sku_id", *trade.SKU_MEASURES.values(), *order)
    return join_facts({"detail": side}, plan, MILLIS[size] // 1000 + ttl, name, changed=changed, spans=True, **store)


def sku_order_by_clock(detail: DataFrame, size: str = REFERENCE_SIZE, order: Sequence[str] = (),
                       ttl: int = trade.REPEAT_TTL, name: str = "sku-clock", root: str | None = None, **store) -> str:
    """Windows by product on the wall clock: amounts, and what repeats take back of them, count in the
    window in which their micro-batch runs.  Returns the folder; each batch's windows are final."""
    spark, root = detail.sparkSession, root or shared_dir(detail.sparkSession, name)

    def plan(detail: DataFrame) -> DataFrame:
        return trade.net_measures(detail, ["sku_id"], trade.SKU_MEASURES, order, ttl).withColumn(OWN, F.col("ts"))

    side = needed(detail, "sku_id", *trade.SKU_MEASURES.values(), *order)
    moments = join_facts({"detail": side}, plan, ttl, name, f"{root}/moments", spans=True, **store)
    shape = ", ".join(["sku_id string", "ts bigint", *[f"{m} decimal(20,4)" for m in trade.SKU_MEASURES]])

    def writer(where: str) -> sinks.Writer:
        def write(batch: DataFrame, batch_id: int) -> None:
            signed = batch.withColumns({m: F.col(m) * F.col(sinks.COUNT) for m in trade.SKU_MEASURES})
            publish(trade.sku_sums(signed, size, "processing"), f"{where}/windows", batch_id)
        return write
    return run_batches(readers.read_counted_changes(spark, moments, shape), name, writer, f"{root}/windows") + "/windows"


# --- routing ------------------------------------------------------------------------------------

def sync_dims(log: DataFrame, rules: Callable[[], DataFrame], database: str, name: str = "dims",
              order: Sequence[str] = ("ts", "offset"), root: str | None = None,
              config: DataFrame | None = None) -> str:
    """Keep dimension tables up to date.  ``rules`` is called for every micro-batch, so
    a rule change takes effect with the next one.

    ``config``, a stream of flat rule events, runs merged with the log: a change or removal of a
    dimension's rule empties the dimension from the event's time on.  Its time is stored beside
    the cells as a fence, and ``sinks.read_dims`` shows only what was written behind it, whichever of
    the two came first.
    """
    rows = log.select(F.struct(*log.columns).alias("log"))
    if config is not None:
        rows = rows.unionByName(config.select(F.struct("op", "sink_table", "ts_ms").alias("rule")), allowMissingColumns=True)

    def writer(where: str) -> sinks.Writer:
        store, fence = sinks.store_dims(where, order), sinks.store_fences(where)

        def write(batch: DataFrame, batch_id: int) -> None:
            batch = batch.persist()
            try:
                changes = batch.where("log IS NOT NULL").select("log.*")
                store(route_dims(etl_gate(changes, database), rules(), order), batch_id)
                if config is not None:
                    fence(dim_resets(batch.where("rule IS NOT NULL").select("rule.*")), batch_id)
            finally:
                batch.unpersist()
        return write
    return run_batches(rows, name, writer, root)


def sync_facts(log: DataFrame, rules: Callable[[], DataFrame], name: str = "facts",
               root: str | None = None) -> str:
    """Route change-log rows to the fact targets the current rules name."""
    def writer(where: str) -> sinks.Writer:
        store = sinks.write_batches(where, split_by=["sink_table"])
        return lambda batch, n: store(route_facts(batch, rules()), n)
    return run_batches(log, name, writer, root)
