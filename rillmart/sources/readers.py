"""Topics, facts, rules, dimensions and tables as DataFrames.

``Topic`` names where lines come from.  A Kafka topic is read when the session has
the Kafka package; a folder of text files (one record per line) works everywhere
and behaves the same: the same folder gives a batch or a stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillmart import schemas
from rillmart.functions.fields import camel_columns
from rillmart.operators.changelog import parse_json
from rillmart.operators.routing import rule_events
from rillmart.operators.windows import event_time

CHANGELOG_DELAY = "3 seconds"
# The column that says how often a row is added, or taken back.
COUNT = "_count"
PAGE_DELAY = "0 seconds"


@dataclass(frozen=True)
class Topic:
    """``where`` is a folder for files, or a topic name with Kafka ``options``."""
    where: str
    format: str = "text"
    options: dict[str, str] = field(default_factory=dict)


def read_lines(spark: SparkSession, topic: Topic, stream: bool = True,
               positions: bool = False) -> DataFrame:
    """Lines of a topic as ``value``; null messages are left out.  A stream starts
    at the latest offset of a Kafka topic unless its options say otherwise.

    ``positions`` adds ``partition`` and ``offset``: records of one key share a Kafka
    partition, so (ts, offset) orders changes of the same second.  A folder has no offsets;
    there they are a field of that name in each record."""
    reader = spark.readStream if stream else spark.read
    if topic.format == "kafka":
        start = {"startingOffsets": "latest" if stream else "earliest"}
        raw = (reader.format("kafka").option("subscribe", topic.where)
               .options(**{**start, **topic.options}).load())
    else:
        raw = reader.format(topic.format).options(**topic.options).load(topic.where)
    where = ["partition", "offset"] if positions else []
    if positions and topic.format != "kafka":
        raw = raw.select("value", F.lit(0).alias("partition"),
                         F.get_json_object("value", "$.offset").cast("bigint").alias("offset"))
    return raw.select(F.col("value").cast("string").alias("value"), *where).where(
        F.col("value").isNotNull())


def read_changelog(spark: SparkSession, topic: Topic, stream: bool = True,
                   on_error: str = "fail", delay: str | None = CHANGELOG_DELAY,
                   positions: bool = True) -> DataFrame:
    """Change log with event time ``et`` and processing time ``pt``.  ``delay=None`` is for jobs
    to which no row is late."""
    log = parse_json(read_lines(spark, topic, stream, positions), schemas.CHANGELOG, on_error)
    return event_time(log.withColumn("pt", F.current_timestamp()), "s", delay)


def read_fact(spark: SparkSession, topic: Topic, columns: Sequence[str], stream: bool = True,
              delay: str | None = None) -> DataFrame:
    """A fact stream read back; with ``delay`` it also gets a watermark."""
    fact = parse_json(read_lines(spark, topic, stream), schemas.fact_ddl(list(columns)))
    return event_time(fact, "s", delay)


def read_counted_changes(spark: SparkSession, where: str, schema: str, **options: str) -> DataFrame:
    """What the batches of a counted table add and take back, as a stream: the rows, their count
    (below zero for what is taken back) and ``et`` from ``ts`` in seconds."""
    rows = spark.readStream.schema(f"{schema}, {COUNT} bigint, batch_id int").options(**options).parquet(where)
    return event_time(rows.drop("batch_id"), "s")


def read_page_log(spark: SparkSession, topic: Topic, stream: bool = True,
                  delay: str | None = PAGE_DELAY) -> DataFrame:
    return event_time(parse_json(read_lines(spark, topic, stream), schemas.PAGE_LOG), "ms", delay)


def read_config_changes(spark: SparkSession, topic: Topic, rule: str = schemas.FACT_RULE,
                        stream: bool = False) -> DataFrame:
    """Configuration changes ({op, before, after, ts_ms} lines) as flat rule events,
    with the ``offset`` that orders events of one moment."""
    lines = read_lines(spark, topic, stream, positions=True).drop("partition")
    return rule_events(parse_json(lines, schemas.config_change(rule)))


def read_table(spark: SparkSession, where: str, fmt: str = "parquet", to_camel: bool = False,
               columns: Sequence[str] | None = None, **options: str) -> DataFrame:
    """One-shot table read: a path, or any DataFrame format such as ``jdbc``."""
    reader = spark.read.format(fmt).options(**options)
    rows = reader.load(where) if where else reader.load()
    rows = rows.select(*columns) if columns else rows
    return camel_columns(rows) if to_camel else rows


def read_csv_records(spark: SparkSession, where: str, schema: str,
                     stream: bool = True) -> DataFrame:
    """Comma-separated typed records."""
    return (spark.readStream if stream else spark.read).schema(schema).csv(where)
