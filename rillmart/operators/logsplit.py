"""One client-log record becomes rows of up to five fact streams.

A record with an error goes to ``err`` as it came.  A start record goes to
``start`` and nowhere else.  Any other record gives one ``display`` row per
exposure, one ``action`` row per action, and one ``page`` row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

FACTS = ("err", "start", "display", "action", "page")


def split_log(log: DataFrame) -> dict[str, DataFrame]:
    page = log.where(F.col("start").isNull())
    return {
        "err": log.where(F.col("err").isNotNull()),
        "start": log.where(F.col("start").isNotNull()).drop("err"),
        "display": page.select("common", "page", F.explode("displays").alias("display"), "ts"),
        # An action carries its own time, so the record's ts is not repeated.
        "action": page.select("common", "page", F.explode("actions").alias("action")),
        "page": page.withColumns({c: F.when(F.size(c) == 0, F.col(c))
                                  for c in ("displays", "actions")}).drop("err", "start"),
    }


def split_log_json(log: DataFrame) -> DataFrame:
    """All five streams as (topic, value) lines, read from the input only once.

    This is the shape a sink with a per-record target wants: each record is
    turned into an array of its outputs, which is then exploded.
    """
    def line(kind: str, *cols) -> F.Column:
        return F.struct(F.lit(kind).alias("topic"), F.to_json(F.struct(*cols)).alias("value"))

    has_err, has_start = F.col("err").isNotNull(), F.col("start").isNotNull()
    rest = [c for c in log.columns if c != "err"]
    body = [F.when(F.size(c) == 0, F.col(c)).alias(c) if c in ("displays", "actions") else F.col(c)
            for c in rest if c != "start"]
    nothing = F.array().cast("array<struct<topic:string,value:string>>")
    displays = F.transform(F.coalesce("displays", F.array()), lambda d: line(
        "display", "common", "page", d.alias("display"), "ts"))
    actions = F.transform(F.coalesce("actions", F.array()), lambda a: line(
        "action", "common", "page", a.alias("action")))
    out = F.concat(
        F.when(has_err, F.array(line("err", *log.columns))).otherwise(nothing),
        F.when(has_start, F.array(line("start", *rest))).otherwise(
            F.concat(displays, actions, F.array(line("page", *body)))))
    return log.select(F.explode(out).alias("o")).select("o.*")
