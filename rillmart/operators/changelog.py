"""Parsing and filtering of change-log and client-log records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rillmart.operators.joins import NOW, WAS

# Record types of the change log.
WRITE_TYPES = ["insert", "update", "delete", "bootstrap-insert"]
BOOTSTRAP_PREFIX = "bootstrap-"


def parse_json(df: DataFrame, schema: str, on_error: str = "fail",
               value: str = "value") -> DataFrame:
    """Text records to columns.  Null messages are dropped first.

    ``on_error='fail'`` stops the job at the first record that is not JSON;
    ``on_error='drop'`` leaves such records out (take them with ``dirty_records``).
    """
    if on_error == "fail":
        rest = [c for c in df.columns if c != value]
        text = df.where(F.col(value).isNotNull())
        parsed = F.from_json(value, schema, {"mode": "FAILFAST"})
        return text.select(*rest, parsed.alias("_r")).select(*rest, "_r.*")
    return _permissive(df, schema, value).where(F.col("_bad").isNull()).drop(value, "_bad")


def dirty_records(df: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """The records ``parse_json(on_error='drop')`` leaves out, as received."""
    return _permissive(df, schema, value).where(F.col("_bad").isNotNull()).select(*df.columns)


def _permissive(df: DataFrame, schema: str, value: str) -> DataFrame:
    """Parsed columns and ``_bad``.  The parser stands in a one-element ``inline``:
    a filter on ``_bad`` is then not pushed below it, where it would parse again."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = F.from_json(value, f"{schema}, _bad string", options)
    return df.where(F.col(value).isNotNull()).select("*", F.inline(F.array(parsed)))


def etl_gate(df: DataFrame, database: str) -> DataFrame:
    """Writes to one database that carry a non-empty payload."""
    return df.where((F.col("database") == database) & F.col("type").isin(WRITE_TYPES)
                    & (F.size("data") > 0))


def drop_bootstrap(df: DataFrame) -> DataFrame:
    return df.where(~F.col("type").startswith(BOOTSTRAP_PREFIX))


def changes(df: DataFrame, table: str, op: str, columns: Mapping[str, str] | Sequence[str],
            *, changed: Sequence[str] = (), was: Mapping[str, str] | None = None,
            now: Mapping[str, str] | None = None, keep: Sequence[str] = ("ts",)) -> DataFrame:
    """Rows of one table and operation, with payload fields as columns.

    ``columns`` names the payload fields to read, or maps output name to field.
    ``changed`` lists fields an update must have touched: ``old`` holds touched
    fields only.  ``was`` and ``now`` compare old and new values exactly.
    """
    wanted = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    test = (F.col("table") == table) & (F.col("type") == op)
    for field in changed:
        test &= F.col("old")[field].isNotNull()
    for field, v in (was or {}).items():
        test &= F.col("old")[field] == v
    for field, v in (now or {}).items():
        test &= F.col("data")[field] == v
    return df.where(test).select(*[F.col("data")[f].alias(c) for c, f in wanted.items()],
                                 *_present(df, keep))


def _present(df: DataFrame, keep: Sequence[str]) -> list[str]:
    names = [*keep, "et", NOW, WAS]
    return [c for c in dict.fromkeys(names) if c in df.columns]


def cart_additions(df: DataFrame) -> DataFrame:
    """Cart rows that put goods in: inserts, and updates that raise the quantity.
    An update counts with the difference."""
    new, old = F.col("data")["sku_num"], F.col("old")["sku_num"]
    gain = new.try_cast("int") - old.try_cast("int")
    inserted = F.col("type") == "insert"
    raised = (F.col("type") == "update") & (gain > 0)
    data: Column = F.col("data")
    return (df.where((F.col("table") == "cart_info") & (inserted | raised))
            .select(data["id"].alias("id"), data["user_id"].alias("user_id"),
                    data["sku_id"].alias("sku_id"),
                    F.when(inserted, new).otherwise(gain.cast("string")).alias("sku_num"),
                    *_present(df, ["ts"])))
