"""Helpers shared by the operators: tables, shared folders, Arrow batches, worker caches."""

from __future__ import annotations

import gc
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rillmart.session import shared_dir, tune

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rows and bytes of one Arrow batch, so that a Python worker's memory does not follow the
# length of the texts.
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512",
              "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def prepare(spark: SparkSession) -> SparkSession:
    """The library's settings and small Arrow batches on the caller's session."""
    tune(spark)
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def temporary(spark: SparkSession, path: str) -> str:
    """``path``, which is deleted when the application ends."""
    where, files = _path(spark, path)
    files.deleteOnExit(where)
    return path


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    The table cuts the lineage; it outlives lost executors and goes when the application ends.
    ``by``: a column whose values get folders of their own.
    """
    spark = df.sparkSession
    path = temporary(spark, shared_dir(spark, name))
    schema = df.schema
    free(spark)
    df.write.option("compression", "zstd").parquet(path, partitionBy=by)
    out = spark.read.schema(schema).parquet(path)
    out.stored_at = path
    return out


def free(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs, which it does once the driver's
    garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(df: DataFrame, folder: str = "") -> None:
    """Delete a table of ``stored``, or one folder of it, that no later step reads."""
    where, files = _path(df.sparkSession, f"{df.stored_at}/{folder}")
    files.delete(where, True)


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case, every other character unchanged.  For short texts."""
    return F.translate(column, UPPER, LOWER)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 texts of an Arrow column; null counts as empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def add_columns(df: DataFrame, added: dict[str, T.DataType], compute, *needs: str,
                cache: str | None = None) -> DataFrame:
    """``df`` with new columns made batch by batch.

    ``compute`` takes an iterator of tuples, the Arrow columns named in ``needs``, and yields for
    each the new columns' arrays.  A new column whose name is taken gets underscores in front.
    ``cache`` names what ``compute`` remembers between tasks; a worker forgets the rest first.
    """
    own = df.columns
    places = [own.index(n) for n in needs]
    names = [f"c{k}" for k in range(len(own) + len(added))]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(
        names, [f.dataType for f in df.schema.fields] + list(added.values()))])

    def run(batches):
        if cache is None or cache not in sys.__dict__.get("_rillmart_cache", {}):
            sys.__dict__.pop("_rillmart_cache", None)
        kept = []

        def columns():
            for batch in batches:
                kept.append(batch)
                yield tuple(batch.column(p) for p in places)

        for new in compute(columns()):
            yield pa.RecordBatch.from_arrays(kept.pop(0).columns + list(new), names)

    out = df.toDF(*names[:len(own)]).mapInArrow(run, schema)
    return out.toDF(*own, *new_names(df, *added))


def new_names(df: DataFrame, *names: str) -> list[str]:
    return [free_name(df.columns, n) for n in names]


def free_name(taken: list[str], name: str) -> str:
    """``name``, with underscores in front until no column is called so."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker and is shared by its tasks."""
    return sys.__dict__.setdefault("_rillmart_cache", {}).setdefault(name, {})


def unaligned_u64(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as integers (little endian)."""
    return np.ndarray((max(len(data) - 7, 0),), dtype="<u8", buffer=data.data, strides=(1,))
