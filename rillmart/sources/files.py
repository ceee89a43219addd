"""Folders and small files of the shared store, wherever Spark can read it."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _at(spark, path)
    return files.exists(where)


def names(spark: SparkSession, pattern: str, depth: int = 1) -> list[str]:
    """The last ``depth`` parts of the paths that match a pattern, joined by '/'."""
    where, files = _at(spark, pattern)
    return ["/".join(found.getPath().toString().split("/")[-depth:]) for found in files.globStatus(where) or ()]


def delete(spark: SparkSession, path: str) -> None:
    where, files = _at(spark, path)
    files.delete(where, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a path."""
    where, files = _at(spark, path)
    return files.getContentSummary(where).getLength()


def make_folder(spark: SparkSession, path: str) -> None:
    where, files = _at(spark, path)
    files.mkdirs(where)


def rename(spark: SparkSession, path: str, into: str) -> None:
    where, files = _at(spark, path)
    if not files.rename(where, _at(spark, into)[0]):
        raise OSError(f"cannot rename {path} to {into}")


def set_time(spark: SparkSession, path: str, millis: int) -> bool:
    """Date a file; whether its store lets it be dated."""
    where, files = _at(spark, path)
    files.setTimes(where, millis, -1)
    return files.getFileStatus(where).getModificationTime() == millis


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file as a whole: readers see all of it or none."""
    where, files = _at(spark, f"{path}.tmp")
    out = files.create(where, True)
    out.write(bytearray(text.encode()))
    out.close()
    delete(spark, path)
    rename(spark, f"{path}.tmp", path)


def read_text(spark: SparkSession, path: str) -> str:
    where, files = _at(spark, path)
    stream = files.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
