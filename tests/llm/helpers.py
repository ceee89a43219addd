"""Small tables with everything that goes wrong in them."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("kept", T.StringType()), T.StructField("_row", T.IntegerType()),
    T.StructField("score.1", T.StringType())])
EMPTY: list = []


def docs(spark, rows):
    """(doc_id, text) pairs as a table with extra columns, two of them with operators' names."""
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA).repartition(3)


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "Same TEXT here"), (5, "same text HERE"), (5, "same text HERE"),
       (6, "é É same"), (7, "é é same"), (None, "same text here"), (None, None), (8, "word " * 30_000),
       (9, "WORD " * 30_000), (10, "word " * 29_999 + "work "), (11, "😀 naïve café'll"), (12, "x" * 70_000)]
