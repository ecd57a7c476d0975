"""Files of raw bytes written and read by Spark, in any store that Spark reaches.

Spark's text writer writes a string's bytes as they are, followed by a line
separator.  Binary rows cast to strings therefore become a binary file whose
records each end with a separator byte that the format counts as its own.
Task commits, retries and speculative tasks are Spark's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_records(df: DataFrame, path: str, column: str, separator: str) -> None:
    """One file a partition: the bytes of ``column`` row by row, each followed by ``separator`` (one ASCII character)."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").option("lineSep", separator).text(path)


def read_files(spark: SparkSession, path: str, names: str = "part-*") -> DataFrame:
    """``(path, content)``: each whole file under ``path`` whose name fits the pattern ``names``, as one row."""
    return spark.read.format("binaryFile").option("pathGlobFilter", names).load(path).select("path", "content")
