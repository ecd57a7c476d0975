"""Helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import checkpoint_dir

# Words are runs of anything but space and the controls 9 to 13.
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder of ``spark.checkpoint.dir``, with the lineage cut.

    Files go when the DataFrame is no longer referenced, where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a scratch folder this package wrote, in whatever store it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


# Rows of a few numbers and a name, under 300 bytes each: 15 MB at most are broadcast.
MAX_BROADCAST_ROWS = 50_000


def counted_broadcast(table: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """A checkpointed table of narrow rows with a broadcast hint if it has at most ``limit`` rows, else as it is.

    Without the hint Spark joins by sorting and splits the rows of hot keys.
    """
    return F.broadcast(table) if table.limit(limit + 1).count() <= limit else table


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row: the optimizer copies a column into every place that names it."""
    return F.transform(F.array(value), use)[0]


def word_array(text: Column) -> Column:
    """The words of a text in order; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def n_words(text: Column) -> Column:
    """Number of words of a text as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_total(df: DataFrame, group: str, keys: list[str], value: str, out: str, rows: int = 20_000) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over all earlier rows of the row's group.

    A group may hold any share of the rows, so it is cut into hash buckets of
    about ``rows`` rows.  Order in a group: bucket, then ``keys``, then
    ``value``; it depends on the rows alone, not on their partitions.  A
    window runs inside each bucket, and one more over the buckets' sums.
    ``group`` must have no nulls.  ``df`` is read twice, so it should be cheap
    or checkpointed.
    """
    from pyspark.sql import Window

    counted = df.groupBy(group).agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(rows))).alias("_n"))
    cut = df.join(counted_broadcast(checkpointed(counted)), group).withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.col("_n"))).drop("_n")
    sums = cut.groupBy(group, "_bucket").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = checkpointed(sums.select(group, "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy(group, "_bucket").orderBy(*keys, value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = cut.withColumn("_before", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return ranked.join(counted_broadcast(starts), [group, "_bucket"]).withColumn(out, (F.col("_start") + F.col("_before")).cast("long")).drop(
        "_bucket", "_start", "_before")
