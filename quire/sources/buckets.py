"""Tables bucketed and sorted by a key, so that joins on it need no shuffle.

Two tables with equally many buckets of the same key have equal keys in equal
buckets: Spark joins them bucket by bucket.  A table lies under the shared
checkpoint folder and is known to the session's catalog by a name of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from quire.session import remove_path, scratch_path


def write_buckets(df: DataFrame, key: str, buckets: int, name: str = "buckets", dealt: bool = False) -> str:
    """Writes ``df`` in ``buckets`` buckets of ``key``; returns the table's name.

    Rows are dealt to one task a bucket first, so each bucket is one file; ``dealt`` says that they are already.
    """
    spark = df.sparkSession
    table = f"quire_{name}_{uuid.uuid4().hex[:12]}"
    rows = df if dealt else df.repartition(buckets, key)
    rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", scratch_path(spark, name)).saveAsTable(table)
    return table


def table_path(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def drop_buckets(spark: SparkSession, table: str) -> None:
    """Forgets a table of :func:`write_buckets` and deletes its files."""
    path = table_path(spark, table)
    spark.sql(f"DROP TABLE {table}")
    remove_path(spark, path)


@contextmanager
def one_task_a_bucket(spark: SparkSession) -> Iterator[None]:
    """Scans of bucketed tables inside take one task for each bucket, also where nothing behind them asks for it."""
    name = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)
