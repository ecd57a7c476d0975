"""Registered queries of the file sources and sinks.

Each writes a table to files of its own with the library's sinks and reads
them back with its sources.  The read runs with small file blocks, so that
files are cut into several ones and read by several tasks; what it gives is
kept as a table under the shared checkpoint folder and the files are deleted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import metrics as M
from quire.operators import split as D
from quire.plans.inputs import doc_clean, pairs, scored_pairs
from quire.session import remove_path, scratch_path
from quire.sources import jsonl as J
from quire.sources import tables as T
from quire.sources.lines import content_lines, number_written, scan_lines

BLOCK_BYTES = 512 << 10
# Texts a file holds, in the order of their ids.
FILE_TEXTS = 1024
NULL_DOMAIN_EVERY = 7


@contextmanager
def file_blocks(spark: SparkSession, size: int = BLOCK_BYTES) -> Iterator[None]:
    """Files read inside are cut into blocks of ``size`` bytes."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def through_files(spark: SparkSession, name: str, write: Callable[[str], None], read: Callable[[str], DataFrame]) -> DataFrame:
    """What ``read`` finds in the files that ``write`` made; the files are gone afterwards."""
    files, kept = scratch_path(spark, name), scratch_path(spark, f"{name}-read")
    write(files)
    with file_blocks(spark):
        read(files).write.parquet(kept)
    remove_path(spark, files)
    return spark.read.parquet(kept)


def write_text_files(texts: DataFrame, path: str, n: int = FILE_TEXTS) -> None:
    """``(rid, text)`` as text files of ``n`` ids each, in the order of the ids, in folders ``file_no=<rid div n>``."""
    filed = texts.select(F.expr(f"rid div {n}").alias("file_no"), "rid", F.coalesce("text", F.lit("")).alias("text"))
    filed.repartition("file_no").sortWithinPartitions("file_no", "rid").select("file_no", "text").write.partitionBy("file_no").text(path)


def s1_file_lines(spark, sf):
    """S1 over files of all document texts: every line that is not blank, with its number in its file."""
    docs = T.table(spark, sf, "documents").select(F.col("doc_id").alias("rid"), "text")
    scanned = through_files(spark, "s1", lambda path: write_text_files(docs, path), lambda path: scan_lines(spark, path))
    number = F.regexp_extract("file", r"file_no=(-?\d+)", 1).cast("long").alias("file_no")
    return content_lines(number_written(scanned)).select(number, "idx", "line")


def s3_s6_roundtrip(spark, sf):
    """Clean document pairs, some with a null domain, written as JSONL and read with their schema."""
    named = F.when(F.col("rid") % NULL_DOMAIN_EVERY != 0, F.col("domain"))
    clean = doc_clean(spark, sf).withColumn("domain", named)
    return through_files(spark, "s6", lambda path: J.write_records(clean, path), lambda path: J.read_records(spark, path))


def s7_splits(spark, sf):
    """D2's split joined to whole records, written a folder a split (S7) and read back (S3)."""
    records = pairs(spark, sf).withColumn("domain", F.lit(None).cast("string"))
    back = through_files(spark, "s7", lambda path: J.write_splits(D.three_way_split(records), path), lambda path: J.read_split(spark, path))
    return back.select("rid", "question", "answer", "domain", "pos", "split")


def s8_metrics(spark, sf):
    """The metric table as one JSON document, read back as ``(label, metric, value)``."""
    table = M.metric_table(scored_pairs(spark, sf))
    text = through_files(spark, "s8", lambda path: J.write_metrics(table, path), lambda path: spark.read.text(path, wholetext=True))
    parsed = F.from_json("value", "map<string, map<string, double>>")
    return text.select(F.explode(parsed).alias("label", "metrics")).select("label", F.explode("metrics").alias("metric", "value"))


FILE_QUERIES = {f.__name__: f for f in [s1_file_lines, s3_s6_roundtrip, s7_splits, s8_metrics]}
