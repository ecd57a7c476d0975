"""Numbered JSONL line scan.

The reference numbers the physical lines of one file from 0 (blank lines
use up a number) and then drops blank lines.  A file read by Spark is split
into blocks read by different tasks, and no task knows how many lines came
before its block.  So:

1. ``spark.read.text`` with ``_metadata.file_path`` / ``file_block_start``;
   ``monotonically_increasing_id`` is consecutive inside a task, and a block
   is read by one task from its start, so ``mid - min(mid) of the block`` is
   the line's index inside its block;
2. the scanned rows are written **once**; a second scan could be cut into
   other blocks, as Spark chooses them by the parallelism of the moment;
3. from the written table: per block ``min(mid)`` and the line count, a
   running sum of the counts of earlier blocks of the same file, and a join of
   both on (file, block).

The summary has one row per file split, so it grows with bytes / split size,
not with rows; Spark picks the join by its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.text import strip
from quire.session import scratch_path


def line_columns() -> list:
    """File path, block start and text of each line of a text scan."""
    return [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("raw"),
    ]


def scan_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, block, mid, raw)`` for every physical line of the files at ``path``."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.text(paths).select(*line_columns()).withColumn("mid", F.monotonically_increasing_id())


def number_written(rows: DataFrame, out_col: str = "idx") -> DataFrame:
    """Replaces ``block`` and ``mid`` by ``out_col``, the line's number in its file from 0.

    ``rows`` must be read from a table that one :func:`scan_lines` was written
    to, with a row for every line: then both reads below see the same blocks.
    """
    blocks = rows.groupBy("file", "block").agg(F.min("mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    number = (F.col("_offset") + F.col("mid") - F.col("_first")).cast("long")
    return rows.join(offsets, ["file", "block"]).withColumn(out_col, number).drop("block", "mid", "_first", "_offset")


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, line_no, raw)`` for every physical line, blank ones included; ``line_no`` from 0 per file.

    The lines are written under the shared checkpoint folder and read from there.
    """
    written = scratch_path(spark, "lines")
    scan_lines(spark, path).write.parquet(written)
    return number_written(spark.read.parquet(written), "line_no").select("file", "line_no", "raw")


def content_lines(raw_lines: DataFrame, idx_col: str = "idx", raw_col: str = "raw") -> DataFrame:
    """Strip each line (Python's whitespace set) and drop blank ones, keeping the index."""
    out = raw_lines.withColumn("line", strip(raw_col)).where(F.col("line") != "").drop(raw_col)
    return out.withColumnRenamed(idx_col, "idx") if idx_col != "idx" else out


def text_lines(df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """S1 over texts held in a table: each text is one "file" split at ``\\n``.

    ``(id_col, idx, line)``: 0-based line index within the text (blank lines
    use up an index), stripped, blank lines dropped.  Row-local, no shuffle.
    """
    raw = df.select(id_col, F.posexplode(F.split(F.col(text_col), "\n")).alias("idx", "raw"))
    return content_lines(raw).select(id_col, F.col("idx").cast("long").alias("idx"), "line")


def read_jsonl_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, idx, line)`` for the non-blank, stripped lines; ``idx`` counts from 0 in each file."""
    numbered = numbered_lines(spark, path)
    return content_lines(numbered.withColumnRenamed("line_no", "idx"))
