"""Streaming preprocess: new JSONL files in a folder are numbered, parsed,
validated and written as they arrive (Structured Streaming).

Each micro-batch is a static DataFrame over the batch's files, so the same
operators as the batch plan apply: per-file line numbers (S1), strict parse
(S2), validation and cleaning (V1-V3) and the ingest report (A4).  Outputs
go to one folder per batch id, written with overwrite, so a retried batch
replaces its own output instead of duplicating it; progress is kept in the
query's checkpoint location (a shared folder on a cluster).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.operators import profile as P
from quire.operators import validate as V
from quire.plans.preprocess import numbered_validated, validated_lines
from quire.session import ensure_conf, remove_path
from quire.sources import jsonl as J
from quire.sources.lines import line_columns


def line_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of ``(file, block, raw)`` rows from text files appearing under ``input_dir``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(input_dir).select(*line_columns())


def process_batch(batch: DataFrame, batch_id: int, output_dir: str) -> None:
    """One micro-batch: clean rows, rejects, the batch report and its domain histogram, each under ``.../batch_id=N``."""
    spark = batch.sparkSession
    ensure_conf(spark)
    part = f"batch_id={batch_id}"
    # The batch's files are scanned and parsed once; numbers and all outputs come from what is written here.
    staged = f"{output_dir}/_validated/{part}"
    if "mid" not in batch.columns:
        batch = batch.withColumn("mid", F.monotonically_increasing_id())
    validated_lines(batch).write.mode("overwrite").parquet(staged)
    flat = numbered_validated(spark.read.parquet(staged))
    V.clean_records(flat).write.mode("overwrite").options(**J.WRITE_OPTIONS).json(f"{output_dir}/clean/{part}")
    V.rejects(flat).write.mode("overwrite").json(f"{output_dir}/rejects/{part}")
    P.ingest_report(flat).write.mode("overwrite").json(f"{output_dir}/reports/{part}")
    P.report_domains(flat).write.mode("overwrite").options(**J.WRITE_OPTIONS).json(f"{output_dir}/domains/{part}")
    remove_path(spark, staged)


def clean_stream(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_location: str,
                 max_files_per_trigger: int | None = None, available_now: bool = False,
                 processing_time: str | None = None) -> StreamingQuery:
    """Start the streaming preprocess; returns the running query."""
    writer = line_stream(spark, input_dir, max_files_per_trigger).writeStream.foreachBatch(
        lambda df, bid: process_batch(df, bid, output_dir)).option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
