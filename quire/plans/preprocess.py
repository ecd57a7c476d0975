"""Preprocess plan: JSONL -> numbered lines -> parse -> validate -> clean,
reports, token profile and exact split (the reference's first stage).

The parsed table feeds several branches (clean sink, rejects, report,
profile, split).  It is written once as a parquet table under the cluster's
checkpoint folder, so each branch reads columns of that table instead of
parsing the source again, and a lost executor never forces a re-parse.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import strip
from quire.operators import profile as P
from quire.operators import prompts as PR
from quire.operators import split as D
from quire.operators import validate as V
from quire.session import ensure_conf, remove_path, scratch_path
from quire.sources import jsonl as J
from quire.sources.lines import number_written, scan_lines


@dataclass
class Preprocessed:
    validated: DataFrame   # (file, idx, line, parse_ok, reason, ...)
    clean: DataFrame       # (rid, question, answer, domain)
    rejects: DataFrame     # (idx, reason, message)
    first_rejects: DataFrame
    report: DataFrame      # A4, one row
    domains: DataFrame     # A4's histogram (domain, n)
    lengths: DataFrame     # T3, one row
    splits: DataFrame      # (rid, question, answer, domain, pos, split)
    split_sizes: DataFrame  # D3
    scratch: list[str] = field(default_factory=list)  # tables written on the way

    def cleanup(self) -> None:
        """Deletes the written tables; the DataFrames above cannot be read after it."""
        for path in self.scratch:
            remove_path(self.validated.sparkSession, path)
        self.scratch.clear()


def preprocess_lines(lines: DataFrame, max_length: int = P.DEFAULT_MAX_LENGTH, train_ratio: float = D.TRAIN_RATIO,
                     val_ratio: float = D.VAL_RATIO, seed: int = D.DEFAULT_SEED, materialize: bool = True,
                     template: PR.ChatTemplate | None = PR.DEFAULT_TEMPLATE) -> Preprocessed:
    """All preprocess outputs from numbered lines ``(idx, line)``.

    Token lengths are counted on the P1 chat text, or on the plain P2 text
    when ``template`` is None (the reference's fallback without a template).

    With ``materialize`` the validated table is written once (parquet, shared
    checkpoint folder) and every output reads it; otherwise all outputs are
    lazy plans over the source.
    """
    spark = lines.sparkSession
    ensure_conf(spark)
    flat, scratch = V.validate_lines(lines, error_class=True), []
    if materialize:
        scratch.append(scratch_path(spark, "validated"))
        flat.write.parquet(scratch[0])
        flat = spark.read.parquet(scratch[0])
    return _outputs(flat, scratch, max_length, train_ratio, val_ratio, seed, template)


def _outputs(flat: DataFrame, scratch: list[str], max_length: int = P.DEFAULT_MAX_LENGTH, train_ratio: float = D.TRAIN_RATIO,
             val_ratio: float = D.VAL_RATIO, seed: int = D.DEFAULT_SEED, template: PR.ChatTemplate | None = PR.DEFAULT_TEMPLATE) -> Preprocessed:
    clean = V.clean_records(flat)
    reject_rows = V.rejects(flat)
    formatted = PR.profile_chat(clean, template) if template is not None else PR.plain_prompt(clean)
    profiled = P.token_lengths(formatted)
    ids = ["file", "rid"] if "file" in clean.columns else "rid"
    return Preprocessed(
        validated=flat, clean=clean, rejects=reject_rows, first_rejects=V.first_rejects(reject_rows),
        report=P.ingest_report(flat), domains=P.report_domains(flat), lengths=P.length_report(profiled, max_length=max_length),
        splits=D.three_way_split(clean, ids, train_ratio=train_ratio, val_ratio=val_ratio, seed=seed),
        split_sizes=D.split_sizes(clean, train_ratio, val_ratio), scratch=scratch,
    )


def validated_lines(scanned: DataFrame) -> DataFrame:
    """S1's strip, S2, V1 and V2 over scanned lines, blank ones kept (``blank``), so that the written result can be numbered."""
    lines = scanned.withColumn("line", strip("raw")).drop("raw").withColumn("blank", F.col("line") == "")
    return V.validate_lines(lines, error_class=True)


def numbered_validated(written: DataFrame) -> DataFrame:
    """The written table of :func:`validated_lines` with line numbers ``idx`` and without blank lines."""
    return number_written(written).where(~F.col("blank")).drop("blank")


def preprocess(spark: SparkSession, input_path: str, output_path: str | None = None, splits_path: str | None = None,
               **kwargs) -> Preprocessed:
    """The reference's preprocess stage over a JSONL file (or folder of files).

    Writes the clean rows (S6) and the splits (S7) when paths are given.  The
    files are scanned once: lines are parsed and validated as they are read,
    written, and numbered from the written table.  ``cleanup()`` of the result deletes that table.
    """
    ensure_conf(spark)
    path = scratch_path(spark, "validated")
    validated_lines(scan_lines(spark, input_path)).write.parquet(path)
    result = _outputs(numbered_validated(spark.read.parquet(path)), [path], **kwargs)
    if output_path:
        J.write_records(result.clean, output_path)
    if splits_path:
        J.write_splits(result.splits, splits_path)
    return result
