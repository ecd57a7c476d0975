"""Ingest report and length profiling.

Every report is a one-row DataFrame.  All of them are computed from a
partial (map-side) aggregate, so a hot domain or a common length is merged
inside each task before anything is shuffled; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.subwords import MAX_PIECES, SubwordCounter
from quire.functions.text import word_count

DEFAULT_MAX_LENGTH = 512  # fixed value: the reference's token limit
DEFAULT_QUANTILE = 0.95   # fixed value: the reference's reported percentile


def _mean_len(c: Column) -> Column:
    """Mean rounded half to even, 0 when there are no rows (Python ``round``)."""
    return F.bround(F.coalesce(F.avg(c), F.lit(0.0)), 0).cast("long")


# -- A1-A4 ------------------------------------------------------------------

def ingest_counts(validated: DataFrame) -> DataFrame:
    """A1: ``total_raw`` (parsed), ``total_clean`` and ``dropped`` (invalid + unparsable)."""
    return validated.agg(
        F.count_if(F.col("parse_ok")).cast("long").alias("total_raw"),
        F.count_if(F.col("reason").isNull()).cast("long").alias("total_clean"),
        F.count_if(F.col("reason").isNotNull()).cast("long").alias("dropped"),
    )


def domain_histogram(clean: DataFrame, domain_col: str = "domain") -> DataFrame:
    """A2: rows per domain of the clean records (``domain`` may be NULL)."""
    return clean.groupBy(F.col(domain_col).alias("domain")).agg(F.count(F.lit(1)).alias("n"))


def mean_lengths(clean: DataFrame) -> DataFrame:
    """A3: mean character length of stripped question and answer."""
    return clean.agg(
        _mean_len(F.length("question")).alias("avg_question_len"),
        _mean_len(F.length("answer")).alias("avg_answer_len"),
    )


def per_domain_counts(flat: DataFrame) -> DataFrame:
    """One row per (valid, domain): parsed rows, rows, and summed stripped lengths.

    Partially aggregated in every task before the shuffle, so a domain that
    holds a third of all rows is no hotter than any other.
    """
    ok = F.col("reason").isNull()
    return flat.select(
        "parse_ok", ok.alias("ok"), F.when(ok, F.col("domain")).alias("domain"),
        F.when(ok, F.length("question")).alias("qlen"), F.when(ok, F.length("answer")).alias("alen"),
    ).groupBy("ok", "domain").agg(
        F.count_if("parse_ok").alias("raw"),
        F.count(F.lit(1)).alias("n"),
        F.sum("qlen").alias("sq"),
        F.sum("alen").alias("sa"),
    )


def ingest_report(flat: DataFrame) -> DataFrame:
    """A4: the report as one row: A1 counts, ``n_domains`` and A3 means, from one scan.

    ``flat`` is the output of ``validate_lines``.  The domain histogram that
    completes the reference's report is :func:`report_domains` (rows, not a
    list gathered into this row: the number of domains depends on the data).
    """
    per_domain = per_domain_counts(flat)
    n_clean = F.sum(F.when(F.col("ok"), F.col("n")).otherwise(0))

    def mean(total: Column) -> Column:
        return F.bround(F.coalesce(F.sum(total) / F.when(n_clean > 0, n_clean), F.lit(0.0)), 0).cast("long")

    return per_domain.agg(
        F.coalesce(F.sum("raw"), F.lit(0)).cast("long").alias("total_raw"),
        F.coalesce(n_clean, F.lit(0)).cast("long").alias("total_clean"),
        F.coalesce(F.sum(F.when(~F.col("ok"), F.col("n"))), F.lit(0)).cast("long").alias("dropped"),
        F.count_if(F.col("ok")).cast("long").alias("n_domains"),
        mean(F.col("sq")).alias("avg_question_len"),
        mean(F.col("sa")).alias("avg_answer_len"),
    )


def report_domains(flat: DataFrame) -> DataFrame:
    """A4's domain histogram ``(domain, n)`` (equal to A2 over the clean rows)."""
    return per_domain_counts(flat).where(F.col("ok")).select("domain", F.col("n").cast("long").alias("n"))


# -- T1-T4 ------------------------------------------------------------------

def token_lengths(df: DataFrame, text_col: str = "text", out_col: str = "n_tokens",
                  counter: Callable[[Column], Column] | None = None) -> DataFrame:
    """Token count per row.

    Default is the native word counter; pass ``counter`` (a Column -> Column
    function, e.g. :func:`tokenizer_counter`) for a subword tokenizer.
    """
    fn = counter or word_count
    return df.withColumn(out_col, fn(F.col(text_col)).cast("long"))


def tokenizer_counter(tokenizer_file: str, max_pieces: int = MAX_PIECES) -> Callable[[Column], Column]:
    """A T1 counter backed by a ``tokenizers`` JSON file.

    The file is read once per task by an iterator pandas UDF (Arrow batches);
    the file must be readable from every executor (a shared path).  Pieces of
    text are encoded once and their counts kept in a table of bounded size (:mod:`quire.functions.subwords`).
    """
    from pyspark.sql.functions import pandas_udf
    from pyspark.sql.types import LongType

    @pandas_udf(LongType())
    def count_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = SubwordCounter(tokenizer_file, max_pieces)
        for texts in batches:
            yield pd.Series(list(counter.counts(texts)), dtype="int64")

    return count_tokens


def flag_over_limit(df: DataFrame, max_length: int = DEFAULT_MAX_LENGTH, len_col: str = "n_tokens") -> DataFrame:
    """``over_limit`` is strictly ``length > max_length``."""
    return df.withColumn("over_limit", F.col(len_col) > F.lit(max_length))


def length_histogram(df: DataFrame, len_col: str = "n_tokens") -> DataFrame:
    """Rows per distinct length: partial aggregation, so its size is the number of distinct lengths."""
    return df.groupBy(F.col(len_col).alias("len")).agg(F.count(F.lit(1)).alias("c"))


def _with_ranks(hist: DataFrame) -> DataFrame:
    # One partition, but over distinct lengths only (bounded by the longest
    # text, not by the number of rows).
    ordered = Window.orderBy("len").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hist.withColumn("cum", F.sum("c").over(ordered)).withColumn(
        "total", F.sum("c").over(Window.partitionBy()))


def _order_stat(q: float) -> Column:
    """``sorted(x)[int(q*n)]``: the smallest length whose running count exceeds floor(q*n)."""
    k = F.floor(F.lit(float(q)) * F.col("total"))
    return F.min(F.when(F.col("cum") > k, F.col("len")))


def exact_quantile(df: DataFrame, len_col: str = "n_tokens", q: float = DEFAULT_QUANTILE,
                   out_col: str = "p95") -> DataFrame:
    """T4: the reference's order statistic, exactly (not ``percentile_disc``)."""
    ranked = _with_ranks(length_histogram(df, len_col))
    return ranked.agg(F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("n"),
                      _order_stat(q).cast("long").alias(out_col))


def length_report(df: DataFrame, len_col: str = "n_tokens", max_length: int = DEFAULT_MAX_LENGTH,
                  q: float = DEFAULT_QUANTILE) -> DataFrame:
    """N, mean, max, p95, over-limit count and percent, from one histogram.

    On no rows: n = 0, n_over = 0 and NULL for the rest (the reference divides by zero).
    """
    ranked = _with_ranks(length_histogram(df, len_col))
    n = F.sum("c")
    n_over = F.coalesce(F.sum(F.when(F.col("len") > F.lit(max_length), F.col("c"))), F.lit(0))
    return ranked.agg(
        F.coalesce(n, F.lit(0)).cast("long").alias("n"),
        (F.sum(F.col("len") * F.col("c")) / n).alias("mean_tokens"),
        F.max("len").cast("long").alias("max_tokens"),
        _order_stat(q).cast("long").alias("p95_tokens"),
        n_over.cast("long").alias("n_over"),
        (F.lit(100.0) * n_over / n).alias("pct_over"),
    )
