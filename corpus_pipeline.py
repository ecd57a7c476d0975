"""A training corpus from ``documents``: good documents, once each, without repeated passages, mixed by source, packed.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All but the
last keep the columns of ``documents``, and other columns that ``docs`` may have, whatever their names.

Nulls, empty and long texts, ties, repeats and empty tables: a text that is null, empty or
under 20 words ends at the first stage, and texts of any length are taken whole.
A null language or source is a group of its own.  Rows that repeat are documents
of their own until near-dedup keeps one of each group (the smallest id; a null id
is larger than any; of rows that share it, one).  A text that the third stage leaves empty is mixed
at no copy.  Empty tables pass through all stages and give no rows.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from quire.llm import op1_mixing, op4_packing, op5_simhash, op7_quality, op10_suffix  # noqa: E402
from quire.llm.common import remove  # noqa: E402
from quire.session import scratch_path  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the adaptive limits of their language and source keep; equal rows go or stay together."""
    return op7_quality.keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of SimHash neighbours.  Texts without words are one group."""
    return op5_simhash.keep_one(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of strings of 100 bytes that start earlier in what the stage before kept.  Null texts stay null."""
    return op10_suffix.cut_texts(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document, whole, as often as the mix takes it: not at all, once or twice; without words, not at all."""
    return op1_mixing.repeat(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2,048 tokens that hold every source's share.  Null ids are kept."""
    import public_tokenizers

    return op4_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("mix_sources", mix_sources),
    ("packing", packing),
]

# Fingerprints, tokenizers and Newton's method are beyond SQL; tests hold each stage against a brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  What the stages write between them lies under ``spark.checkpoint.dir`` and is deleted at the
    end: packing has read its input into a checkpoint by then."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_path(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(f"{base}/{i}-{name}")
            docs = spark.read.parquet(f"{base}/{i}-{name}")
    remove(spark, base)
    return docs
