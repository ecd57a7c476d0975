"""Inputs that the registered queries share, derived from the tables (FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import metrics as M
from quire.operators import validate as V
from quire.session import ensure_conf
from quire.sources import tables as T
from quire.sources.lines import content_lines


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """F2."""
    return T.load_pairs(spark, sf)


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """F3 as S1 would deliver it: ``(idx, line)``, stripped, blank lines dropped."""
    return content_lines(T.defective_lines(pairs(spark, sf)))


def validated(spark: SparkSession, sf: str) -> DataFrame:
    ensure_conf(spark)
    return V.validate_lines(lines(spark, sf))


def doc_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """F4."""
    return T.load_doc_pairs(spark, sf)


def doc_clean(spark: SparkSession, sf: str) -> DataFrame:
    """F4 validated as typed records; valid rows only, stripped."""
    return V.validate_records(doc_pairs(spark, sf)).where(F.col("reason").isNull()).drop("reason")


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """F5 predictions ``(label, rid, prediction)``."""
    return T.predictions_fixture(pairs(spark, sf)).select("label", "rid", "prediction")


def scored_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """E2 on F5."""
    return M.pair_predictions(predictions(spark, sf), pairs(spark, sf))
