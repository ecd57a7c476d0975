"""Bucketed tables and pairing without a shuffle."""

import os

from pyspark.sql import functions as F

from quire.operators import metrics as M
from quire.plans import queries as Q
from quire.plans.evaluate import evaluate_rows
from quire.operators.predict import first_sentence_predictor
from quire.sources.buckets import drop_buckets, table_path, write_buckets
from tests_support import plan_text

SF = "/root/testdata/sf0.01"


def test_stored_pairs_need_no_exchange(spark):
    df = Q.e2_stored_pairs(spark, SF)
    assert "Exchange" not in plan_text(df) and "SortMergeJoin" in plan_text(df)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, Q.e2_pairs(spark, SF).collect()))


def test_a_bucket_is_one_file(spark):
    df = spark.range(1000).select((F.col("id") % 700).alias("rid"), F.lit("x").alias("text"))
    table = write_buckets(df, "rid", 5)
    files = [f for f in os.listdir(table_path(spark, table).removeprefix("file:")) if f.endswith(".parquet")]
    assert len(files) == 5 and spark.table(table).count() == 1000
    path = table_path(spark, table).removeprefix("file:")
    drop_buckets(spark, table)
    assert not os.path.exists(path) and not spark.catalog.tableExists(table)


def test_evaluation_pairs_without_a_shuffle(spark):
    test = Q.pairs(spark, SF).withColumn("pos", F.row_number().over(Q.D.Window.orderBy("rid")) - 1)
    ev = evaluate_rows(test, {"base": first_sentence_predictor, "finetuned": first_sentence_predictor}, n_samples=60)
    assert "Exchange" not in plan_text(ev.pairs)
    assert ev.pairs.count() == 120 and ev.sample.count() == 60
    again = M.pair_predictions(ev.predictions, ev.sample.select(F.col("pos").alias("rid"), "answer"))
    assert sorted(map(tuple, ev.pairs.collect())) == sorted(map(tuple, again.collect()))
    assert ev.rouge_limits.count() == 6
    tables = list(ev.scratch)
    ev.cleanup()
    assert not any(spark.catalog.tableExists(t) for t in tables)
