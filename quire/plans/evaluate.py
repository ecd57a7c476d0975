"""Evaluate plan: head sample of a test split -> batch predictions for each
labelled predictor -> BLEU/ROUGE per label -> comparison table -> JSON.

All labels are scored in one plan grouped by ``label``; the comparison is a
pivot of the per-label table (one row per label).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import metrics as M
from quire.operators import split as D
from quire.operators.bootstrap import rouge_bootstrap
from quire.operators.predict import PredictorFactory, predict
from quire.sources import jsonl as J
from quire.sources.buckets import drop_buckets, one_task_a_bucket, write_buckets


@dataclass
class Evaluation:
    sample: DataFrame       # D5 rows scored
    predictions: DataFrame  # E1 (rid = stored position, label, prediction)
    pairs: DataFrame        # E2
    metrics: DataFrame      # E6
    comparison: DataFrame   # E7
    rouge_limits: DataFrame  # bootstrap of ROUGE: low, mid and high by label and metric
    scratch: list[str] = field(default_factory=list)  # names of tables written on the way

    def cleanup(self) -> None:
        """Deletes the written tables; the DataFrames above cannot be read after it."""
        for table in self.scratch:
            drop_buckets(self.sample.sparkSession, table)
        self.scratch.clear()


def evaluate_rows(test: DataFrame, predictors: Mapping[str, PredictorFactory], n_samples: int = D.EVAL_SAMPLES,
                  order_col: str = "pos", base: str = M.LABELS[0], tuned: str = M.LABELS[1],
                  materialize: bool = True, dense: bool = True) -> Evaluation:
    """Score ``predictors`` on the first ``n_samples`` rows of ``test`` (by ``order_col``).

    ``dense`` says that positions are consecutive, as those of a split are; the
    head is then a filter.

    With ``materialize`` the sample and the predictions are written once to the shared
    checkpoint folder and scored from there: model inference is the costly
    step, the scoring reads predictions in two branches, and a model need not
    be deterministic for a recomputed task to agree with the first run.  Both are
    bucketed by position, so the sample is shuffled once, when it is written, and
    pairing needs no shuffle.
    """
    sample = D.head_sample(test, n_samples, order_col, dense) if n_samples is not None else test
    # Rows are identified by their stored position: unique within a split
    # even when line numbers repeat across input files.
    keyed = sample.select(F.col(order_col).cast("long").alias("rid"), "question", "answer")
    scratch = []
    if materialize:
        spark = test.sparkSession
        parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        scratch.append(write_buckets(keyed, "rid", parts, "sample"))
        keyed = spark.table(scratch[0])
        with one_task_a_bucket(spark):
            scratch.append(write_buckets(predict(keyed, predictors), "rid", parts, "predictions", dealt=True))
        preds = spark.table(scratch[1])
        pairs = M.pair_stored(preds, keyed)
    else:
        preds = predict(keyed, predictors)
        pairs = M.pair_predictions(preds, keyed)
    table = M.metric_table(pairs)
    limits = rouge_bootstrap(M.row_scores(pairs, bleu=False))
    labels = list(predictors)
    comparison = M.compare(table, base, tuned) if base in labels and tuned in labels else None
    return Evaluation(sample=sample, predictions=preds, pairs=pairs, metrics=table, comparison=comparison,
                      rouge_limits=limits, scratch=scratch)


def evaluate(spark: SparkSession, test_path: str, predictors: Mapping[str, PredictorFactory],
             n_samples: int = D.EVAL_SAMPLES, output_path: str | None = None) -> Evaluation:
    """The reference's evaluation stage over a test split written by S7 (or any JSONL with ``pos``)."""
    test = J.read_records(spark, test_path, J.SPLIT_SCHEMA)
    # Line numbers of files with blank lines, or a part of a split, have holes.
    span = test.agg(F.count("pos").alias("n"), (F.max("pos") - F.min("pos") + 1).alias("range")).first()
    result = evaluate_rows(test, predictors, n_samples, dense=span["n"] == span["range"])
    if output_path:
        J.write_metrics(result.metrics, output_path)
    return result
