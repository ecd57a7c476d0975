"""Training-data plan: load (or generate) the dataset, split train/val, format
training text; plus the post-training check on the validation head.

Training itself (GPU, adapters) is outside this library; its inputs and its
evaluation are tables.  Note the reference re-splits the whole clean file
here while evaluation reads the earlier test split, so test rows can leak
into training; pass the ``train`` split of :mod:`quire.plans.preprocess` as
``dataset`` to avoid that.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import prompts as PR
from quire.operators import split as D
from quire.operators.predict import PredictorFactory
from quire.plans.evaluate import Evaluation, evaluate_rows
from quire.sources import jsonl as J


@dataclass
class TrainingData:
    train: DataFrame  # (rid, question, answer, domain, pos, text)
    val: DataFrame


def training_tables(dataset: DataFrame, val_split: float = D.TEST_SIZE, seed: int = D.DEFAULT_SEED,
                    template: PR.ChatTemplate = PR.DEFAULT_TEMPLATE) -> TrainingData:
    """D4 then P3 on both sides."""
    ids = ["file", "rid"] if "file" in dataset.columns else "rid"
    split = D.train_val_split(dataset, ids, test_size=val_split, seed=seed)
    text = PR.train_chat(split, template).drop("messages")
    return TrainingData(train=text.where(F.col("split") == "train").drop("split"),
                        val=text.where(F.col("split") == "val").drop("split"))


def load_training_data(spark: SparkSession, dataset_path: str, **kwargs) -> TrainingData:
    """S5 -> D4 -> P3: the reference's data preparation for training."""
    return training_tables(J.load_or_sample(spark, dataset_path), **kwargs)


def validation_check(data: TrainingData, predictor: PredictorFactory, label: str = "finetuned",
                     n_samples: int = D.TRAIN_EVAL_SAMPLES) -> Evaluation:
    """Post-training scores on the first 50 validation rows (one label)."""
    preds: Mapping[str, PredictorFactory] = {label: predictor}
    return evaluate_rows(data.val, preds, n_samples)
