"""Batch prediction over a table.

The reference loads a model and generates one answer per row.  Here the
predictor is pluggable: a zero-argument factory, called once per task on
the executor (so a model loads once per task, not per row), returns a
function from a pandas DataFrame batch (``rid``, ``question``, ``prompt``)
to a sequence of completions.  Batches arrive through Arrow
(``mapInPandas``); rows never pass through the driver.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.prompts import inference_prompt, strip_completion

Predictor = Callable[[pd.DataFrame], Sequence[str]]
PredictorFactory = Callable[[], Predictor]

_FIRST_SENTENCE = re.compile(r"[^.?!]*[.?!]?")


def first_sentence_predictor() -> Predictor:
    """A deterministic stand-in model: answers with the question's first sentence."""
    def predict(batch: pd.DataFrame) -> list[str]:
        return [_FIRST_SENTENCE.match(q).group(0) if isinstance(q, str) else None for q in batch["question"]]
    return predict


def _run(factory: PredictorFactory, label: str, batch_size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predictor = factory()
        for pdf in batches:
            for start in range(0, len(pdf), batch_size):
                chunk = pdf.iloc[start:start + batch_size]
                out = list(predictor(chunk.reset_index(drop=True)))
                if len(out) != len(chunk):
                    raise ValueError(f"predictor {label!r} returned {len(out)} rows for {len(chunk)}")
                yield pd.DataFrame({"rid": chunk["rid"].to_numpy(), "label": label,
                                    "completion": pd.Series(out, dtype="object")})
    return run


def predict(df: DataFrame, predictors: Mapping[str, PredictorFactory], id_col: str = "rid",
            question_col: str = "question", batch_size: int = 64) -> DataFrame:
    """``(rid, label, prediction)`` for every row and every labelled predictor.

    Prompts are P4; completions are stripped (P5) natively after the batch
    returns.  Each label is one ``mapInPandas`` over the same input.
    """
    base = inference_prompt(df.select(F.col(id_col).alias("rid"), F.col(question_col).alias("question")))
    outs = []
    for label, factory in predictors.items():
        outs.append(base.mapInPandas(_run(factory, label, batch_size),
                                     "rid long, label string, completion string"))
    result = outs[0]
    for o in outs[1:]:
        result = result.unionByName(o)
    return result.select("rid", "label", strip_completion("completion").alias("prediction"))
