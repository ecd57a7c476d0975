"""Bootstrap of corpus ROUGE (E4, E5) in one pass over the scored rows.

The reference's metric reports the middle of a bootstrap over rows: 1,000
samples with replacement, the mean of each, and of these the median and the
ends of the middle 95%.  A sample of exactly n rows needs all rows in one
place, so each row is drawn a Poisson(1) number of times in each replicate,
independently of the others (the limit of the same draw for many rows).  The
number is a hash of (row, replicate): it needs no generator state, so reruns
and other partitionings give the same result, and two labels are compared on
the same draws.

A task adds its rows to ``replicates`` sums for each label and hands on one
row for each; sums are of integers (F-measures in units of 1e-9), so their
order does not matter.  Nothing else is shuffled, and the result needs
``labels x replicates`` rows.

Rows with a null id draw as one id.  A replicate that draws no row at all
(likely for one or two rows only) is left out; where all are, and for no
rows, there is no result row for the label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.metrics import rouge_f

# Samples and confidence of the reference's metric.
REPLICATES = 1000
CONFIDENCE = 0.95
SEED = 42
SCALE = 1_000_000_000
# Chances of at most 0, 1, ... draws of a row, in units of 2**-32: a draw above entry k happens more than k times.
POISSON = [1580030168, 3160060337, 3950075421, 4213413783, 4279248373, 4292415291, 4294609777, 4294923276, 4294962463, 4294966817, 4294967252, 4294967292]
# Arithmetic is modulo 2**62; odd multipliers of 62 bits (fixed values of our own, see `draws`).
MASK = (1 << 62) - 1
STEP, FIRST, SECOND = 0x1E3779B97F4A7C15, 0x3F51AFD7ED558CCD, 0x04CEB9FE1A85EC53
ROUGE = ("rouge1", "rouge2", "rougeL")


def row_hash(id_col: Column, seed: int = SEED) -> Column:
    """60 bits of the md5 of an id and the seed."""
    key = F.concat_ws(":", F.coalesce(id_col.cast("string"), F.lit("")), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def draws(hashes: np.ndarray, replicates: np.ndarray) -> np.ndarray:
    """How often each row is drawn in each replicate: Poisson(1) by the top 32 of 62 mixed bits."""
    mask = np.uint64(MASK)
    x = (hashes.astype(np.uint64)[:, None] + replicates.astype(np.uint64)[None, :] * np.uint64(STEP)) & mask
    x ^= x >> np.uint64(31)
    x = (x * np.uint64(FIRST)) & mask
    x ^= x >> np.uint64(29)
    x = (x * np.uint64(SECOND)) & mask
    x ^= x >> np.uint64(31)
    return np.searchsorted(np.array(POISSON, np.uint64), x >> np.uint64(30), side="right")


def _sums(replicates: int, rows_at_once: int = 128):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, sums = np.arange(replicates), {}
        for batch in batches:
            labels = np.array(batch.column(0).to_pylist(), object)
            hashes = batch.column(1).to_numpy()
            values = np.stack([np.ones(len(batch), np.int64), *[batch.column(2 + i).to_numpy() for i in range(len(ROUGE))]])
            for label in dict.fromkeys(labels.tolist()):
                mine = np.flatnonzero(labels == label)
                total = sums.setdefault(label, np.zeros((len(values), replicates), np.int64))
                for at in range(0, len(mine), rows_at_once):
                    some = mine[at:at + rows_at_once]
                    total += values[:, some] @ draws(hashes[some], numbers)
        for label, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([label] * replicates, pa.string()), pa.array(numbers, pa.int32()), *[pa.array(t) for t in total]],
                                             ["label", "replicate", "n", *ROUGE])

    return run


def rouge_replicates(rows: DataFrame, replicates: int = REPLICATES, seed: int = SEED, id_col: str = "rid") -> DataFrame:
    """``(label, replicate, rouge1, rouge2, rougeL)``: the means of each replicate, from :func:`quire.operators.metrics.row_scores`."""
    scaled = [F.floor(f * SCALE + 0.5).cast("long").alias(name) for name, f in rouge_f().items()]
    added = rows.select("label", row_hash(F.col(id_col), seed).alias("_h"), *scaled).mapInArrow(
        _sums(replicates), "label string, replicate int, n bigint, " + ", ".join(f"{m} bigint" for m in ROUGE))
    total = added.groupBy("label", "replicate").agg(*[F.sum(F.col(c).cast("decimal(20,0)")).cast("double").alias(c) for c in ("n", *ROUGE)])
    return total.where("n > 0").select("label", "replicate", *[(F.col(m) / F.col("n") / SCALE).alias(m) for m in ROUGE])


def rouge_bootstrap(rows: DataFrame, replicates: int = REPLICATES, confidence: float = CONFIDENCE, seed: int = SEED, id_col: str = "rid") -> DataFrame:
    """``(label, metric, low, mid, high)``: median and confidence limits of the replicates' means, linear between two of them."""
    tail = (1 - confidence) / 2
    at = F.array(F.lit(tail), F.lit(0.5), F.lit(1 - tail))
    means = rouge_replicates(rows, replicates, seed, id_col)
    limits = means.groupBy("label").agg(*[F.percentile(m, at).alias(m) for m in ROUGE])
    entries = F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("at")) for m in ROUGE]))
    return limits.select("label", entries).select("label", "metric", *[F.col("at")[i].alias(n) for i, n in enumerate(("low", "mid", "high"))])
