"""Scoring predictions against references.

Plan shape: predictions are paired with references by a shuffle join on
``rid`` (E2).  Clipped n-gram matches and the longest common subsequence compare
the two texts of one row, so they are counted inside the row, in Arrow batches:
only rows are shuffled, never n-grams, and one pass gives all metrics.  Corpus
values are global aggregates per ``label`` (partial aggregation first, so a
label that holds most rows is no hotter than any other).

BLEU: corpus BLEU-4, no smoothing, 13a tokens, one reference per row.
ROUGE-1/2/L: F-measure per row, no stemming; the corpus value is the mean of
row values (the reference's library reports a bootstrap midpoint from an
unseeded generator, which estimates the same mean but cannot be reproduced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.lcs import count_matches
from quire.functions.numeric import py_round
from quire.functions.tokens import words_13a, words_rouge

BLEU_ORDER = 4        # fixed value: BLEU's default max n-gram order
ROUGE_ORDERS = (1, 2)  # fixed value: ROUGE-1 and ROUGE-2
METRICS = ("bleu", "rouge1", "rouge2", "rougeL")
REPORT_DIGITS = 4      # fixed value: the reference rounds metrics to 4 places
LABELS = ("base", "finetuned")


def pair_predictions(predictions: DataFrame, references: DataFrame, id_col: str = "rid",
                     reference_col: str = "answer", partitions: int | None = None) -> DataFrame:
    """``(label, rid, prediction, reference)``.

    The scoring behind it costs far more than its rows' bytes suggest, so rows
    are dealt to an explicit number of ``partitions`` (default:
    ``spark.sql.shuffle.partitions``), which Spark does not merge by bytes.
    """
    n = partitions or int(predictions.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    refs = references.select(F.col(id_col).alias("rid"), F.col(reference_col).alias("reference"))
    preds = predictions.select("label", F.col(id_col).alias("rid"), "prediction")
    return (preds.repartition(n, "rid").join(refs.repartition(n, "rid").hint("merge"), "rid")
            .select("label", "rid", "prediction", "reference"))


def pair_stored(predictions: DataFrame, references: DataFrame, id_col: str = "rid", reference_col: str = "answer") -> DataFrame:
    """E2 for tables bucketed by ``id_col`` into equally many buckets (:mod:`quire.sources.buckets`): no shuffle, one task a bucket."""
    refs = references.select(F.col(id_col).alias("rid"), F.col(reference_col).alias("reference"))
    preds = predictions.select("label", F.col(id_col).alias("rid"), "prediction")
    return preds.join(refs.hint("merge"), "rid").select("label", "rid", "prediction", "reference")


_BLEU_KINDS = list(range(1, BLEU_ORDER + 1))


def row_scores(pairs: DataFrame, bleu: bool = True, rouge: bool = True, lcs: bool = True) -> DataFrame:
    """Per-row counts: ``(label, rid, h1..h4, hr1, hr2, lcs, plen_b, rlen_b, plen_r, rlen_r)``.

    ``h<n>`` are clipped BLEU n-gram matches, ``hr<n>`` clipped ROUGE-N
    matches, ``plen``/``rlen`` token counts (the unigram totals).  ``bleu``,
    ``rouge`` and ``lcs`` choose what is counted; the others are 0.  Rows of
    one reference that follow each other, as the pairing leaves them, share its tokens.
    """
    tokenizers = ({"b": words_13a} if bleu else {}) | ({"r": words_rouge} if rouge or lcs else {})
    grams = ({"b": [f"h{n}" for n in _BLEU_KINDS]} if bleu else {}) | ({"r": [f"hr{n}" for n in ROUGE_ORDERS]} if rouge else {})
    counted = count_matches(pairs, ["label", "rid"], ("prediction", "reference"), tokenizers, grams, {"lcs": "r"} if lcs else {})
    sizes = {"plen_b": "n_left_b", "rlen_b": "n_right_b", "plen_r": "n_left_r", "rlen_r": "n_right_r"}
    zero = F.lit(0).cast("long")
    values = [f"h{n}" for n in _BLEU_KINDS] + [f"hr{n}" for n in ROUGE_ORDERS] + ["lcs"]
    return counted.select(
        "label", "rid", *[F.col(v) if v in counted.columns else zero.alias(v) for v in values],
        *[(F.col(c) if c in counted.columns else zero).alias(n) for n, c in sizes.items()])


def _div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a.cast("double") / b)


def _fmeasure(hits: Column, pred_count: Column, ref_count: Column) -> Column:
    p = hits.cast("double") / F.greatest(pred_count, F.lit(1))
    r = hits.cast("double") / F.greatest(ref_count, F.lit(1))
    return F.when(p + r > 0, F.lit(2.0) * p * r / (p + r)).otherwise(F.lit(0.0))


def _rouge_n_f(n: int) -> Column:
    return _fmeasure(F.col(f"hr{n}"), F.greatest(F.col("plen_r") - n + 1, F.lit(0)),
                     F.greatest(F.col("rlen_r") - n + 1, F.lit(0)))


def _rouge_l_f() -> Column:
    plen, rlen = F.col("plen_r"), F.col("rlen_r")
    return F.when((plen == 0) | (rlen == 0), F.lit(0.0)).otherwise(_fmeasure(F.col("lcs"), plen, rlen))


def rouge_f() -> dict[str, Column]:
    """F-measure of a row by metric, from the counts of :func:`row_scores`."""
    return {**{f"rouge{n}": _rouge_n_f(n) for n in ROUGE_ORDERS}, "rougeL": _rouge_l_f()}


def corpus_scores(rows: DataFrame) -> DataFrame:
    """Per-label totals from :func:`row_scores`: BLEU parts and mean ROUGE F (one partial aggregate)."""
    aggs = []
    for n in _BLEU_KINDS:
        aggs.append(F.sum(f"h{n}").cast("long").alias(f"m{n}"))
        aggs.append(F.sum(F.greatest(F.col("plen_b") - n + 1, F.lit(0))).cast("long").alias(f"t{n}"))
    aggs += [F.sum("plen_b").cast("long").alias("pred_len"), F.sum("rlen_b").cast("long").alias("ref_len")]
    aggs += [F.avg(f).alias(name) for name, f in rouge_f().items()]
    return rows.groupBy("label").agg(*aggs)


def with_bleu(totals: DataFrame) -> DataFrame:
    """Adds ``bleu`` and ``brevity_penalty`` to per-label totals."""
    prec = [F.coalesce(_div(F.col(f"m{n}"), F.col(f"t{n}")), F.lit(0.0)) for n in _BLEU_KINDS]
    log_sum = None
    for p in prec:
        term = F.lit(1.0 / BLEU_ORDER) * F.log(p)
        log_sum = term if log_sum is None else log_sum + term
    all_pos = F.lit(True)
    for p in prec:
        all_pos = all_pos & (p > 0)
    geo = F.when(all_pos, F.exp(log_sum)).otherwise(F.lit(0.0))
    c, r = F.col("pred_len"), F.col("ref_len")
    ratio = _div(c, r)
    # ratio > 1 -> 1; else exp(1 - 1/ratio).  No prediction tokens -> 0 (the
    # reference's library divides by zero there).
    bp = F.when(c > r, F.lit(1.0)).when(c > 0, F.exp(F.lit(1.0) - F.lit(1.0) / ratio)).otherwise(F.lit(0.0))
    return totals.withColumn("brevity_penalty", bp).withColumn("bleu", geo * bp)


def bleu(pairs: DataFrame) -> DataFrame:
    """Corpus BLEU per label with its parts (matches, totals, lengths, brevity)."""
    t = with_bleu(corpus_scores(row_scores(pairs, rouge=False, lcs=False)))
    return t.select("label", "bleu", "brevity_penalty", *[f"m{n}" for n in _BLEU_KINDS],
                    *[f"t{n}" for n in _BLEU_KINDS], "pred_len", "ref_len")


def rouge_n(pairs: DataFrame) -> DataFrame:
    """Mean ROUGE-1 and ROUGE-2 F-measure per label."""
    return corpus_scores(row_scores(pairs, bleu=False, lcs=False)).select("label", *[f"rouge{n}" for n in ROUGE_ORDERS])


def rouge_l(pairs: DataFrame) -> DataFrame:
    """E5: mean ROUGE-L F-measure per label."""
    return corpus_scores(row_scores(pairs, bleu=False, rouge=False)).select("label", "rougeL")


def metric_table(pairs: DataFrame, lcs: bool = True) -> DataFrame:
    """``(label, bleu, rouge1, rouge2, rougeL)`` rounded to 4 places as Python rounds, plus ``*_raw``; one pass over the pairs.

    Without ``lcs``, the dearest part on long texts, ``rougeL`` is 0.
    """
    raw = with_bleu(corpus_scores(row_scores(pairs, lcs=lcs)))
    return raw.select("label", *[py_round(F.col(m), REPORT_DIGITS).alias(m) for m in METRICS],
                      *[F.col(m).alias(f"{m}_raw") for m in METRICS])


def metrics_long(table: DataFrame) -> DataFrame:
    """E6 as ``(label, metric, value)`` rows (rounded values)."""
    stack = F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                               for m in METRICS]))
    return table.select("label", stack)


def compare(table: DataFrame, base: str = LABELS[0], tuned: str = LABELS[1]) -> DataFrame:
    """``(metric, base, finetuned, delta)``; delta of the rounded values, rounded again."""
    wide = metrics_long(table).groupBy("metric").pivot("label", [base, tuned]).agg(F.first("value"))
    return wide.select("metric", F.col(base).alias("base"), F.col(tuned).alias("finetuned"),
                       py_round(F.col(tuned) - F.col(base), REPORT_DIGITS).alias("delta"))
