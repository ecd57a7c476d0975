"""Q&A inputs derived from the shared test tables (FIXTURES.md F2-F5).

The reference reads a JSONL file of question/answer records.  The test
tables hold no such file, so these adapters derive one from the tables with
Spark, so that every query's work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.position import dense_index

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

# Fixed values of the derived fixtures (FIXTURES.md).
TURN_STRIDE = 1000         # rid = conv_id * 1000 + turn
DEFECT_MOD = 11            # defect class = rid % 11
FIXTURE_KEEP = "[^A-Za-z0-9 .,?]"
PRED_DROP_EVERY = {"base": 2, "finetuned": 5}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def qa_pairs(conversations: DataFrame) -> DataFrame:
    """a user turn directly followed by an assistant turn -> ``(rid, question, answer)``.

    An equi-join on (conv_id, turn) rather than a window over the
    conversation: the composite key spreads even a conversation holding a
    third of all turns over every partition.  Role filters reach the scan.
    """
    user = conversations.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    nxt = conversations.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return user.join(nxt, ["conv_id", "turn"]).select(
        (F.col("conv_id") * TURN_STRIDE + F.col("turn")).alias("rid"), "question", "answer")


def qa_from_documents(documents: DataFrame) -> DataFrame:
    """``rid = doc_id``, question = first line, answer = the rest, domain = source."""
    t = F.col("text")
    nl = F.instr(t, "\n")
    return documents.select(
        F.col("doc_id").alias("rid"),
        F.when(nl > 0, F.substring(t, F.lit(1), nl - 1)).otherwise(t).alias("question"),
        F.when(nl > 0, F.expr("substring(text, instr(text, '\n') + 1)")).otherwise(F.lit("")).alias("answer"),
        F.col("source").alias("domain"),
    )


def _safe(c):
    return F.regexp_replace(c, FIXTURE_KEEP, " ")


def _line(q, a, domain):
    """``{"question": q, "answer": a, "domain": d}`` with a chosen subset of keys."""
    parts = []
    if q is not None:
        parts.append(F.concat(F.lit('"question": "'), q, F.lit('"')))
    if a is not None:
        parts.append(F.concat(F.lit('"answer": "'), a, F.lit('"')))
    if domain is not None:
        parts.append(F.concat(F.lit('"domain": '), domain))
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def defective_lines(pairs: DataFrame) -> DataFrame:
    """one JSONL line per pair with a defect chosen by ``rid % 11``, numbered in ``rid`` order.

    ``idx`` is the dense rank by ``rid`` (the line's index in the file).  Only
    the ids are ranked; the rank is joined to the texts by ``rid``.
    """
    q, a = _safe(F.col("question")), _safe(F.col("answer"))
    dom = F.concat(F.lit('"d'), (F.floor(F.col("rid") / TURN_STRIDE) % 3).cast("string"), F.lit('"'))
    good = _line(q, a, dom)
    k = F.col("rid") % DEFECT_MOD
    line = (F.when(k == 0, F.expr("substring(_good, 1, length(_good) - 1)"))
            .when(k == 1, _line(F.lit("   "), a, dom))
            .when(k == 2, _line(q, None, dom))
            .when(k == 3, _line(F.lit("why?"), a, dom))
            .when(k == 4, _line(q, F.lit("yes"), dom))
            .when(k == 5, F.concat(F.col("_good"), F.lit(" xyz")))
            .when(k == 6, _line(q, a, None))
            .when(k == 7, _line(q, a, F.lit("null")))
            .when(k == 8, _line(F.lit("  a  "), a, dom))
            .when(k == 9, F.lit(""))
            .otherwise(_line(F.concat(F.lit("  "), q, F.lit("  ")), F.concat(F.lit("  "), a, F.lit("  ")), dom)))
    lines = pairs.withColumn("_good", good).select("rid", line.alias("raw"))
    return lines.join(dense_index(pairs.select("rid"), "rid"), "rid").select("idx", "raw")


def predictions_fixture(pairs: DataFrame) -> DataFrame:
    """``(rid, label, prediction, reference)`` - two synthetic models per pair.

    Drop every k-th word of the answer (k = 2 for ``base``, 5 for
    ``finetuned``); for odd ``conv_id`` rotate the kept words by half, so
    that word order (ROUGE-L) differs from word overlap (ROUGE-1).
    """
    words = F.split(F.col("answer"), " ")
    odd = (F.floor(F.col("rid") / TURN_STRIDE) % 2) == 1
    outs = []
    for label, k in PRED_DROP_EVERY.items():
        kept = F.filter(words, lambda w, i: (i % k) != (k - 1))
        h = F.floor(F.size(kept) / 2).cast("int")
        rotated = F.concat(F.slice(kept, h + 1, F.size(kept) - h), F.slice(kept, F.lit(1), h))
        pred = F.array_join(F.when(odd, rotated).otherwise(kept), " ")
        outs.append(pairs.select("rid", F.lit(label).alias("label"), pred.alias("prediction"),
                                 F.col("answer").alias("reference")))
    return outs[0].unionByName(outs[1])


def load_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa_pairs(table(spark, sf_dir, "conversations"))


def load_doc_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa_from_documents(table(spark, sf_dir, "documents"))
