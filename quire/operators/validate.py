"""Parse, validate, clean and route rejects.

Input is a numbered-line DataFrame ``(idx long, line string)`` whose lines are
already stripped and non-blank (see ``quire.sources.lines``).  Every step is
a native expression over that row, so the whole chain is one narrow stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.jsonl import fields, parse_error_class, parse_parts, parts_ok, parts_value, variant_is_string, variant_text
from quire.functions.text import strip
from quire.session import ensure_conf

# Reject reasons and length limits of the reference validator.
# Rules apply in this order and the first failing one wins.
MISSING_QUESTION = "missing or empty 'question'"
MISSING_ANSWER = "missing or empty 'answer'"
SHORT_QUESTION = "question too short"
SHORT_ANSWER = "answer too short"
MIN_QUESTION_LEN = 5
MIN_ANSWER_LEN = 10
DEFAULT_DOMAIN = "general"
# Ours: the reference stops on these instead of reporting them.
PARSE_ERROR = "JSON parse error"
BAD_TYPE_QUESTION = "bad type for 'question'"
BAD_TYPE_ANSWER = "bad type for 'answer'"

FIELDS = ["question", "answer", "domain"]


def evaluate_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with ``value`` as a new column that is computed once a row, however often it is used.

    The optimizer puts the expression of a column into every place that names
    it, and moves filters on it below the projection.  It does neither through
    a generator, so the value is the only element of an exploded array.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def parse_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Strict parse.  Adds ``parse_ok`` and ``rec`` (question/answer/domain as variants)."""
    ensure_conf(lines.sparkSession)
    parts = evaluate_once(lines, "_parts", parse_parts(line_col))
    checked = evaluate_once(parts, "_ok", parts_ok(F.col("_parts")))
    read = evaluate_once(checked, "rec", F.when(F.col("_ok"), fields(parts_value(F.col("_parts")), FIELDS)))
    return read.withColumn("parse_ok", F.col("_ok")).select(*lines.columns, "parse_ok", "rec")


def reason_expr(rec: Column, parse_ok: Column,
                min_question_len: int = MIN_QUESTION_LEN, min_answer_len: int = MIN_ANSWER_LEN) -> Column:
    """V1: the first failing rule, or NULL for a valid record.

    Lengths are checked on the raw text, emptiness on the stripped text.
    A top-level value that is not an object has no ``question`` key.
    """
    q, a = rec["question"], rec["answer"]
    q_text, a_text = variant_text(q), variant_text(a)
    return (
        F.when(~parse_ok, F.lit(PARSE_ERROR))
        .when(q.isNull(), F.lit(MISSING_QUESTION))
        .when(~variant_is_string(q), F.lit(BAD_TYPE_QUESTION))
        .when(strip(q_text) == "", F.lit(MISSING_QUESTION))
        .when(a.isNull(), F.lit(MISSING_ANSWER))
        .when(~variant_is_string(a), F.lit(BAD_TYPE_ANSWER))
        .when(strip(a_text) == "", F.lit(MISSING_ANSWER))
        .when(F.length(q_text) < min_question_len, F.lit(SHORT_QUESTION))
        .when(F.length(a_text) < min_answer_len, F.lit(SHORT_ANSWER))
    )


def record_reason(question: Column, answer: Column, min_question_len: int = MIN_QUESTION_LEN,
                  min_answer_len: int = MIN_ANSWER_LEN) -> Column:
    """V1 for rows that are already typed (string columns): same rules, same order."""
    return (
        F.when(question.isNull() | (strip(question) == ""), F.lit(MISSING_QUESTION))
        .when(answer.isNull() | (strip(answer) == ""), F.lit(MISSING_ANSWER))
        .when(F.length(question) < min_question_len, F.lit(SHORT_QUESTION))
        .when(F.length(answer) < min_answer_len, F.lit(SHORT_ANSWER))
    )


def validate_records(df: DataFrame, **limits) -> DataFrame:
    """V1 + V2 over a typed table ``(rid, question, answer[, domain])``: adds ``reason``;
    valid rows get stripped texts."""
    reason = record_reason(F.col("question"), F.col("answer"), **limits)
    ok = reason.isNull()
    return df.withColumn("reason", reason).withColumn(
        "question", F.when(ok, strip("question")).otherwise(F.col("question"))).withColumn(
        "answer", F.when(ok, strip("answer")).otherwise(F.col("answer")))


def validate(parsed: DataFrame, **limits) -> DataFrame:
    """V1: adds ``reason`` (NULL = valid) to the output of :func:`parse_lines`."""
    return evaluate_once(parsed, "reason", reason_expr(F.col("rec"), F.col("parse_ok"), **limits))


def clean_projection(rec: Column) -> list[Column]:
    """V2: stripped texts; ``domain`` defaults only when the key is absent."""
    d = rec["domain"]
    return [
        strip(variant_text(rec["question"])).alias("question"),
        strip(variant_text(rec["answer"])).alias("answer"),
        F.when(d.isNull(), F.lit(DEFAULT_DOMAIN)).otherwise(variant_text(d)).alias("domain"),
    ]


def flatten(validated: DataFrame, keep_line: bool = False) -> DataFrame:
    """Drops the parsed record: ``question``/``answer``/``domain`` hold the V2 values for valid rows, NULL otherwise.

    The result has only plain columns, so it can be written to parquet.  The
    raw ``line`` is dropped unless ``keep_line`` (materialising it would write
    a second copy of the input).
    """
    ok = F.col("reason").isNull()
    q, a, d = clean_projection(F.col("rec"))
    kept = [c for c in validated.columns if c not in ("rec", "line")] + (["line"] if keep_line else [])
    return validated.select(*kept, F.when(ok, q).alias("question"), F.when(ok, a).alias("answer"),
                            F.when(ok, d).alias("domain"))


def validate_lines(lines: DataFrame, line_col: str = "line", keep_line: bool = False, error_class: bool = False, **limits) -> DataFrame:
    """S2 + V1 + V2: ``(idx, ..., parse_ok, reason, question, answer, domain)``; with ``error_class`` also ``parse_error``."""
    checked = validate(parse_lines(lines, line_col), **limits)
    if error_class:
        checked = checked.withColumn("parse_error", F.when(~F.col("parse_ok"), parse_error_class(line_col)))
    return flatten(checked, keep_line=keep_line)


def clean_records(flat: DataFrame, id_col: str = "idx") -> DataFrame:
    """V2: valid rows as ``(rid, question, answer, domain)``; ``rid`` is the line index.

    For input read from several files the ``file`` column is kept first:
    ``(file, rid)`` is then the row's identity.
    """
    keep = ["file"] if "file" in flat.columns else []
    return flat.where(F.col("reason").isNull()).select(*keep, F.col(id_col).alias("rid"), "question", "answer",
                                                        "domain")


def rejects(flat: DataFrame, id_col: str = "idx") -> DataFrame:
    """V3: rejected rows with the row-numbered message, and with their file where rows come from files.

    The message of a line that does not parse also names the class of its error, if ``flat`` has it (``parse_error``).
    """
    detail = F.when(F.col("parse_error").isNotNull(), F.concat(F.lit(" ("), F.col("parse_error"), F.lit(")"))) \
        if "parse_error" in flat.columns else F.lit(None).cast("string")
    return flat.where(F.col("reason").isNotNull()).select(
        *(["file"] if "file" in flat.columns else []), F.col(id_col).alias("idx"), "reason",
        F.concat(F.lit("Row "), F.col(id_col).cast("string"), F.lit(": "), F.col("reason"), F.coalesce(detail, F.lit(""))).alias("message"))


def first_rejects(reject_rows: DataFrame, n: int = 5) -> DataFrame:
    """V4: the first ``n`` rejects by file and line (a top-k, not a sort of all rows)."""
    return reject_rows.orderBy(*[c for c in ("file", "idx") if c in reject_rows.columns]).limit(n)
