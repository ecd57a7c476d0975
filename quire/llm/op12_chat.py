"""Chat formatting with typed content parts: one training text a conversation, its loss mask and its attachments.

A turn holds an array of parts (text, image, audio, document).  A visitor has
one case a type: a text part becomes its escaped text, any other part becomes
a placeholder ``<type turn.part>`` with its reference and the tokens it stands
for recorded.  Parts are joined by ``<&>``, so they can be told apart again.
A turn is written ``### role: body</turn>`` and a line end.

Escaping is reversible: every backslash in a text is doubled and a backslash
is put inside each control string, so no text can hold one; dropping the
backslash before any character gives the text back.

Everything is DataFrame functions.  Turns are shuffled once, by conversation,
and ordered by turn, role and content.  A running sum in that order gives each
turn's place, and the rows are collected without another shuffle.  As its
result is one text, a conversation must fit into a row.

Null conversation ids form a conversation of their own, null turns come first,
a null role or text counts as empty, rows that repeat are turns of their own, a
turn without parts has an empty body, and a part of an unknown or null type
counts as text.  No rows give no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import let, n_words
from quire.sources.tables import table

PARTS = "array<struct<type string, text string, ref string, width int, height int, seconds double, pages int>>"

OPEN, AFTER_ROLE, END, JOIN = "### ", ": ", "</turn>\n", "<&>"
ATTACHMENTS = ("image", "audio", "document")
# Control strings that a text may not hold, each with the place its backslash takes.
BROKEN = [("</turn>", "<\\/turn>"), (JOIN, "<\\&>"), ("##", "#\\#"), *[(f"<{kind} ", f"<\\{kind} ") for kind in ATTACHMENTS]]


@dataclass(frozen=True)
class Tokens:
    """Tokens that an attachment stands for: image patches, audio frames, pages."""

    patch: int = 14
    frames_a_second: float = 25.0
    a_page: int = 256


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for control, broken in BROKEN:
        out = F.replace(out, F.lit(control), F.lit(broken))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    """A role ends at the first ``: ``, so it may not hold one either."""
    return F.replace(escape(role), F.lit(AFTER_ROLE), F.lit(":\\ "))


def text_parts(text: Column) -> Column:
    """A plain text as an array of one text part."""
    absent = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *[F.lit(None).cast(t).alias(c) for c, t in absent.items()]))


def _visitor(tokens: Tokens, at: Column) -> dict[str, Callable[[Column, Column], tuple[Column, Column]]]:
    """By type: (part, its place) to (what stands in the text, the tokens it stands for)."""
    def placeholder(kind: str, i: Column) -> Column:
        return F.concat(F.lit(f"<{kind} "), at.cast("string"), F.lit("."), i.cast("string"), F.lit(">"))

    def known(n: Column) -> Column:
        return F.greatest(F.coalesce(n, F.lit(0)), F.lit(0)).cast("long")

    return {
        "image": lambda p, i: (placeholder("image", i), known(F.ceil(p["width"] / tokens.patch) * F.ceil(p["height"] / tokens.patch))),
        "audio": lambda p, i: (placeholder("audio", i), known(F.ceil(p["seconds"] * tokens.frames_a_second))),
        "document": lambda p, i: (placeholder("document", i), known(p["pages"] * tokens.a_page)),
        "text": lambda p, i: (escape(p["text"]), n_words(p["text"])),
    }


def visit(parts: Column, at: Column, tokens: Tokens) -> Column:
    """The parts in order as ``array<struct<body, kind, ref, tokens>>``; ``kind`` is null for text."""
    cases = _visitor(tokens, at)

    def one(p: Column, i: Column) -> Column:
        body, n = cases["text"](p, i)
        kind = F.lit(None).cast("string")
        for name in ATTACHMENTS:
            its_body, its_n = cases[name](p, i)
            hit = F.coalesce(p["type"] == name, F.lit(False))
            body, n, kind = F.when(hit, its_body).otherwise(body), F.when(hit, its_n).otherwise(n), F.when(hit, F.lit(name)).otherwise(kind)
        return F.struct(body.alias("body"), kind.alias("kind"), F.when(kind.isNotNull(), p["ref"]).alias("ref"), n.alias("tokens"))

    return F.transform(F.coalesce(parts, F.array().cast(PARTS)), one)


def format_chats(turns: DataFrame, trained_role: str = "assistant", tokens: Tokens | None = None) -> DataFrame:
    """``(conv_id, turn, role, parts)`` to a row a conversation.

    Returns ``conv_id, n_turns, formatted, n_tokens`` (words, and the tokens
    attachments stand for), ``turns`` and ``attachments``.  ``turns[i]`` has the
    code point at which turn i starts in ``formatted``, and where its part of
    the loss mask starts and how long it is: the body of turns of ``trained_role``,
    0 for others.  ``attachments`` has turn, part, kind, ref and tokens.
    """
    tokens = tokens or Tokens()
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.col("parts").cast(PARTS).alias("parts"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    placed = rows.withColumn("at", F.row_number().over(order) - 1)
    seen = placed.withColumn("seen", visit(F.col("parts"), F.col("at"), tokens))
    said = seen.select(
        "conv_id", "turn", "role", "parts", "at", "seen", F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit(AFTER_ROLE)).alias("head"),
        F.array_join(F.transform("seen", lambda p: p["body"]), JOIN).alias("body"))
    size = (F.length("head") + F.length("body") + len(END)).cast("long")
    start = F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    masked = said.withColumn("start", start).select(
        "conv_id", F.struct(
            "at", F.concat("head", "body", F.lit(END)).alias("said"), "start", (F.col("start") + F.length("head")).alias("loss_start"),
            F.when(F.col("role") == trained_role, F.length("body")).otherwise(0).cast("long").alias("loss_length"), "seen").alias("t"))
    return masked.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t")).select(
        "conv_id", F.size("t").cast("long").alias("n_turns"), F.array_join(F.transform("t", lambda t: t["said"]), "").alias("formatted"),
        F.aggregate("t", F.lit(0).cast("long"), lambda n, t: n + F.aggregate(t["seen"], F.lit(0).cast("long"), lambda m, p: m + p["tokens"])).alias("n_tokens"),
        F.transform("t", lambda t: F.struct(t["start"].alias("start"), t["loss_start"].alias("loss_start"), t["loss_length"].alias("loss_length"))).alias("turns"),
        F.flatten(F.transform("t", lambda t: F.filter(
            F.transform(t["seen"], lambda p, i: F.struct(t["at"].alias("turn"), i.alias("part"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens"))),
            lambda a: a["kind"].isNotNull()))).alias("attachments"))


def _texts(body: Column) -> Column:
    """The text of a body: its parts without placeholders, unescaped."""
    names = "|".join(ATTACHMENTS)
    parts = F.filter(F.split(body, JOIN), lambda p: ~p.rlike(rf"^<(?:{names}) \d+\.\d+>$"))
    return F.array_join(F.transform(parts, unescape), "")


def read_chats(chats: DataFrame) -> DataFrame:
    """``formatted`` and its mask read back: ``conv_id, read, n_chars``.

    ``read`` is ``array<struct<role, text, loss>>`` in the order of the turns:
    the text without placeholders, and the text under the turn's loss mask.
    ``n_chars`` is the number of code points of ``formatted``.
    """
    def read(said: Column, t: Column) -> Column:
        role = F.regexp_extract(said, f"(?s)^{OPEN}(.*?){AFTER_ROLE}", 1)
        body = F.substring(said, F.length(role) + (len(OPEN) + len(AFTER_ROLE) + 1), F.length(said))
        under = F.substring(said, (t["loss_start"] - t["start"] + 1).cast("int"), t["loss_length"].cast("int"))
        return F.struct(unescape(role).alias("role"), _texts(body).alias("text"), _texts(under).alias("loss"))

    said = F.split("formatted", END)
    return chats.select("conv_id", let(said, lambda s: F.zip_with(F.slice(s, F.lit(1), F.size("turns")), F.col("turns"), read)).alias("read"),
                        F.length("formatted").cast("long").alias("n_chars"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted, and read back from the formatted text and its mask."""
    hard = "\\### Assistant: </turn> ok"
    extra = spark.range(0, 2, 1, 1).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                           F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    read = read_chats(format_chats(rows.withColumn("parts", text_parts(F.col("text")))))
    said = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = read.select("conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.array_join(F.transform("read", lambda t: t["loss"]), "").alias("loss"), "n_chars")
    return loss.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), F.col("n_chars").alias("formatted_chars"))


# Formatted length: 6 for "### " and ": ", 8 for "</turn>" and a line end, and what escaping adds.
ORACLE = r"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (SELECT *, [length(x) + length(x) - length(replace(x, '\', '')) + length(replace(x, '##', '###')) - length(x)
    + (length(x) - length(replace(x, '</turn>', ''))) // 7 + (length(x) - length(replace(x, '<&>', ''))) // 3
    + (length(x) - length(replace(x, '<image ', ''))) // 7 + (length(x) - length(replace(x, '<audio ', ''))) // 7
    + (length(x) - length(replace(x, '<document ', ''))) // 10 FOR x IN [role, text]] AS n,
    (length(role) - length(replace(role, ': ', ''))) // 2 AS colons FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(sum(14 + n[1] + n[2] + colons) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
