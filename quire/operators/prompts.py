"""Prompt formatting (P1-P5): native string expressions, row-local.

The reference renders chat messages through the model tokenizer's own
template, which is not part of the reference.  Here the template is a
parameter (:class:`ChatTemplate`); the default uses the header/footer
markers of the Llama-3 family, whose stop markers the reference names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import strip

# The reference's system prompts and plain formats.
PROFILE_SYSTEM_PROMPT = "You are a helpful assistant."
TRAIN_SYSTEM_PROMPT = "You are a helpful AI assistant. Answer questions accurately and concisely."
PLAIN_PREFIX_Q = "Q: "
PLAIN_PREFIX_A = "\nA: "
INFER_PREFIX = "<|user|>\n"
INFER_SUFFIX = "\n<|assistant|>\n"


@dataclass(frozen=True)
class ChatTemplate:
    """``begin`` + for each message ``role_open + role + role_close + content + end``."""

    begin: str = "<|begin_of_text|>"
    role_open: str = "<|start_header_id|>"
    role_close: str = "<|end_header_id|>\n\n"
    end: str = "<|eot_id|>"
    strip_content: bool = True

    def render_parts(self, parts: list[tuple[str, Column]], add_generation_prompt: bool = False) -> Column:
        """Render a fixed list of (role, content) messages with one flat ``concat`` (no lambda)."""
        pieces = [F.lit(self.begin)]
        for role, content in parts:
            pieces += [F.lit(self.role_open + role + self.role_close),
                       strip(content) if self.strip_content else content, F.lit(self.end)]
        if add_generation_prompt:
            pieces.append(F.lit(self.role_open + "assistant" + self.role_close))
        return F.concat(*pieces)

    def render(self, messages: Column, add_generation_prompt: bool = False) -> Column:
        """Render an ``array<struct<role, content>>`` column of any length."""
        def one(m: Column) -> Column:
            content = strip(m["content"]) if self.strip_content else m["content"]
            return F.concat(F.lit(self.role_open), m["role"], F.lit(self.role_close), content, F.lit(self.end))

        body = F.array_join(F.transform(messages, one), "")
        parts = [F.lit(self.begin), body]
        if add_generation_prompt:
            parts += [F.lit(self.role_open + "assistant" + self.role_close)]
        return F.concat(*parts)


DEFAULT_TEMPLATE = ChatTemplate()


def chat_messages(system: str, question: Column | str = "question", answer: Column | str = "answer") -> Column:
    """system + user + assistant messages as ``array<struct<role, content>>``."""
    q = F.col(question) if isinstance(question, str) else question
    a = F.col(answer) if isinstance(answer, str) else answer
    return F.array(
        F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")),
        F.struct(F.lit("user").alias("role"), q.alias("content")),
        F.struct(F.lit("assistant").alias("role"), a.alias("content")),
    )


def _parts(system: str) -> list[tuple[str, Column]]:
    return [("system", F.lit(system)), ("user", F.col("question")), ("assistant", F.col("answer"))]


def profile_chat(df: DataFrame, template: ChatTemplate = DEFAULT_TEMPLATE,
                 system: str = PROFILE_SYSTEM_PROMPT) -> DataFrame:
    """Messages used for token-length profiling, plus their rendered ``text``."""
    return df.withColumn("messages", chat_messages(system)).withColumn(
        "text", template.render_parts(_parts(system)))


def plain_prompt(df: DataFrame) -> DataFrame:
    """The template-free fallback ``Q: {q}\\nA: {a}``."""
    return df.withColumn("text", F.concat(F.lit(PLAIN_PREFIX_Q), F.col("question"),
                                          F.lit(PLAIN_PREFIX_A), F.col("answer")))


def train_chat(df: DataFrame, template: ChatTemplate = DEFAULT_TEMPLATE,
               system: str = TRAIN_SYSTEM_PROMPT) -> DataFrame:
    """Training text, another system prompt, no generation prompt."""
    return df.withColumn("messages", chat_messages(system)).withColumn(
        "text", template.render_parts(_parts(system), add_generation_prompt=False))


def inference_prompt(df: DataFrame, question_col: str = "question", out_col: str = "prompt") -> DataFrame:
    """``<|user|>\\n{q}\\n<|assistant|>\\n`` (no chat template)."""
    return df.withColumn(out_col, F.concat(F.lit(INFER_PREFIX), F.col(question_col), F.lit(INFER_SUFFIX)))


def strip_completion(c: Column | str) -> Column:
    """P5: a decoded completion, stripped."""
    return strip(c)
