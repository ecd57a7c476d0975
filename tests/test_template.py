"""The model's own chat template: published shapes, golden rows, and what is not understood."""

import json

import pytest
from pyspark.sql import functions as F

from quire.functions.template import ModelTemplate, TemplateError
from quire.operators import prompts as PR
from tests_support import plan_text

# Three shapes that public models carry in their configuration (fixed values).
MARKED = ("{% for message in messages %}{{'<|im_start|>' + message['role'] + '\\n' + message['content'] + '<|im_end|>' + '\\n'}}{% endfor %}"
          "{% if add_generation_prompt %}{{ '<|im_start|>assistant\\n' }}{% endif %}")
HEADED = ("{% set loop_messages = messages %}{% for message in loop_messages %}{% set content = '<|start_header_id|>' + message['role'] + "
          "'<|end_header_id|>\\n\\n'+ message['content'] | trim + '<|eot_id|>' %}{% if loop.index0 == 0 %}{% set content = bos_token + content %}"
          "{% endif %}{{ content }}{% endfor %}{% if add_generation_prompt %}{{ '<|start_header_id|>assistant<|end_header_id|>\\n\\n' }}{% endif %}")
TAGGED = """{% for message in messages %}
{% if message['role'] == 'user' %}
{{ '<|user|>\\n' + message['content'] + eos_token }}
{% elif message['role'] == 'system' %}
{{ '<|system|>\\n' + message['content'] + eos_token }}
{% elif message['role'] == 'assistant' %}
{{ '<|assistant|>\\n'  + message['content'] + eos_token }}
{% endif %}
{% if loop.last and add_generation_prompt %}
{{ '<|assistant|>' }}
{% endif %}
{% endfor %}"""
BRACKETS = ("{{ bos_token }}{% if messages[0]['role'] == 'system' %}{% set start = messages[0]['content'].strip() + '\\n\\n' %}{% set rest = messages[1:] %}"
            "{% else %}{% set start = '' %}{% set rest = messages %}{% endif %}{% for m in rest %}{% if (m.role == 'user') != (loop.index0 % 2 == 0) %}"
            "{{ raise_exception('roles must alternate') }}{% endif %}{% if m.role == 'user' %}{{ '[INST] ' + (start if false else '') }}{% endif %}{% endfor %}")
NAMES = {"bos_token": "<s>", "eos_token": "</s>"}


def rendered(spark, source, roles=("system", "user", "assistant"), generation=False, q=" q? ", **names):
    df = spark.createDataFrame([(" s\n", q, "a!")], "s string, q string, a string")
    parts = list(zip(roles, [F.col("s"), F.col("q"), F.col("a")]))
    return df.select(ModelTemplate(source, {**NAMES, **names}).render_parts(parts, generation).alias("t")).first().t


def test_marked_messages(spark):
    assert rendered(spark, MARKED, generation=True) == (
        "<|im_start|>system\n s\n<|im_end|>\n<|im_start|>user\n q? <|im_end|>\n<|im_start|>assistant\na!<|im_end|>\n<|im_start|>assistant\n")


def test_headed_messages_equal_the_default_template(spark):
    df = spark.createDataFrame([(" q é　", "\na! ")], "question string, answer string")
    ours = ModelTemplate(HEADED, {"bos_token": "<|begin_of_text|>"})
    for fn in (PR.profile_chat, PR.train_chat):
        assert fn(df, ours).first().text == fn(df).first().text
    assert rendered(spark, HEADED, generation=True).endswith("a!<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n")


def test_tagged_messages_and_line_ends(spark):
    assert rendered(spark, TAGGED) == "<|system|>\n s\n</s>\n<|user|>\n q? </s>\n<|assistant|>\na!</s>\n"
    assert rendered(spark, TAGGED, generation=True) == "<|system|>\n s\n</s>\n<|user|>\n q? </s>\n<|assistant|>\na!</s>\n<|assistant|>\n"
    assert rendered(spark, TAGGED, roles=("tool", "user", "assistant")).startswith("<|user|>")


@pytest.mark.parametrize(("source", "want"), [
    ("a {{- bos_token -}} b", "a<s>b"), ("x\n  {% if true %}\ny\n  {% endif %}\nz", "x\ny\nz"), ("x  {{ 1 }}  y", "x  1  y"), ("{# no #}\nx", "x"),
    ("{{ 'a|b' }}{{ '{%' }}", "a|b{%"), ("{% if x is defined %}1{% else %}2{% endif %}{% if bos_token is not defined %}3{% endif %}", "2"),
    ("{% for m in messages[1:] %}{{ loop.index }}{{ m.role }}{% if not loop.last %},{% endif %}{% endfor %}", "1user,2assistant"),
    ("{{ (messages[1]['content'] + '!') | trim }}", "q? !"), ("{% if 'sys' in messages[0].role and messages[-1].role != 'user' %}ok{% endif %}", "ok"),
    ("{% for m in messages %}{% set y = m.role %}{% endfor %}{{ y is defined }}", "False"), ("", "")])
def test_white_space_tests_and_names(spark, source, want):
    assert rendered(spark, source) == want


@pytest.mark.parametrize(("source", "says"), [
    ("{% if messages[0]['content'] == 'x' %}{% endif %}", "a test on a content"), ("{% macro x() %}", "statement not understood"),
    ("{% for m in messages %}", "no endfor"), ("{{ messages | length }}", "not understood"), ("{{ missing }}", "no value for missing"),
    ("{{ raise_exception('roles must alternate') }}", "roles must alternate"), ("{{ messages[0].content | upper }}", "not understood"),
    ("{{ open('x') }}", "not understood"), ("{{ a b }}", "expression not understood"), (BRACKETS, "not understood"), ("{% set x.y = 1 %}", "statement not")])
def test_anything_else_is_an_error(spark, source, says):
    with pytest.raises(TemplateError, match=says):
        rendered(spark, source)


def test_from_a_configuration():
    config = {"chat_template": HEADED, "bos_token": {"content": "<s>"}, "eos_token": "</s>", "pad_token": None, "model_max_length": 5}
    t = ModelTemplate.from_config(json.dumps(config))
    assert t.source == HEADED and t.names == {"bos_token": "<s>", "eos_token": "</s>"}
    with pytest.raises(TemplateError):
        ModelTemplate.from_config("{}")


def test_one_flat_concat(spark):
    df = spark.range(3).select(F.lit("q").alias("question"), F.col("id").cast("string").alias("answer"))
    plan = plan_text(PR.profile_chat(df, ModelTemplate(TAGGED, NAMES)).select("text"))
    assert "lambda" not in plan and "Python" not in plan and plan.count("concat(") <= 2 and "WholeStageCodegen" in plan or "codegen id" in plan
    null = spark.createDataFrame([("q", None)], "question string, answer string")
    assert PR.profile_chat(null, ModelTemplate(TAGGED, NAMES)).first().text is None
