from pyspark.sql import functions as F

from quire.functions import text as X
from tests_support import col_values

import pyref


def test_ws_set_is_pythons():
    assert len(X.WS) == 29
    assert " " in X.WS and "　" in X.WS and "\x1c" in X.WS
    assert "​" not in X.WS


def test_strip_matches_python(spark):
    samples = ["  a  ", " 　x ", "​q​", "\x1c\x1dy\x85", "", "   ", "\tmid dle\n"]
    got = col_values(spark, samples, X.strip)
    assert got == [s.strip() for s in samples]


def test_split_ws_and_word_count(spark):
    samples = ["a  b\tc ", " x　y", "", "one", "a\x0bb\x1cc"]
    assert col_values(spark, samples, X.split_ws) == [s.split() for s in samples]
    assert col_values(spark, samples, X.word_count) == [len(s.split()) for s in samples]


def test_13a_tokens_match_python(spark):
    samples = [
        "Hello, world.", "It's 3.14 -- or 2-3, maybe.", "a&amp;b &lt;tag&gt; &quot;q&quot;", "x<skipped>y",
        "line-\nbreak\nnext", "(paren) [br] {cu} ~til `bt` @at #h $d %p ^c *s +p =e |b \\bs /sl :c ;s ?q !e",
        "1,000.5 end.", "Übergröße, café.", "", "   ",
    ]
    assert col_values(spark, samples, X.tokens_13a) == [pyref.tok13a(s) for s in samples]


def test_rouge_tokens_match_python(spark):
    samples = ["Hello, World! 42x", "Café au lait", "", "a--b__c", "ÉTÉ été 2024"]
    assert col_values(spark, samples, X.tokens_rouge) == [pyref.tok_rouge(s) for s in samples]


def test_template_paths_agree(spark):
    from quire.operators import prompts as PR

    df = spark.createDataFrame([(1, " q? ", "ans\n"), (2, "", "")], "rid long, question string, answer string")
    t = PR.DEFAULT_TEMPLATE
    a = df.select(t.render(PR.chat_messages("sys")).alias("x")).collect()
    b = df.select(t.render_parts([("system", F.lit("sys")), ("user", F.col("question")),
                                  ("assistant", F.col("answer"))]).alias("x")).collect()
    assert a == b
