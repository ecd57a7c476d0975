import pytest
from pyspark.sql import functions as F

from quire.operators import profile as P
from quire.plans import queries as Q

import pyref


def lens(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "rid long, n_tokens long")


@pytest.mark.parametrize("values", [list(range(100)), list(range(1, 21)), [7], [5, 5, 5, 1], [3, 1, 2, 2, 9, 9, 9]])
def test_p95_golden(spark, values):
    got = P.exact_quantile(lens(spark, values)).first()
    assert got.n == len(values)
    assert got.p95 == pyref.p95(values)


def test_p95_zero_to_99_is_95(spark):
    assert P.exact_quantile(lens(spark, list(range(100)))).first().p95 == 95


def test_length_report(spark):
    values = [1, 600, 513, 512, 40]
    r = P.length_report(lens(spark, values), max_length=512).first()
    assert (r.n, r.max_tokens, r.n_over) == (5, 600, 2)
    assert r.mean_tokens == sum(values) / 5
    assert r.pct_over == 100 * 2 / 5
    assert r.p95_tokens == pyref.p95(values)


def test_length_report_empty(spark):
    r = P.length_report(lens(spark, [])).first()
    assert (r.n, r.n_over, r.mean_tokens, r.max_tokens, r.p95_tokens) == (0, 0, None, None, None)


@pytest.mark.parametrize("qlens,expected", [([2, 3], 2), ([3, 4], 4), ([], 0), ([1, 2, 2], 2)])
def test_mean_rounding_half_even(spark, qlens, expected):
    rows = [(i, "x" * q, "y" * 10, "d") for i, q in enumerate(qlens)]
    df = spark.createDataFrame(rows, "rid long, question string, answer string, domain string")
    assert P.mean_lengths(df).first().avg_question_len == expected
    assert expected == round(sum(qlens) / max(len(qlens), 1))


def test_report_matches_parts(spark):
    flat = Q.validated(spark, "/root/testdata/sf0.01")
    rep = P.ingest_report(flat).first()
    counts = P.ingest_counts(flat).first()
    assert (rep.total_raw, rep.total_clean, rep.dropped) == tuple(counts)
    from quire.operators.validate import clean_records
    hist = {r.domain: r.n for r in P.domain_histogram(clean_records(flat)).collect()}
    assert {r.domain: r.n for r in P.report_domains(flat).collect()} == hist
    assert rep.n_domains == len(hist)
    m = P.mean_lengths(clean_records(flat)).first()
    assert (rep.avg_question_len, rep.avg_answer_len) == (m.avg_question_len, m.avg_answer_len)


def test_token_count_plugin(spark, tmp_dir):
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers

    tok = Tokenizer(models.WordLevel(unk_token="[UNK]"))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    tok.train_from_iterator(["a b c", "hello world"], trainers.WordLevelTrainer(special_tokens=["[UNK]"]))
    path = f"{tmp_dir}/tok.json"
    tok.save(path)
    df = spark.createDataFrame([(1, "a b, c"), (2, "hello")], "rid long, text string")
    got = {r.rid: r.n_tokens for r in P.token_lengths(df, counter=P.tokenizer_counter(path)).collect()}
    assert got == {1: 4, 2: 1}


def test_histogram_is_partial_aggregate(spark):
    from tests_support import plan_text

    plan = plan_text(P.length_report(Q.chat_lengths(Q.pairs(spark, "/root/testdata/sf0.001"))))
    assert "partial_count" in plan or "partial_sum" in plan
