"""Property tests (hypothesis): pure functions directly, Spark operators on small generated tables."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quire.functions.lcs import clipped_matches, lcs_len
from quire.operators import split as D

import pyref

SPARK_CHECKS = [HealthCheck.too_slow, HealthCheck.filter_too_much, HealthCheck.function_scoped_fixture]

tokens = st.lists(st.sampled_from(list("abcdefg")), max_size=40)


@given(tokens, tokens)
@settings(max_examples=300, deadline=None)
def test_lcs_bitparallel_equals_dp(a, b):
    assert lcs_len(a, b) == pyref.lcs_len_dp(a, b) == lcs_len(b, a)
    assert lcs_len(a, b) <= min(len(a), len(b))


@given(st.lists(st.text(alphabet="abc xyz.,-", min_size=0, max_size=30), min_size=1, max_size=5),
       st.lists(st.text(alphabet="abc xyz.,-", min_size=0, max_size=30), min_size=1, max_size=5))
@settings(max_examples=200, deadline=None)
def test_scores_bounded(preds, refs):
    n = min(len(preds), len(refs))
    preds, refs = preds[:n], refs[:n]
    b = pyref.bleu(preds, refs)
    assert 0.0 <= b <= 1.0 + 1e-12
    for p, r in zip(preds, refs):
        for v in (pyref.rouge_n(p, r, 1), pyref.rouge_n(p, r, 2), pyref.rouge_l(p, r)):
            assert 0.0 <= v <= 1.0 + 1e-12


@given(st.integers(min_value=0, max_value=100000), st.floats(0.0, 1.0), st.floats(0.0, 1.0))
def test_expected_sizes_partition_n(n, tr, vr):
    a, b, c = pyref.expected_sizes(n, tr, vr)
    assert a + b + c == n and min(a, b) >= 0


@given(st.lists(st.integers(0, 30), min_size=1, max_size=60))
@settings(max_examples=25, deadline=None, suppress_health_check=SPARK_CHECKS)
def test_spark_p95_equals_python(spark, values):
    from quire.operators import profile as P

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "rid long, n_tokens long")
    assert P.exact_quantile(df).first().p95 == pyref.p95(values)


@given(st.integers(0, 60), st.integers(1, 6))
@settings(max_examples=15, deadline=None, suppress_health_check=SPARK_CHECKS)
def test_spark_split_disjoint_and_exact(spark, n, buckets):
    rows = D.three_way_split(spark.range(n).withColumnRenamed("id", "rid"), buckets=buckets).collect()
    assert sorted(r.pos for r in rows) == list(range(n))
    sizes = tuple(sum(1 for r in rows if r.split == s) for s in ("train", "val", "test"))
    assert sizes == pyref.expected_sizes(n)


@given(st.lists(st.sampled_from(["a", "b", "ab"]), min_size=4, max_size=10).map(" ".join))
@settings(max_examples=40, deadline=None)
def test_bleu_of_identity_is_one(text):
    assert abs(pyref.bleu([text], [text]) - 1.0) < 1e-12


texts = st.text(alphabet=list("abc xyz.,-'\n") + ["é", "Q"], min_size=0, max_size=40)


@given(st.lists(st.tuples(texts, texts), min_size=1, max_size=6))
@settings(max_examples=12, deadline=None, suppress_health_check=SPARK_CHECKS)
def test_spark_scores_equal_python(spark, rows):
    import pytest

    from quire.operators import metrics as M

    df = spark.createDataFrame([("m", i, p, r) for i, (p, r) in enumerate(rows)],
                               "label string, rid long, prediction string, reference string")
    t = M.metric_table(df).first()
    preds, refs = [p for p, _ in rows], [r for _, r in rows]
    n = len(rows)
    assert t.bleu_raw == pytest.approx(pyref.bleu(preds, refs), abs=1e-12)
    assert t.rouge1_raw == pytest.approx(sum(pyref.rouge_n(p, r, 1) for p, r in rows) / n, abs=1e-12)
    assert t.rouge2_raw == pytest.approx(sum(pyref.rouge_n(p, r, 2) for p, r in rows) / n, abs=1e-12)
    assert t.rougeL_raw == pytest.approx(sum(pyref.rouge_l(p, r) for p, r in rows) / n, abs=1e-12)
    for v in (t.bleu_raw, t.rouge1_raw, t.rouge2_raw, t.rougeL_raw):
        assert 0.0 <= v <= 1.0 + 1e-12


@given(st.lists(st.sampled_from(["a", "b", "cd", "e."]), min_size=4, max_size=12).map(" ".join))
@settings(max_examples=6, deadline=None, suppress_health_check=SPARK_CHECKS)
def test_spark_bleu_identity(spark, text):
    from quire.operators import metrics as M

    df = spark.createDataFrame([("m", 1, text, text)], "label string, rid long, prediction string, reference string")
    t = M.metric_table(df).first()
    assert abs(t.bleu_raw - 1.0) < 1e-12 and abs(t.rougeL_raw - 1.0) < 1e-12


@given(tokens, tokens, st.integers(1, 5))
def test_clipped_matches(a, b, n):
    def grams(x):
        return [tuple(x[i:i + n]) for i in range(len(x) - n + 1)]

    left, right = grams(a), grams(b)
    assert clipped_matches(a, b, n) == sum(min(left.count(g), right.count(g)) for g in set(left))
