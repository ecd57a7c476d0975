import pytest
from pyspark.sql import functions as F

from quire.functions.lcs import lcs_len
from quire.operators import metrics as M
from quire.plans import queries as Q
from tests_support import plan_text

import pyref


def pairs_df(spark, rows, label="m"):
    return spark.createDataFrame([(label, i, p, r) for i, (p, r) in enumerate(rows)],
                                 "label string, rid long, prediction string, reference string")


def scores(spark, rows):
    t = M.metric_table(pairs_df(spark, rows)).first()
    return t.bleu_raw, t.rouge1_raw, t.rouge2_raw, t.rougeL_raw


def test_identical_texts_score_one(spark):
    b, r1, r2, rl = scores(spark, [("the cat sat on the mat", "the cat sat on the mat")])
    assert b == pytest.approx(1.0) and r1 == r2 == rl == pytest.approx(1.0)


def test_three_tokens_no_4gram_bleu_zero(spark):
    b, r1, _, _ = scores(spark, [("a b c", "a b c")])
    assert b == 0.0 and r1 == pytest.approx(1.0)


def test_no_shared_token(spark):
    assert scores(spark, [("x y z w", "a b c d")]) == (0.0, 0.0, 0.0, 0.0)


def test_clipped_unigram(spark):
    r = M.row_scores(pairs_df(spark, [("the the the", "the cat")])).first()
    assert r.h1 == 1 and r.hr1 == 1 and (r.plen_b, r.rlen_b) == (3, 2)


def test_lcs_golden():
    assert lcs_len("a b c d e".split(), "b x d e a".split()) == 3


def test_empty_prediction_counts_as_row(spark):
    t = M.metric_table(pairs_df(spark, [("", "some reference text here"), ("some reference text here",
                                                                            "some reference text here")])).first()
    assert t.rouge1_raw == pytest.approx(0.5) and t.rougeL_raw == pytest.approx(0.5)


def test_f5_matches_python(spark):
    pairs = Q.scored_pairs(spark, "/root/testdata/sf0.001").collect()
    table = {r.label: r for r in M.metric_table(Q.scored_pairs(spark, "/root/testdata/sf0.001")).collect()}
    for label in ("base", "finetuned"):
        rows = [(p.prediction, p.reference) for p in pairs if p.label == label]
        preds, refs = [p for p, _ in rows], [r for _, r in rows]
        got = table[label]
        assert got.bleu_raw == pytest.approx(pyref.bleu(preds, refs), abs=1e-12)
        n = len(rows)
        assert got.rouge1_raw == pytest.approx(sum(pyref.rouge_n(p, r, 1) for p, r in rows) / n, abs=1e-12)
        assert got.rouge2_raw == pytest.approx(sum(pyref.rouge_n(p, r, 2) for p, r in rows) / n, abs=1e-12)
        assert got.rougeL_raw == pytest.approx(sum(pyref.rouge_l(p, r) for p, r in rows) / n, abs=1e-12)


def test_fixture_values_sf001(spark):
    """FIXTURES.md F5 table (computed independently in plain Python)."""
    t = {r.label: r for r in M.metric_table(Q.scored_pairs(spark, "/root/testdata/sf0.01")).collect()}
    assert t["base"].bleu_raw == pytest.approx(0.0214129318, abs=1e-10)
    assert t["finetuned"].bleu_raw == pytest.approx(0.4976407454, abs=1e-10)
    assert t["base"].rouge1_raw == pytest.approx(0.6685091095, abs=1e-10)
    assert t["finetuned"].rouge2_raw == pytest.approx(0.6838254019, abs=1e-10)
    assert t["base"].rougeL_raw == pytest.approx(0.4880830472, abs=1e-10)
    assert t["finetuned"].rougeL_raw == pytest.approx(0.6491717843, abs=1e-10)


def test_compare_delta_of_rounded(spark):
    cmp = {r.metric: r for r in M.compare(M.metric_table(Q.scored_pairs(spark, "/root/testdata/sf0.001"))).collect()}
    for r in cmp.values():
        assert r.delta == round(r.finetuned - r.base, 4)


def test_ngrams_are_counted_in_their_row(spark):
    """No row, join or aggregate per n-gram: the aggregate is per label."""
    plan = plan_text(M.metric_table(Q.scored_pairs(spark, "/root/testdata/sf0.001")))
    assert "Generate" not in plan and "gram" not in plan
    aggregates = [x for x in plan.split("\n") if x.startswith("Keys [")]
    assert aggregates and all(x.startswith("Keys [1]: [label") for x in aggregates)


def test_metric_table_reads_the_pairs_once(spark):
    """E6 in one pass: the pair rows are shuffled once per side, scored in Arrow batches, and added up per label."""
    plan = plan_text(M.metric_table(Q.scored_pairs(spark, "/root/testdata/sf0.001")))
    tree = plan.split("\n\n")[0]
    assert tree.count("MapInArrow") == 1
    assert "BatchEvalPython" not in plan
    above = tree[:tree.find("MapInArrow")]
    assert above.count("Exchange") == 1


LONG = "the cat sat on the mat and then the dog sat on the log "


def long_rows():
    import random

    rng = random.Random(4)
    words = (LONG + "a b c d e f").split()
    texts = [" ".join(rng.choices(words, k=k)) for k in (0, 1, 5, 60, 300, 2500)]
    return [(p, r) for p in texts for r in texts]


@pytest.mark.parametrize(("block", "size"), [(4096, 1 << 20), (64, 100), (7, 1)])
def test_long_texts_as_brute_force(block, size):
    """Any block of bits and any slice of rows gives the same; a row larger than a slice is one of its own."""
    import quire.functions.lcs as L

    pairs = [(p, r) for p, r in long_rows() if len(p) * len(r) < 10**7]
    left, right = (L.tokenized([pair[i] for pair in pairs], str.split) for i in (0, 1))
    sizes = left.sizes + right.sizes
    assert sum((list(range(a, b)) for a, b in L._slices(sizes, size)), []) == list(range(len(pairs)))
    assert all(sizes[a:b].sum() <= size or b == a + 1 for a, b in L._slices(sizes, size))
    for p, r in pairs[::3]:
        assert L.lcs_len(p.split(), r.split(), block) == pyref.lcs_len_dp(p.split(), r.split())
    matches = L.all_clipped_matches(left, right, 4)
    for i, (p, r) in enumerate(pairs):
        assert [m[i] for m in matches] == [L.clipped_matches(p.split(), r.split(), n) for n in (1, 2, 3, 4)]


def test_row_scores_as_brute_force(spark):
    rows = [*long_rows()[:30], (None, "x y"), ("x y", None), ("a b", "a b"), ("c", "a b")]
    got = [tuple(r) for r in M.row_scores(pairs_df(spark, rows)).orderBy("rid").collect()]
    for i, (p, r) in enumerate(rows):
        assert got[i][2:] == tuple(pyref_row(p or "", r or "")), i


def test_tokens_agree_with_the_native_ones(spark):
    """The task-side tokenizers, the native expressions and the published rules, on marks, digits and odd spaces."""
    import random

    from quire.functions.text import tokens_13a, tokens_rouge
    from quire.functions.tokens import words_13a, words_rouge

    rng = random.Random(8)
    parts = ["a", "1", "23", ".", ",", ".,", "-", " ", "\n", "-\n", "&amp;", "&quot;", "/", "(", "'", "é", "\x85", "_", "<skipped>", "5.5", "x.", "\u212a", "\u3000", "İ"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tokens_13a("t").alias("b"), tokens_rouge("t").alias("r"))
    for row in df.collect():
        assert words_13a(row.t) == row.b == pyref.tok13a(row.t), repr(row.t)
        assert words_rouge(row.t) == row.r, repr(row.t)


def pyref_row(p, r):
    from quire.functions.lcs import clipped_matches

    p, r = p.split(), r.split()
    return [*[clipped_matches(p, r, n) for n in (1, 2, 3, 4)], *[clipped_matches(p, r, n) for n in (1, 2)], pyref.lcs_len_dp(p, r),
            len(p), len(r), len(p), len(r)]


def test_batches_of_one_row_and_of_all_rows_agree(spark):
    texts = pairs_df(spark, long_rows())
    got = []
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in ("1", "100000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        got.append(sorted(map(tuple, M.row_scores(texts).collect())))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got[0] == got[1]


def test_doc_rouge_l_as_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = Q.doc_clean(spark, sf).select("rid", "answer").collect()
    got = {r.label: r.rougeL for r in Q.e5_doc_rouge_l(spark, sf).collect()}
    answers = {r.rid: r.answer for r in docs}
    preds = Q.T.predictions_fixture(Q.doc_clean(spark, sf)).select("label", "rid", "prediction").collect()
    from quire.functions.lcs import lcs_len

    for label in ("base", "finetuned"):
        scores = []
        for x in preds:
            if x.label == label:
                p, r = pyref.tok_rouge(x.prediction), pyref.tok_rouge(answers[x.rid])
                n = pyref.lcs_len_dp(p, r) if len(p) * len(r) < 10**6 else lcs_len(p, r, 10**9)
                scores.append(2 * n / (len(p) + len(r)) if p and r else 0.0)
        assert got[label] == pytest.approx(sum(scores) / len(scores), abs=1e-6)
