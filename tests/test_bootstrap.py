import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import bootstrap as B
from quire.operators import metrics as M

SCHEMA = "label string, rid long, prediction string, reference string"


def rows(n=240):
    rng = np.random.default_rng(3)
    words = np.array("the cat sat on a mat and ran off to sea".split())
    out = []
    for i in range(n):
        ref = " ".join(rng.choice(words, 8))
        for label, k in (("base", 3), ("tuned", 6)):
            out.append((label, i, " ".join([*ref.split()[:rng.integers(0, k + 1)], *rng.choice(words, 3)]), ref))
    return out


def scored(spark, data, parts=4):
    return M.row_scores(spark.createDataFrame(data, SCHEMA).repartition(parts), bleu=False)


def f_values(scores):
    return {r.label: r.f for r in scores.groupBy("label").agg(F.sort_array(F.collect_list(M.rouge_f()["rouge1"])).alias("f")).collect()}


def test_as_a_plain_bootstrap(spark):
    """Middle and limits lie where 20,000 samples with replacement put them, within their own error."""
    scores = scored(spark, rows()).cache()
    got = {(r.label, r.metric): r for r in B.rouge_bootstrap(scores).collect()}
    assert len(got) == 6
    rng = np.random.default_rng(1)
    for label, f in f_values(scores).items():
        f = np.array(f)
        plain = f[rng.integers(0, len(f), (20_000, len(f)))].mean(1)
        r, error = got[label, "rouge1"], f.std() / math.sqrt(len(f))
        for value, q in ((r.low, 2.5), (r.mid, 50), (r.high, 97.5)):
            assert abs(value - np.percentile(plain, q)) < 0.25 * error
        assert r.low < f.mean() < r.high and abs(r.mid - f.mean()) < 0.15 * error


def test_reruns_and_partitions_agree(spark):
    data = rows(60)
    got = [sorted(map(tuple, B.rouge_bootstrap(scored(spark, d, parts)).collect())) for d, parts in ((data, 1), (data[::-1], 7), (data, 30))]
    assert got[0] == got[1] == got[2]


def test_sums_merge(spark):
    data = rows(50)
    scores = [scored(spark, part) for part in (data, data[:41], data[41:])]
    whole = {(r.label, r.replicate): r for r in B.rouge_replicates(scores[0], 40).collect()}
    both = {(r.label, r.replicate): r for r in B.rouge_replicates(scores[1].unionByName(scores[2]), 40).collect()}
    assert whole == both


def test_draws_are_poisson_and_independent():
    rng = np.random.default_rng(5)
    w = B.draws(rng.integers(0, 1 << 60, 2000), np.arange(1000))
    for k in range(6):
        chance = math.exp(-1) / math.factorial(k)
        assert abs((w == k).mean() - chance) < 5 * math.sqrt(chance / w.size)
    assert abs(w.mean() - 1) < 0.005 and abs(w.var() - 1) < 0.01
    rows_apart, replicates_apart = np.corrcoef(w[:200]), np.corrcoef(w[:, :200].T)
    for c, n in ((rows_apart, 1000), (replicates_apart, 2000)):
        apart = c[np.triu_indices(200, 1)]
        assert abs(apart.mean()) < 0.003 and abs(apart.std() - 1 / math.sqrt(n)) < 0.003


def test_poisson_table():
    total = 0.0
    for k, entry in enumerate(B.POISSON):
        total += math.exp(-1) / math.factorial(k)
        assert entry == math.floor(total * 2**32)


def test_odd_inputs(spark):
    assert B.rouge_bootstrap(scored(spark, [])).collect() == []
    one = B.rouge_bootstrap(scored(spark, [("x", 1, "a b", "a c")])).collect()
    assert {r.metric: r.mid for r in one} == pytest.approx({"rouge1": 0.5, "rouge2": 0.0, "rougeL": 0.5}, abs=1e-8)
    assert all(r.low == r.mid == r.high for r in one)
    nulls = B.rouge_bootstrap(scored(spark, [("x", None, None, "a c"), ("x", 2, "", None), (None, 2, "a", "a")])).collect()
    assert {(r.label, r.mid) for r in nulls} == {("x", 0.0), (None, 1.0)} or len(nulls) == 6
