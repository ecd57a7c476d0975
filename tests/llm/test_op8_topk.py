import math
import random

import pytest

from quire.llm import op8_topk as op


def brute(rows, k=5):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(
        x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in ok:
        if q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in ok if i != q and len(a) == len(b))[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)}
    return out


def got(df, **settings):
    return [(r.query_id, r.rank, r.vec_id, r.score) for r in op.top_k(df, **settings).collect()]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_ROWS", 37)
    rng = random.Random(1)
    rows = [(i, [float(rng.gauss(0, 1)) for _ in range(12)]) for i in range(700)]
    copy = rows[13][1]
    rows += [(1000 + i, copy) for i in range(120)]                                  # ties
    rows += [(2000, None), (2001, [1.0, None]), (2002, [float("nan")] * 12), (2003, [float("inf")] * 12), (None, copy), (2050, [])]
    rows += [(2100, [1.0, 2.0]), (2101, [0.5, -2.0]), (2150, [0.0] * 12)]            # another length; zeros
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(6)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    result = got(df)
    assert len(result) == len(set(result))
    assert set(result) == brute(rows)
    monkeypatch.setattr(op, "ROUND_BYTES", 700)           # several rounds of queries
    assert set(got(df)) == brute(rows)


def test_large_components_are_exact(spark):
    rows = [(i, [float((-1) ** i * (1 << 16) * (i + 1)), float(i), 1.0]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert set(got(df)) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_rows(spark, n):
    rows = [(50 * i, [1.0, float(i)]) for i in range(n)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert set(got(df)) == brute(rows)


def test_repeated_queries_and_extra_columns(spark):
    rows = [(0, [1.0, 0.0], 9), (0, [1.0, 0.0], 9), (1, [1.0, 1.0], 9), (1, [1.0, 1.0], 9)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int")
    assert sorted(got(df)) == [(0, 1, 1, 65536), (0, 2, 1, 65536)]


def test_a_bound_loses_no_row_that_reaches_it():
    """With the k-th score of earlier candidates as the bound, the rows that reach it are found, and none below it is handed on."""
    import numpy as np

    rng = np.random.default_rng(3)
    x = (256 * rng.normal(size=(4000, 16))).astype(np.int64)
    lists, ids, none = op.Lists(np.arange(4000), x), np.arange(4000), (np.empty(0, np.int64), np.empty(0, np.int64))
    for i in range(20):
        q = x[i] * (1 if i % 2 else -1)
        scores = np.where(ids == i, -(1 << 60), x @ q)
        order = np.lexsort((ids, -scores))[:5]
        for place in (0, 2, 4):
            found = lists.top(q, i, 5, none, float(scores[order[place]]))
            assert found[1].tolist() == order[:place + 1].tolist() and found[0].tolist() == scores[order[:place + 1]].tolist()
        assert lists.top(q, i, 5, none)[1].tolist() == order.tolist()


def test_bounds_keep_what_is_handed_on_small(spark, monkeypatch):
    """Rows handed on by all tasks together follow the queries, not queries times tasks."""
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(6000)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(60)
    handed = []
    ranked = op._ranked
    monkeypatch.setattr(op, "_ranked", lambda found, k: handed.append(found.cache().count()) or ranked(found, k))
    out = got(df)
    assert len(out) == 120 * 5
    assert handed[-1] < 120 * 5 * 10 < 120 * 60 * 5 / 4
    monkeypatch.setattr(op, "_ranked", ranked)
    assert set(out) == brute([(r.vec_id, r.embedding) for r in df.collect()])
