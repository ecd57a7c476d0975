import math
import random

import pytest

from quire.llm import op1_mixing as op

WEIGHTS = (3, 1, 2)


def brute_targets(sizes, share=1.5, cap=2):
    """sizes: {source or None: words}.  Excess over the cap is shared again by weight until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), share * sum(sizes.values()), set(order)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= cap * sizes[s]:
                left += target[s] - cap * sizes[s]
                target[s] = float(cap * sizes[s])
                open_.discard(s)
    return target


def test_targets_sizes_and_copies(odd_docs, odd_rows):
    rows = {r.doc_id: r for r in op.mix(odd_docs).collect()}
    size, by = {}, {}
    for d, text, _, source, _ in odd_rows:
        size[d] = len([w for w in (text or "").replace("\x0b", " ").replace("\x0c", " ").split(" ") for w in w.split() if w]) if text else 0
        by.setdefault(source, []).append(d)
    totals = {s: sum(size[d] for d in ds) for s, ds in by.items()}
    target = brute_targets(totals)
    for s, ds in by.items():
        for d in ds:
            r = rows[d]
            assert (r.size, r.source_size) == (size[d], totals[s])
            assert r.target == pytest.approx(target[s], rel=1e-9, abs=1e-6)
            assert r.taken == r.copies * r.size and 0 <= r.taken <= 2 * r.size
        miss, sizes = abs(sum(rows[d].taken for d in ds) - target[s]), [size[d] for d in ds if size[d]]
        # Whole documents only: half the smallest one, or half one that outweighs what the others can take up.
        assert miss <= min(sizes, default=0) / 2 + 1e-6 or max(sizes) > sum(sizes) / 3 and miss <= max(sizes) / 2


def test_rates_are_the_tilted_solution(odd_docs):
    rows = op.mix(odd_docs).collect()
    for source in {(r.source_size, r.target) for r in rows}:
        group = [r for r in rows if (r.source_size, r.target) == source and r.size]
        if not group:
            continue
        assert sum(r.rate * r.size for r in group) == pytest.approx(source[1], rel=1e-6)
        free = [(math.log(r.rate) / r.size) for r in group if r.rate < 2 - 1e-9]
        assert max(free, default=0) - min(free, default=0) < 1e-9 * max(1, abs(max(free, default=0))) + 1e-9


def test_reruns_and_partitions_agree(odd_docs):
    a = sorted(tuple(r) for r in op.mix(odd_docs).select("doc_id", "taken").collect())
    b = sorted(tuple(r) for r in op.mix(odd_docs.repartition(2)).select("doc_id", "taken").collect())
    assert a == b


def test_small_buckets_come_near_their_targets(odd_docs, monkeypatch):
    monkeypatch.setattr(op, "BUCKET_ROWS", 7)
    rows = op.mix(odd_docs).collect()
    hot = [r for r in rows if r.source_size == max(x.source_size for x in rows)]
    assert abs(sum(r.taken for r in hot) - hot[0].target) <= max(r.size for r in hot) / 2


def test_repeat_gives_the_rows_their_copies(odd_docs, clashing, no_docs):
    rows = op.repeat(odd_docs)
    words = rows.selectExpr("sum(coalesce(regexp_count(text, '[^ \\n\\t]+'), 0))").first()[0]
    assert words == sum(r.taken for r in op.mix(odd_docs).collect())
    texts = {r.text for r in odd_docs.collect()}
    assert all(r.text in texts for r in rows.collect())
    assert {r[0] for r in rows.groupBy("doc_id").count().select("count").collect()} <= {1, 2, 3}
    assert op.repeat(clashing).columns == clashing.columns
    # The row that is there twice may be taken twice each time.
    assert {r[0] for r in op.repeat(clashing).groupBy(*clashing.columns).count().select("count").collect()} <= {1, 2, 3, 4}
    assert op.mix(no_docs).count() == 0 and op.repeat(no_docs).count() == 0


def test_no_words_at_all(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id bigint, text string, source string")
    assert {(r.doc_id, r.size, r.target, r.taken) for r in op.mix(df).collect()} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}
    assert op.repeat(df).count() == 0


def test_sources_of_many_documents_are_taken_in_whole_copies(spark, monkeypatch):
    monkeypatch.setattr(op, "BUCKET_ROWS", 20)
    rows = [(i, "\n".join(f"w{j}" for j in range(20 + i * i % 61)), f"s{i % 3}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    mixed = op.mix(docs).collect()
    assert len(mixed) == 600 and {r.copies for r in mixed} == {0, 1, 2}
    for source in {(r.source_size, r.target) for r in mixed}:
        assert abs(sum(r.taken for r in mixed if (r.source_size, r.target) == source) - source[1]) <= 10
    texts = {r[0]: r[1] for r in rows}
    assert all(r.text == texts[r.doc_id] for r in op.repeat(docs).collect())


def test_copies_of_one_size_are_dealt_over_its_buckets(spark, monkeypatch):
    monkeypatch.setattr(op, "BUCKET_ROWS", 10)
    docs = spark.createDataFrame([(i, "a b c d", "hot" if i % 10 else "small") for i in range(1000)], "doc_id bigint, text string, source string")
    mixed = [r for r in op.mix(docs).collect() if r.source_size == 3600]
    assert len({r.rate for r in mixed}) == 1 and {r.copies for r in mixed} <= {1, 2}
    assert sum(r.copies for r in mixed) == round(mixed[0].target / 4)


def test_a_document_is_never_cut(spark):
    """A target that whole copies cannot meet is missed: no document is taken in part."""
    big = " first  line\nand\tmore\n\n" * 500
    rows = [(0, big, "a"), (1, "x y z", "a"), (2, "u v", "b")]
    out = op.repeat(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    assert out and all(r.text == rows[r.doc_id][1] for r in out)


def test_whole_copies_of_random_sources():
    rng = random.Random(5)
    for _ in range(200):
        sizes = sorted(rng.sample(range(1, 400), rng.randrange(1, 60)), reverse=True)
        docs, rates = [rng.randrange(1, 9) for _ in sizes], [2 * rng.random() for _ in sizes]
        copies = op.whole_copies(sizes, docs, rates, 2)
        assert all(0 <= k <= 2 * n for k, n in zip(copies, docs, strict=True))
        miss = abs(sum(s * k for s, k in zip(sizes, copies, strict=True)) - sum(s * n * r for s, n, r in zip(sizes, docs, rates, strict=True)))
        assert miss <= max(sizes[-4:]) / 2 + 1e-6 or len(sizes) < 12


def test_many_long_documents_are_dealt_at_once():
    """Memory and time follow the number of sizes, not the length of documents."""
    import time

    rng = random.Random(6)
    sizes = sorted({rng.randrange(200_000, 4_000_000) for _ in range(5000)}, reverse=True)
    began = time.time()
    copies = op.whole_copies(sizes, [1] * len(sizes), [2 * rng.random() for _ in sizes], 2)
    assert len(copies) == len(sizes) and time.time() - began < 2
