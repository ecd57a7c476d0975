import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from quire.llm import op11_importance as op

GOAL = ["w1 w2 w3 w4 w5 w6 w7", "W1 w1 w1, é😀 w2", None, ""]


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(rows, goal, n=1, buckets=10_000, seed=2024, min_words=20, percent=10):
    """(id, words, features, weight, score, rank) of (id, text) rows."""
    def found(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]

    s, t = (Counter(b for x in texts for b in found(x)) for texts in ([r[1] for r in rows], goal))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)}
    out = []
    for i, text in rows:
        f = found(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    may = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2], r[3]))
    for k, r in enumerate(may[:percent * len(may) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=repr)


def run(spark, docs, goal=GOAL, **more):
    target = spark.createDataFrame([(t,) for t in goal], "text string")
    return sorted((tuple(r) for r in op.importance_resample(docs, target, **more).collect()), key=repr)


@pytest.mark.parametrize("more", [{}, {"n": 2, "buckets": 97, "percent": 35}, {"n": 3, "min_words": 0, "percent": 100, "seed": 5}, {"n": 2, "head": 3, "percent": 50}])
def test_as_brute_force(spark, odd_docs, odd_rows, more):
    want = brute([(r[0], r[1]) for r in odd_rows], GOAL, **{k: v for k, v in more.items() if k != "head"})
    assert run(spark, odd_docs, **more) == want
    assert any(r[5] for r in want)


def test_the_table_changes_no_bucket():
    text = "Ab ab ab2 xyz ab ab2 é é 😀 " + "long" * 40 + " ab"
    for n in (1, 2, 3):
        want = sorted(op.Features(n, 1000, [], [])(text)[1].tolist())
        assert sorted(op.Features(n, 1000, [b"ab", b"\xc3\xa9"], [b"ab ab2", b"xyz ab"])(text)[1].tolist()) == want


def test_the_head_is_frequent_and_short(spark):
    texts = [("common pair " * 50 + f"rare{i} " + "x" * 100,) for i in range(20)]
    docs = spark.createDataFrame(texts, "text string").repartition(4)
    found, pairs = op.head_table(docs, n=2, size=3)
    assert set(found) == {b"common", b"pair"} and pairs == [b"common pair"]
    assert all(len(w) <= op.HEAD_BYTES for w in op.head_table(docs, size=100)[0])


def test_summary_is_bounded(monkeypatch):
    monkeypatch.setattr(op, "SUMMARY", 50)
    monkeypatch.setattr(op, "HANDED_ON", 3)
    s = op._Summary()
    for i in range(2000):
        s.add([b"often", b"%d" % i, b"often"] + ([b"second"] if i % 2 else []))
        assert len(s) <= 103
    assert [e for e, _ in s.head()][:2] == [b"often", b"second"]


def test_clashing_columns_nulls_repeats(spark, clashing):
    docs = clashing.withColumnRenamed("n_chars", "rank")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert run(spark, docs, percent=60) == brute(rows, GOAL, percent=60)
    target = spark.createDataFrame([(t,) for t in GOAL], "text string")
    ranked = op.importance_resample(docs, target, percent=60)
    drawn = op.drawn_documents(docs, ranked)
    ids = {r.doc_id for r in ranked.collect() if r["rank"]}
    assert drawn.columns == docs.columns
    assert sorted(map(repr, drawn.collect())) == sorted(repr(r) for r in docs.collect() if r.doc_id in ids)


def test_empty_tables_and_nothing_drawn(spark, no_docs, odd_docs, odd_rows):
    assert run(spark, no_docs) == []
    rows = [(r[0], r[1]) for r in odd_rows]
    assert run(spark, odd_docs, goal=[]) == brute(rows, [])
    assert all(r[5] is None for r in run(spark, odd_docs, percent=0))
    assert all(r[5] is None for r in run(spark, odd_docs, min_words=10**6))
