import hashlib
import random
import tracemalloc

import numpy as np
import pytest

from quire.llm import op10_suffix as op


def brute(docs, length=100):
    """{id: (bytes, removed, spans, sha256 of the rest)}; docs: {id: bytes}."""
    seen, out = set(), {}
    for d in sorted(docs):
        data = docs[d]
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            window = data[s:s + length]
            if window in seen:
                gone[s:s + length] = True
            seen.add(window)
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(data) else 0
        out[d] = (len(data), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def result(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in df.collect()}


@pytest.fixture(scope="module")
def repeats():
    rng = random.Random(5)
    passages = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (99, 100, 101, 160, 400)]
    docs = {}
    for i in range(60):
        parts = ["".join(rng.choice("ijklmnop é") for _ in range(rng.randrange(0, 200)))]
        for _ in range(rng.randrange(4)):
            parts += [rng.choice(passages), "".join(rng.choice("qrst") for _ in range(rng.randrange(0, 5)))]
        docs[i] = "".join(parts)
    docs |= {60: "z" * 350, 61: "z" * 99, 62: "zy" * 300, 63: "", 64: docs[3], 65: docs[3] + "x", 66: "é" * 120}
    return docs


def test_equals_brute_force(spark, repeats):
    df = spark.createDataFrame([*repeats.items(), (67, None)], "doc_id bigint, text string").repartition(4)
    expected = brute({k: v.encode() for k, v in repeats.items()} | {67: b""})
    assert result(op.remove_repeats(df)) == expected
    # Many small texts, and all anchors hot: the same result by every way.
    assert result(op.remove_repeats(df, text_bytes=2000)) == expected
    assert result(op.remove_repeats(df, hot=1)) == expected


def test_long_texts_are_sliced_without_loss(spark, monkeypatch):
    rng = random.Random(8)
    long = "".join(rng.choice("abcdef") for _ in range(op.CHUNK + 3000))
    df = spark.createDataFrame([(1, long), (2, long[op.CHUNK - 500:op.CHUNK + 700]), (3, "x" + long[-250:])], "doc_id bigint, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in op.remove_repeats(df).select("doc_id", "n_removed", "n_spans").collect()}
    assert got == {1: (0, 0), 2: (1200, 1), 3: (250, 1)}


def test_open_boundaries_are_common_prefixes():
    rng = np.random.default_rng(2)
    for _ in range(20):
        pieces = [rng.integers(1, 4, rng.integers(1, 60)) for _ in range(12)]
        text = np.concatenate([np.append(p, 0) for p in pieces]).astype(np.uint16)
        order = op.suffix_order(text, 14)
        shares = op.open_boundaries(text, order, 12)
        for i in range(1, len(text)):
            a, b = (text[order[k]:order[k] + 12].tolist() for k in (i - 1, i))
            if len(a) == len(b) == 12 and 0 not in a and 0 not in b:
                assert shares[i] == (a == b)


def test_ids_that_repeat_or_are_null(spark, clashing, no_docs):
    rng = random.Random(4)
    text, other = ("".join(rng.choice("abcdefghijklmnop") for _ in range(n)) for n in (300, 301))
    df = spark.createDataFrame([(1, text), (1, text), (1, other), (None, text), (None, other + text)], "doc_id bigint, text string")
    got = sorted((r.doc_id is None, r.n_bytes, r.n_removed) for r in op.remove_repeats(df).collect())
    assert got == [(False, 300, 0), (False, 300, 0), (False, 301, 0), (True, 300, 300), (True, 601, 601)]
    assert op.remove_repeats(no_docs).count() == 0
    cut = op.cut_texts(clashing)
    assert cut.columns == clashing.columns and cut.count() == clashing.count()


def test_cut_texts_hold_whole_characters(spark):
    rng = random.Random(6)
    passage = "".join(rng.choice("éàüßöç") for _ in range(80))
    df = spark.createDataFrame([(1, "a" + passage, "x"), (2, "bc" + passage + "tail", "y"), (3, None, "z")], "doc_id bigint, text string, source string")
    got = {r.doc_id: r.text for r in op.cut_texts(df).collect()}
    assert got == {1: "a" + passage, 2: "bctail", 3: None}


def test_cut_texts_keep_characters_that_look_torn(spark):
    """A replacement character of the text itself stays; bytes of two torn characters do not make a new one."""
    rng = random.Random(7)
    passage = "".join(rng.choice("abcdef") for _ in range(150))
    df = spark.createDataFrame([(1, "x" + passage + "y"), (2, "bad \ufffd mark." + passage + "\ufffd end")], "doc_id bigint, text string")
    assert {r.doc_id: r.text for r in op.cut_texts(df).collect()}[2] == "bad \ufffd mark.\ufffd end"
    shared = "\u00a9" + passage + "\u00c3"   # covered without its first and last byte where the neighbours differ
    df = spark.createDataFrame([(1, shared), (2, "\u00e9" + passage + "\u00c9"), (3, "\u0169" + passage + "z")], "doc_id bigint, text string")
    for r in op.cut_texts(df).collect():
        assert "\ufffd" not in r.text and all(c in (shared + "\u00e9\u00c9\u0169z") for c in r.text)


def test_clashing_names(spark, clashing):
    docs = clashing.withColumnRenamed("lang", "d").withColumnRenamed("source", "e").withColumnRenamed("n_chars", "n_bytes").withColumn("_spans", clashing["doc_id"])
    rows = op.remove_repeats(docs)
    assert rows.columns == ["doc_id", "text", "d", "e", "score", "_spans", *op.ADDED] and rows.count() == docs.count()
    assert op.cut_texts(docs).columns == docs.columns
    want = {(r.doc_id, r.text): r.n_removed for r in op.remove_repeats(clashing.select("doc_id", "text")).collect()}
    assert {(r.doc_id, r.text): r.n_removed for r in rows.collect()} == want


def test_a_task_merges_its_own_blocks_first(spark, monkeypatch):
    """A passage that all documents hold gives a row a task, not one a document; what is removed stays the same."""
    monkeypatch.setattr(op, "COMBINE_ROWS", 300)
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(400))
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(60))) + passage + f" {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    texts = df.selectExpr("doc_id AS d", "0L AS e", "cast(text AS binary) AS text")
    found = op.block_rows(texts).collect()
    blocks = [(r.anchor, r.block) for r in found if r.place >= 0]
    assert sum(r.place < 0 for r in found) > len(blocks) and max(map(blocks.count, set(blocks))) <= 40
    got = {r.doc_id: (r.n_removed, bytes(r.kept)) for r in op.remove_repeats(df).collect()}
    monkeypatch.setattr(op, "COMBINE_ROWS", 1)
    assert got == {r.doc_id: (r.n_removed, bytes(r.kept)) for r in op.remove_repeats(df).collect()}
    assert all(got[i][0] >= 400 for i, _ in rows[1:])


def test_a_task_has_one_python_worker(spark, repeats):
    """Each further mapInArrow of a stage would take one more worker for every core of an executor."""
    docs = spark.createDataFrame([*repeats.items()], "doc_id bigint, text string")

    def chained(node, above):
        name = node.nodeName()
        if name == "MapInArrow" and above:
            return True
        below = name == "MapInArrow" or above and name in ("Project", "Filter", "Sort")
        return any(chained(node.children().apply(i), below) for i in range(node.children().size()))

    for df in (op.remove_repeats(docs), op.cut_texts(docs)):
        plan = df._jdf.queryExecution().sparkPlan()
        assert plan.toString().count("MapInArrow") >= 5
        assert not chained(plan, False)


def test_the_transform_takes_few_bytes_a_symbol():
    rng = np.random.default_rng(3)
    pieces = [b"".join((bytes(rng.integers(97, 123, 17, np.uint8)), bytes(100 * [i % 256]), bytes(rng.integers(97, 123, 17, np.uint8)))) for i in range(2000)]
    d, zero = np.arange(2000), np.zeros(2000, np.int64)
    tracemalloc.start()
    found = list(op.repeated_windows(pieces, d, zero, zero, 100))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) >= 2000 - 256 and peak < 75 * sum(len(p) + 1 for p in pieces)
