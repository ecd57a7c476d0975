"""The pipeline against a plain brute force of each stage, stage by stage."""

import random

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from .test_op5_simhash import brute_fingerprint, brute_groups
from .test_op10_suffix import brute

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    passage = " ".join(f"p{rng.randrange(999)}" for _ in range(70))
    rows = []
    for i in range(60):
        text = " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randrange(30, 120)))
        if i % 5 == 0:
            text += " " + passage
        rows.append((i, text, "en", f"s{min(i % 6, 3)}", len(text)))
    rows += [(100 + i, rows[2][1], "en", "s1", rows[2][4]) for i in range(8)]
    rows += [(200, "too short", "en", "s0", 9), (201, None, None, None, None), (202, "x y z " * 50, "en", "s1", 300)]
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(folder / "documents.parquet"))
    return str(folder), rows


def test_stages(spark, corpus, tmp_path):
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    after = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after.append(docs.collect())
        assert name == "packing" or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    good, single, cut, mixed, packed = after
    assert {r.doc_id for r in good} == {r[0] for r in rows} - {200, 201, 202}
    pairs = [(r.doc_id, brute_fingerprint(r.text)) for r in good]
    assert sorted(r.doc_id for r in single) == sorted(set(brute_groups(pairs)))
    expected = brute({r.doc_id: r.text.encode() for r in single})
    assert {r.doc_id: len(r.text.encode()) for r in cut} == {d: n - gone for d, (n, gone, _, _) in expected.items()}
    assert sum(e[1] for e in expected.values()) > 0
    assert all(r.n_chars == len(r.text) for r in cut)
    texts = {r.doc_id: r.text for r in cut}
    for r in mixed:  # whole copies only
        assert r.text == texts[r.doc_id] and r.n_chars == len(r.text)
    sizes = [len(t.split()) for t in texts.values()]
    assert abs(sum(len(r.text.split()) for r in mixed) - 1.5 * sum(sizes)) <= 4 * max(sizes) / 2   # four sources
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert sum(r.length for r in packed) == sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in mixed)
    by = {}
    for r in packed:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    ends = [sum(n for _, n in pieces) for pieces in by.values()]
    assert all(n == 2048 or n & (n - 1) == 0 for n in ends)


def test_run_is_the_last_stage(spark, corpus):
    folder, _ = corpus
    a = sorted(tuple(r) for r in corpus_pipeline.run(spark, folder).select("doc_id", "length", "doc_tokens").collect())
    assert a and sum(x[1] for x in a) > 0


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows_and_clashing_columns(spark, tmp_path):
    """Nulls in every column, repeats, ties, a very long text and columns with the names that stages add."""
    rng = random.Random(13)

    def text(n):
        return " ".join(f"w{rng.randrange(9000)}" for _ in range(n))

    rows = [(i, text(rng.randrange(20, 80)), "en", "hot" if i % 3 else None, 1, True, 2.0, i, "x", 0) for i in range(40)]
    rows += [(None, text(50), None, None, None, None, None, None, None, None), (7, text(60), None, "s", 5, False, 1.0, 1, "y", 1), rows[3], rows[3],
             (90, text(60_000), "en", "hot", 9, True, 0.5, 2, "z", 2), (91, "", "en", "hot", 0, True, 0.5, 2, "z", 2), (92, None, "en", "hot", 0, True, 0.5, 2, "z", 2)]
    schema = SCHEMA + ", kept boolean, score double, d bigint, source_size string, copies int"
    docs = spark.createDataFrame(rows, schema).repartition(3)
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        stage(spark, docs, "").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert name == "packing" or docs.columns == columns
        assert docs.count() > 0
    ids = {r.doc_id for r in docs.collect()}
    assert None in ids and 90 in ids and not ids & {91, 92}
