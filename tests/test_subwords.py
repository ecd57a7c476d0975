"""Subword counts by pieces against plain encoding of whole texts."""

import json
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quire.functions.subwords import SubwordCounter, cuts_at_spaces
from quire.operators import profile as P
from quire.plans import queries as Q

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
PARTS = ["a", "The", "word", " ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", "\xa0", "　", ".", ",", "'s", "12", "é", "É", "̈", "😀", "x" * 70, "<|endoftext|>",
         "<|EndOfText|>", "-", "İ", "​"]


def plain(path, texts):
    return [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts)]


@pytest.mark.parametrize("name", FILES)
@pytest.mark.parametrize("pieces", [5, 1000])
def test_as_plain_encoding(name, pieces, monkeypatch):
    import quire.functions.subwords as S

    monkeypatch.setattr(S, "CHUNK_CHARS", 200)
    rng = random.Random(7)
    texts = ["", " ", *["".join(rng.choices(PARTS, k=rng.randrange(30))) for _ in range(1500)], "word " * 30_000]
    counter = SubwordCounter(public_tokenizers.path(name), pieces)
    assert counter.cuts
    assert list(counter.counts(texts)) == plain(public_tokenizers.path(name), texts)
    assert list(counter.counts([None])) == list(counter.counts([""]))
    assert len(counter.old) + len(counter.young) < 2 * pieces + 300 and all(len(p) <= S.MAX_PIECE_CHARS for p in counter.young)


def test_frequent_pieces_stay():
    counter = SubwordCounter(public_tokenizers.path(FILES[0]), 10)
    for i in range(30):
        list(counter.counts([" the " + " ".join(f"rare{i}x{k}" for k in range(6))]))
        assert " the" in {*counter.young, *counter.old}
    assert len(counter.young) + len(counter.old) < 30


def test_other_tokenizers_are_encoded_whole(tmp_path):
    file = json.loads(Tokenizer.from_file(public_tokenizers.path(FILES[0])).to_str())
    assert cuts_at_spaces(file)
    file["pre_tokenizer"]["add_prefix_space"] = True
    assert not cuts_at_spaces(file)
    assert not cuts_at_spaces({"pre_tokenizer": None, "normalizer": None})
    path = str(tmp_path / "t.json")
    open(path, "w").write(json.dumps(file))
    texts = ["a word", " a  b\n", "", "The"]
    assert list(SubwordCounter(path).counts(texts)) == plain(path, texts)


def test_query_counts_whole_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in Q.T.table(spark, sf, "documents").collect()}
    got = {r.rid: r.n_tokens for r in Q.t1_subword(spark, sf).collect()}
    assert got == dict(zip(docs, plain(public_tokenizers.path(FILES[0]), list(docs.values()))))
    df = spark.createDataFrame([(None,), ("a b",)], "text string")
    assert [r.n_tokens for r in P.token_lengths(df, counter=P.tokenizer_counter(public_tokenizers.path(FILES[0]))).orderBy(F.col("text").asc_nulls_first()).collect()] == [0, 2]
