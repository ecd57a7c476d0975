import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quire.llm import op4_packing as op
from quire.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_encode_as_whole_texts(name):
    path = public_tokenizers.path(name)
    encoder, whole = Encoder(path), Tokenizer.from_file(path)
    rng = random.Random(1)
    parts = ["a", "Word", "ß", "é", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", "　", "'s", "'ll", "12", ".", "!!", "中文",
             "🙂", "Σ", "İ", "́", "\x00", "<|endoftext|>", "<|startoftext|>", "​", "\x0b", ",", "ñandú", "Ÿ", "ĳ", "straße", "DON'T", "ªº"]
    texts = ["", " ", "\n"] + ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(4000)]
    got = [ids.tolist() for i in range(0, len(texts), 64) for ids in encoder.ids(texts[i:i + 64])]
    assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def check(rows, docs, capacity):
    """docs: {id: ids with the end id}."""
    for d, ids in docs.items():
        at = 0
        for r in sorted((r for r in rows if r.doc_id == d), key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == capacity or at & (at - 1) == 0
    assert sorted(by) == list(range(len(by)))


@pytest.mark.parametrize("capacity", [2048, 64, 100])
def test_every_id_once_and_sequences_full(odd_docs, odd_rows, tokenizer, capacity):
    docs = {r[0]: tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in odd_rows}
    rows = op.pack(odd_docs, PATH, capacity=capacity).collect()
    check(rows, docs, capacity)
    if capacity == 64:  # each full sequence holds every source's share to within a token at either end
        source = {r[0]: r[3] for r in odd_rows}
        total, share = sum(map(len, docs.values())), {}
        for d, ids in docs.items():
            share[source[d]] = share.get(source[d], 0) + len(ids) / total
        for w in range(total // capacity):
            for s, p in share.items():
                n = sum(r.length for r in rows if r.sequence_id == w and source[r.doc_id] == s)
                assert abs(n - p * capacity) <= 3


def test_any_queues_fill_every_window():
    for trial in range(200):
        rng = random.Random(trial)
        own = [rng.choice([1, 3, rng.randrange(1, 300), rng.randrange(1, 3000)]) for _ in range(rng.randrange(1, 12))]
        capacity, total = rng.choice([8, 64, 100]), sum(own)
        windows, sequences, below = op.Windows(total, capacity), {}, 0
        for size in own:
            at = 0
            while at < size:
                n = min(size - at, rng.randrange(1, 60))
                pieces = op.cut(at, n, below, size, windows)
                assert [p[0] for p in pieces] == [sum(p[1] for p in pieces[:i]) for i in range(len(pieces))]
                assert sum(p[1] for p in pieces) == n
                for _, length, w, offset in pieces:
                    sequences.setdefault(w, []).append((offset, length))
                at += n
            below += size
        assert sorted(sequences) == list(range(windows.count))
        for w, pieces in sequences.items():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at == windows.edge(w + 1) - windows.edge(w)


def test_window_edges_past_64_bits():
    windows = op.Windows(10**15 + 77, 2048)
    pieces = op.cut(3 * 10**14 - 5, 5000, 2 * 10**14 + 1, 4 * 10**14, windows)
    assert sum(p[1] for p in pieces) == 5000 and pieces[0][0] == 0
    assert all(0 <= p[3] and p[3] + p[1] <= 2048 for p in pieces)


def test_odd_inputs(clashing, no_docs, tokenizer):
    rows = op.pack(clashing, PATH).collect()
    assert sum(r.length for r in rows) == sum(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in clashing.collect())
    assert op.pack(no_docs, PATH).count() == 0
    assert "ids" not in op.pack(no_docs, PATH, with_ids=False).columns
