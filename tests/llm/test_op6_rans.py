import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quire.llm import op6_rans as op
from quire.llm.bytefiles import read_files

PATH = public_tokenizers.path("word_bpe_49k.json")


def coded(docs, block=op.BLOCK):
    content = b"".join(r + b"\n" for r in op.encode_share(list(range(len(docs))), docs, block))
    table, blocks = None, []
    for kind, body in op.records(content):
        if kind == op.TABLE:
            table = op.Table.unpack(body)
        else:
            blocks.append(op.Block(body))
    return content, table, blocks


@pytest.mark.parametrize("n", [1, 2, 511, 512, 513, 70_000, 300_001])
def test_round_trip(n):
    rng = np.random.default_rng(n)
    cuts = np.unique(np.concatenate(([0, n], rng.integers(0, n + 1, 20))))
    docs = [rng.zipf(1.3, k).clip(0, 49_407).astype(np.uint32) for k in np.diff(cuts)]
    content, table, blocks = coded(docs)
    assert int(table.freqs.sum()) == 1 << table.bits and (table.freqs > 0).all()
    assert (np.concatenate([b.decode(table) for b in blocks]) == np.concatenate(docs)).all()
    assert sum(len(b.doc_ids) for b in blocks) == len(docs)


def test_one_symbol_and_many_symbols():
    for ids in (np.full(5000, 7, np.uint32), np.arange(60_000, dtype=np.uint32), np.array([2**32 - 1, 0], np.uint32)):
        _, table, blocks = coded([ids])
        assert (np.concatenate([b.decode(table) for b in blocks]) == ids).all()


def test_checkpoints_decode_by_themselves():
    ids = np.random.default_rng(1).zipf(1.4, 250_000).clip(0, 9999).astype(np.uint32)
    _, table, (block,) = coded([ids])
    part = op.CHECKPOINT * block.lanes
    for i in range(len(block.places)):
        assert (block.decode_parts(table, i, i + 1) == ids[i * part:(i + 1) * part]).all()


def test_damage_is_noticed():
    content, table, (block,) = coded([np.arange(20_000, dtype=np.uint32)])
    for at in (2, 30, len(content) // 2, len(content) - 1):
        bad = bytearray(content)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            list(op.records(bytes(bad)))
    block.words = block.words.copy()
    block.words[3] ^= np.uint64(1)
    with pytest.raises(ValueError):
        block.decode(table)


def test_files_hold_documents_in_order(spark, odd_docs, odd_rows, tmp_path):
    whole = Tokenizer.from_file(PATH)
    path = str(tmp_path / "files")
    op.write_tokens(odd_docs, path, PATH, file_bytes=80_000, table_ids=5000)
    size = sum(len((r[1] or "").encode()) + 8 for r in odd_rows)
    assert read_files(spark, path).count() == -(-size // 80_000) > 2
    rows = {r.doc_id: r for r in op.starts(op.read_tokens(spark, path)).collect()}
    at = 0
    for d, text, *_ in sorted(odd_rows, key=lambda r: r[0]):
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        r = rows[d]
        assert (r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (at, len(ids) // 4, zlib.crc32(ids), ids)
        at += len(ids) // 4


def test_odd_inputs(spark, clashing, no_docs, tmp_path):
    for name, docs in (("a", clashing), ("b", no_docs)):
        op.write_tokens(docs, str(tmp_path / name), PATH, file_bytes=2000)
        rows = op.starts(op.read_tokens(spark, str(tmp_path / name), with_ids=False)).collect()
        assert len(rows) == docs.count()
        ends = sorted((r.start, r.start + r.n_tokens) for r in rows)
        assert all(a[1] == b[0] for a, b in zip(ends, ends[1:]))  # noqa: B905
        if rows:
            assert min(rows, key=lambda r: r.start).doc_id is None  # null is first


def test_any_bound_of_file_size_gives_the_same_rows(spark, odd_docs, tmp_path):
    """Many small files, or one: the same starts, lengths and checksums."""
    got = []
    for size in (3000, 1 << 30):
        path = str(tmp_path / str(size))
        op.write_tokens(odd_docs, path, PATH, file_bytes=size)
        got.append((read_files(spark, path).count(), sorted(tuple(r) for r in op.starts(op.read_tokens(spark, path, with_ids=False)).select(
            "doc_id", "start", "n_tokens", "ids_crc32").collect())))
    assert got[0][0] > 20 and got[1][0] == 1 and got[0][1] == got[1][1]
