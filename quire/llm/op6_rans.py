"""Token ids in files coded by a static range asymmetric numeral system (rANS).

A file is a run of records, each ``b"QRNS"``, version, kind, length, CRC-32
and body, followed by a line feed.  A table record holds symbol frequencies
that sum to ``2 ** bits``; all block records up to the next table share it.  A
block codes up to ``BLOCK`` ids and decodes by itself: ``LANES`` interleaved
64-bit states share one stream of 32-bit words, lane by lane, so a step of the
coder is one vector operation over the lanes.  Every ``CHECKPOINT`` steps a
checkpoint keeps the states and the place in the stream, so the parts of a
block decode in parallel (here as more lanes of the same operations), each on
its own.  A block also holds the CRC-32 of its ids and the table of the
documents that begin in it.

Rows are dealt to files by ranges of ids, and sorted in them, so files in the
order of their numbers hold documents in ascending order.  A task tokenizes,
counts, codes and writes a share of ``TABLE_IDS`` ids at a time.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.bytefiles import read_files, write_records
from quire.llm.common import checkpointed, counted_broadcast, remove
from quire.llm.tokens import chunks, encoder
from quire.session import scratch_path

END_ID = 2
LANES = 512
BLOCK = 1 << 18
CHECKPOINT = 128          # steps between checkpoints
FILE_BYTES = 32 << 20     # bytes of text a file holds, about
TABLE_IDS = 1 << 23       # ids a frequency table is counted over, about
MAGIC, VERSION = b"QRNS", 1
TABLE, DATA = 0, 1
HEAD = "<4sBBII"          # magic, version, kind, length, CRC-32
BLOCK_HEAD = "<IHIIII"   # ids, lanes, CRC-32 of the ids, documents, checkpoints, words
LOW = np.uint64(1 << 31)                # a state is in [LOW, LOW << 32)


# -- frequency table -----------------------------------------------------------------

class Table:
    """Frequencies of symbols, scaled to a power of two; every symbol that occurs keeps at least one slot."""

    def __init__(self, symbols: np.ndarray, freqs: np.ndarray, bits: int):
        self.symbols, self.freqs, self.bits = symbols, freqs, bits
        self.starts = np.cumsum(freqs) - freqs
        self.slots = np.repeat(np.arange(len(symbols)), freqs)

    @classmethod
    def counted(cls, ids: np.ndarray) -> Table:
        symbols, counts = np.unique(ids, return_counts=True)
        bits = min(24, max(16, int(len(symbols) - 1).bit_length() + 2))
        total = 1 << bits
        freqs = np.maximum(1, counts * total // counts.sum())
        over = int(freqs.sum()) - total
        if over < 0:
            freqs[np.argmax(counts)] -= over
        # The most frequent symbols give back what rounding up took.
        order = np.argsort(-freqs, kind="stable")
        while over > 0:
            take = np.minimum(freqs[order] // 2, over // len(order) + 1)
            take = np.where(np.cumsum(take) <= over, take, np.maximum(0, over - (np.cumsum(take) - take)))
            freqs[order] -= take
            over -= int(take.sum())
        return cls(symbols.astype(np.uint32), freqs.astype(np.int64), bits)

    def pack(self) -> bytes:
        return bytes([self.bits]) + zlib.compress(
            np.diff(self.symbols.astype("<u4"), prepend=np.uint32(0)).astype("<u4").tobytes() + self.freqs.astype("<u4").tobytes(), 6)

    @classmethod
    def unpack(cls, body: bytes) -> Table:
        both = np.frombuffer(zlib.decompress(body[1:]), "<u4")
        n = len(both) // 2
        return cls(np.cumsum(both[:n]).astype(np.uint32), both[n:].astype(np.int64), body[0])


# -- blocks --------------------------------------------------------------------------

def encode_block(ids: np.ndarray, table: Table, doc_ids: list, doc_lengths: list[int], lanes: int = LANES) -> bytes:
    """The body of a block record."""
    n, bits = len(ids), np.uint64(table.bits)
    place = np.searchsorted(table.symbols, ids)
    freq, start = table.freqs.astype(np.uint64)[place], table.starts.astype(np.uint64)[place]
    limit = freq << (np.uint64(63) - bits)
    x = np.full(lanes, LOW, np.uint64)
    words, checkpoints, written = [], [], 0
    for step in range((n - 1) // lanes, -1, -1):
        at = slice(step * lanes, min(n, (step + 1) * lanes))
        f, s, y = freq[at], start[at], x[:min(lanes, n - step * lanes)]
        full = y >= limit[at]
        out = y[full]
        if len(out):
            words.append(out.astype(np.uint32))  # the low half
            written += len(out)
            y[full] = out >> np.uint64(32)
        q, r = np.divmod(y, f)
        y[:] = (q << bits) + r + s
        if step % CHECKPOINT == 0:
            checkpoints.append((written, x.copy()))
    stream = np.concatenate(words[::-1]) if words else np.empty(0, np.uint32)
    checkpoints.reverse()
    head = struct.pack(BLOCK_HEAD, n, lanes, zlib.crc32(ids.astype("<u4").tobytes()), len(doc_ids), len(checkpoints), len(stream))
    known = np.array([d is not None for d in doc_ids], np.uint8)
    docs = np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes() + known.tobytes() + np.array(doc_lengths, "<u8").tobytes()
    places = np.array([len(stream) - w for w, _ in checkpoints], "<u4").tobytes()
    states = b"".join(s.astype("<u8").tobytes() for _, s in checkpoints)
    return head + docs + places + states + stream.astype("<u4").tobytes()


class Block:
    """A block record's parts."""

    def __init__(self, body: bytes):
        self.n, self.lanes, self.crc, docs, marks, words = struct.unpack_from(BLOCK_HEAD, body)
        at = struct.calcsize(BLOCK_HEAD)

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(body, kind, count, at)
            at += out.nbytes
            return out

        ids, known, self.doc_lengths = take("<i8", docs), take("u1", docs), take("<u8", docs)
        self.doc_ids = [d if k else None for d, k in zip(ids.tolist(), known.tolist(), strict=True)]
        self.places = take("<u4", marks).astype(np.int64)
        self.states = take("<u8", marks * self.lanes).reshape(marks, self.lanes)
        self.words = take("<u4", words).astype(np.uint64)

    def decode(self, table: Table) -> np.ndarray:
        """All ids: the parts behind full checkpoints side by side, then the last part; the checksum is verified."""
        part = CHECKPOINT * self.lanes
        whole = self.n // part
        out = np.empty(self.n, np.uint32)
        if whole:
            out[:whole * part] = self.decode_parts(table, 0, whole)
        if whole * part < self.n:
            out[whole * part:] = self.decode_parts(table, whole, whole + 1)
        if zlib.crc32(out.astype("<u4").tobytes()) != self.crc:
            raise ValueError("a block's ids do not match their checksum")
        return out

    def decode_parts(self, table: Table, first: int, last: int) -> np.ndarray:
        """The ids behind the checkpoints ``first`` to ``last - 1``, decoded in step; nothing before them is read."""
        parts, lanes, bits = last - first, self.lanes, np.uint64(table.bits)
        n = min(CHECKPOINT * lanes, self.n - first * CHECKPOINT * lanes)
        x, at = self.states[first:last].astype(np.uint64), self.places[first:last].copy()
        mask = np.uint64((1 << table.bits) - 1)
        freqs, starts = table.freqs.astype(np.uint64), table.starts.astype(np.uint64)
        out = np.empty((parts, n), np.uint32)
        for low in range(0, n, lanes):
            width = min(lanes, n - low)
            y = x[:, :width]
            slot = y & mask
            place = table.slots[slot.astype(np.int64)]
            out[:, low:low + width] = table.symbols[place]
            y = freqs[place] * (y >> bits) + slot - starts[place]
            short = y < LOW
            taken = np.cumsum(short, axis=1)
            if taken[:, -1].any():
                where = (at[:, None] + taken - 1)[short]
                if where.max() >= len(self.words):
                    raise ValueError("a block's stream ends too early")
                y[short] = (y[short] << np.uint64(32)) | self.words[where]
                at += taken[:, -1]
            x[:, :width] = y
        return out.reshape(-1)


def record(kind: int, body: bytes) -> bytes:
    """A record without its closing line feed, which the file writer adds."""
    return struct.pack(HEAD, MAGIC, VERSION, kind, len(body), zlib.crc32(body)) + body


def records(content: bytes) -> Iterator[tuple[int, bytes]]:
    at, head = 0, struct.calcsize(HEAD)
    while at < len(content):
        magic, version, kind, size, crc = struct.unpack_from(HEAD, content, at)
        body = content[at + head:at + head + size]
        at += head + size + 1
        if magic != MAGIC or version != VERSION or zlib.crc32(body) != crc or content[at - 1:at] != b"\n":
            raise ValueError(f"damaged record before byte {at}")
        yield kind, body


def encode_share(doc_ids: list, docs: list[np.ndarray], block: int = BLOCK) -> Iterator[bytes]:
    """A table record and the block records of some documents' ids (each with at least one id)."""
    ids = np.concatenate(docs)
    table = Table.counted(ids)
    yield record(TABLE, table.pack())
    lengths = np.array([len(d) for d in docs])
    begins = np.cumsum(lengths) - lengths
    for at in range(0, len(ids), block):
        a, b = np.searchsorted(begins, [at, at + block])
        yield record(DATA, encode_block(ids[at:at + block], table, doc_ids[a:b], lengths[a:b].tolist()))


# -- files ---------------------------------------------------------------------------

def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text",
                 file_bytes: int = FILE_BYTES, table_ids: int = TABLE_IDS) -> None:
    """Writes the ids of every row, by ascending id (null first, ties by the text's hash, then the text), into files of about
    ``file_bytes`` of text, so that a task reads a file of bounded size, however large the table is.

    Texts are shuffled once, before they are tokenized, so that finding the
    ranges does not tokenize them.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long") + 8)).first()[0] or 0
    files = max(1, -(-size // file_bytes))
    hashed = rows.withColumn("hash", F.xxhash64("text"))
    dealt = hashed.repartitionByRange(files, "id", "hash").sortWithinPartitions("id", "hash", "text").select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = encoder(tokenizer)
        ids, held, n = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            for data in encode_share(ids, held):
                yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["record"])

        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, texts in chunks(batch.column(1)):
                for name, t in zip(names[first:], tok.ids(texts), strict=False):
                    ids.append(name)
                    held.append(np.append(t, np.uint32(end_id)))
                    n += len(held[-1])
                if n >= table_ids:
                    yield from flush()
                    ids, held, n = [], [], 0
        if held:
            yield from flush()

    write_records(dealt.mapInArrow(run, "record binary"), path, "record", "\n")


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``(file, doc_id, before, n_tokens, ids_crc32[, ids])``: every document of the files; ``before`` counts the
    ids of the file's earlier documents, ``ids`` are little-endian 32-bit numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from of_file(batch.column(0)[i].as_py(), batch.column(1)[i].as_py())

    def of_file(file: int, content: bytes) -> Iterator[pa.RecordBatch]:
        table, before = None, 0
        open_id, missing, parts = None, 0, []   # a document whose ids go on in the next block
        for kind, body in records(content):
            if kind == TABLE:
                table = Table.unpack(body)
                continue
            block = Block(body)
            ids, at, rows = block.decode(table), 0, []
            for doc_id, length in [(None, None)] * bool(missing) + list(zip(block.doc_ids, block.doc_lengths.tolist(), strict=True)):
                if length is not None:
                    open_id, missing, parts = doc_id, length, []
                part = ids[at:at + missing]
                parts.append(part)
                at, missing = at + len(part), missing - len(part)
                if not missing:
                    data = np.concatenate(parts).astype("<u4").tobytes()
                    rows.append((open_id, before, len(data) // 4, zlib.crc32(data), data))
                    before += len(data) // 4
            if rows:
                columns = list(zip(*rows, strict=True))
                arrays = [pa.array([file] * len(rows), pa.int64()), *[pa.array(c, pa.int64()) for c in columns[:4]]]
                arrays += [pa.array(columns[4], pa.binary())] * with_ids
                yield pa.RecordBatch.from_arrays(arrays, ["file", "doc_id", "before", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)

    files = read_files(spark, path).select(F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("long").alias("file"), "content")
    return files.mapInArrow(run, "file bigint, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids)


def starts(rows: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all documents before the row's; a running total over one row per file.  ``rows``: checkpointed."""
    sums = rows.groupBy("file").agg(F.sum("n_tokens").alias("_n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = checkpointed(sums.select("file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")))
    return rows.join(counted_broadcast(offsets), "file").withColumn("start", F.col("_offset") + F.col("before")).drop("_offset")


def op6_rans(spark, sf_dir: str) -> DataFrame:
    """Null or empty texts have the end id only.  Repeated rows are documents of their own.  Other columns are not read."""
    import public_tokenizers

    path = scratch_path(spark, "rans")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path("word_bpe_49k.json"))
    rows = checkpointed(read_tokens(spark, path, with_ids=False))
    remove(spark, path)
    return starts(rows).select("doc_id", "start", "n_tokens", "ids_crc32")
