"""Removal of repeated byte strings by threshold-bounded interval expansion on a Burrows-Wheeler transform.

A byte goes when a string of ``length`` bytes that covers it starts earlier
too (in a smaller document, or earlier in the same one).  Three stages:

1. **Blocks.**  Every window of ``length`` bytes names the least hash of its
   ``GRAM``-byte grams (leftmost on ties) as its anchor, so equal windows have
   equal anchors at equal distances.  Successive windows with one anchor form a
   block, about 130 bytes long.  Equal blocks merge: the earliest stands for all,
   and its later copies are covered completely.  A task merges its own first, so
   a block that is everywhere gives a row for each ``COMBINE_ROWS`` of a task, not one for each copy; then
   narrow rows (anchor hash, block hash, place) are dealt by anchor hash.  Anchors with one distinct
   block are done, since no other block can share a window with them.
2. **Transform.**  The distinct blocks of the other anchors, with their bytes,
   are dealt by anchor hash.  A task joins whole anchors to texts of about
   ``TEXT_BYTES``, and derives common prefixes as in Beller, Gog, Ohlebusch and
   Schnattinger (2013): starting from the empty string, intervals of suffixes
   are extended backward, breadth first, on the transform; a boundary between
   neighbouring suffixes that an interval of level l ends at has a common prefix of
   l, once and for all.  Values come in increasing order, and the expansion
   stops at level ``length``.  Boundaries that are still open join suffixes that
   share ``length`` bytes or more: the equal windows.  All but the earliest of
   them are covered.
3. **Cut.**  Covered ranges return to their documents.

An anchor with more than ``HOT_BLOCKS`` distinct blocks would make too large a
text.  Its blocks are cut into single windows, which are dealt by the hash of
the whole window, where equal windows merge as in stage 1.  So no case is
dropped, and a task's memory is bounded.

Texts are shuffled once, by document, for both stages 2 and 3.  Blocks and
windows are compared by 64-bit hashes of their bytes beside the 64-bit anchor
hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 100
GRAM = 32
CHUNK = 1 << 19           # bytes hashed at once
TEXT_BYTES = 1 << 20      # bytes transformed at once, about
HOT_BLOCKS = 20_000       # about 3 MB
COMBINE_ROWS = 1 << 19    # block rows that a task merges at once, some 20 MB
FETCH_ROWS = 20_000       # blocks, or windows of hot ones, that are handed on at once, about
SYMBOL_BITS = 9           # bytes are symbols 1 to 256, 0 ends a block
ODD = 0x9E3779B97F4A7C15


# -- stage 1: blocks -----------------------------------------------------------------

class Hasher:
    """Hashes of all substrings of a chunk from prefix sums: sum of symbol value * ODD ** place, modulo 2 ** 64."""

    def __init__(self, size: int = CHUNK + 4 * LENGTH):
        self.values = np.random.default_rng(42).integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
        self.up, self.down = self._powers(ODD, size), self._powers(pow(ODD, -1, 1 << 64), size)

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        out = np.ones(size + 1, np.uint64)
        n = 1
        while n <= size:
            m = min(n, size + 1 - n)
            out[n:n + m] = out[:m] * np.uint64(pow(base, n, 1 << 64))
            n += m
        return out

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[:len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of [start, end), well mixed."""
        h = (sums[end] - sums[start]) * self.down[start]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(32))


def blocks(data: np.ndarray, doc: np.ndarray, hasher: Hasher, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(anchor hash, block hash, first window, last window) of the blocks of a chunk.  ``doc``: document number of each byte."""
    n = len(data)
    sums = hasher.sums(data)
    at = np.arange(n - gram + 1)
    h = hasher.of(sums, at, at + gram)
    # The order's key: 40 bits of the hash, then the place in the chunk, so that the least key is also a place.
    key = (h >> np.uint64(24) << np.uint64(24)) | at.astype(np.uint64)
    span, size = length - gram + 1, 1
    while 2 * size <= span:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    if size < span:
        key = np.minimum(key[:len(key) - (span - size)], key[span - size:])
    place = (key & np.uint64((1 << 24) - 1)).astype(np.int64)
    windows = np.flatnonzero(doc[:n - length + 1] == doc[length - 1:])
    if not len(windows):
        return tuple(np.empty(0, k) for k in (np.uint64, np.uint64, np.int64, np.int64))
    place = place[windows]
    cut = np.flatnonzero((place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1))
    first = windows[np.concatenate(([0], cut + 1))]
    last = windows[np.concatenate((cut, [len(windows) - 1]))]
    anchor = place[np.concatenate(([0], cut + 1))]
    whole = hasher.of(sums, first, last + length) ^ ((anchor - first).astype(np.uint64) * np.uint64(ODD))
    return h[anchor], whole, first, last


def _chunks(texts: Iterator[tuple[int, bytes]], length: int) -> Iterator[tuple[list[tuple[int, int]], list[bytes]]]:
    """Documents, or slices of long ones, gathered to chunks: ([(row, offset in its text)], [bytes]).  Slices overlap by
    ``length - 1`` bytes, so each window is in exactly one."""
    names, parts, size = [], [], 0
    for row, text in texts:
        for at in range(0, max(1, len(text) - length + 1), CHUNK):
            part = text[at:at + CHUNK + length - 1]
            if len(part) < length:
                continue
            if size + len(part) > CHUNK + length and parts:
                yield names, parts
                names, parts, size = [], [], 0
            names.append((row, at))
            parts.append(part)
            size += len(part)
    if parts:
        yield names, parts


# A block's place in its document in one long: first window << 8 | last window - first window; the complement for a covered block.
BLOCK_SCHEMA = "anchor bigint, block bigint, d bigint, e bigint, place bigint"
COVERED, DISTINCT, HOT = 0, 1, 2


def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's rows of BLOCK_SCHEMA with all but the earliest of equal blocks marked as covered: whatever other tasks hold
    can only be earlier still.  Those are dealt by document, not by anchor."""
    def merged(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        anchor, block, d, e, place = (np.concatenate(x) for x in zip(*held, strict=True))
        by = np.argsort(anchor.view(np.uint64) * np.uint64(ODD) ^ block.view(np.uint64))
        same = (anchor[by][1:] == anchor[by][:-1]) & (block[by][1:] == block[by][:-1])
        later = np.zeros(len(by), bool)
        if same.any():
            grouped = np.concatenate((same, [False])) | np.concatenate(([False], same))
            row, group = by[grouped], np.cumsum(np.concatenate(([True], ~same)))[grouped]
            order = np.lexsort((place[row], e[row], d[row], group))
            later[row[order][np.concatenate(([False], group[order][1:] == group[order][:-1]))]] = True
        anchor = np.where(later, (d.view(np.uint64) * np.uint64(ODD)).view(np.int64), anchor)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (anchor, block, d, e, np.where(later, ~place, place))], ["anchor", "block", "d", "e", "place"])

    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append([c.to_numpy() for c in batch.columns])
            n += batch.num_rows
        if n >= COMBINE_ROWS:
            yield merged(held)
            held, n = [], 0
    if held:
        yield merged(held)


def block_rows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Rows of BLOCK_SCHEMA from ``(d, e, text)``; ``text`` is binary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            d, e = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for names, parts in _chunks(((i, t.as_py()) for i, t in enumerate(batch.column(2))), length):
                sizes = [len(p) for p in parts]
                doc = np.repeat(np.arange(len(parts)), sizes)
                anchor, whole, first, last = blocks(np.frombuffer(b"".join(parts), np.uint8), doc, hasher, length)
                part = doc[first]
                begins = np.cumsum(sizes) - sizes
                row = np.array([r for r, _ in names])[part]
                start = first - begins[part] + np.array([a for _, a in names])[part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (anchor.view(np.int64), whole.view(np.int64), d[row], e[row], (start << 8) | (last - first))],
                    ["anchor", "block", "d", "e", "place"])

    return docs.mapInArrow(lambda batches: combined(run(batches)), BLOCK_SCHEMA)


def merge_blocks(rows: DataFrame, length: int = LENGTH, hot: int = HOT_BLOCKS) -> DataFrame:
    """``(kind, anchor, d, e, first, last)``: later copies of equal blocks are COVERED (bytes first to last - 1 of the
    document); the earliest is DISTINCT (windows first to last) if its anchor has other blocks, HOT if too many."""
    dealt = rows.repartition("anchor").sortWithinPartitions("anchor", "block", "d", "e", "place")
    names = ["kind", "anchor", "d", "e", "first", "last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 4   # anchor, d, e, place of distinct blocks of the anchor that may go on
        before, streaming = None, None       # the last row's anchor and block; an anchor known to be hot

        def out(kind: int, anchor: np.ndarray, d: np.ndarray, e: np.ndarray, place: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(anchor):
                first = place >> 8
                last = first + (place & 255) + (length if kind == COVERED else 0)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(anchor), kind, np.int32)), *map(pa.array, (anchor, d, e, first, last))], names)

        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            known = columns[4] < 0
            anchor, block, d, e, place = (c[known] for c in columns)
            yield from out(COVERED, anchor, d, e, ~place)
            anchor, block, d, e, place = (c[~known] for c in columns)
            if not len(anchor):
                continue
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (block[1:] != block[:-1])
            new[0] = before != (anchor[0], block[0])
            before = (anchor[-1], block[-1])
            yield from out(COVERED, anchor[~new], d[~new], e[~new], place[~new])
            fresh = [x[new] for x in (anchor, d, e, place)]
            if streaming is not None:
                more = fresh[0] == streaming
                yield from out(HOT, *[x[more] for x in fresh])
                fresh = [x[~more] for x in fresh]
                if not len(fresh[0]):
                    continue
                streaming = None
            held = [np.concatenate(x) for x in zip(held, fresh, strict=True)]
            if not len(held[0]):
                continue
            cut = int(np.searchsorted(held[0], held[0][-1]))
            yield from done([x[:cut] for x in held], out)
            held = [x[cut:] for x in held]
            if len(held[0]) > hot:
                streaming = held[0][0]
                yield from out(HOT, *held)
                held = [x[:0] for x in held]
        yield from done(held, out)

    def done(rows_: list[np.ndarray], out) -> Iterator[pa.RecordBatch]:
        if len(rows_[0]):
            _, at, n = np.unique(rows_[0], return_inverse=True, return_counts=True)
            yield from out(DISTINCT, *[x[(n[at] > 1) & (n[at] <= hot)] for x in rows_])
            yield from out(HOT, *[x[n[at] > hot] for x in rows_])

    return dealt.mapInArrow(run, "kind int, anchor bigint, d bigint, e bigint, first bigint, last bigint")


# -- stage 2: the transform ------------------------------------------------------------

def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols or more; prefix doubling.

    Places and ranks have 32 bits here and below, as a task's peak memory is some 50 bytes a symbol.
    """
    n, size = len(text), 63 // SYMBOL_BITS
    key = np.zeros(n, np.uint64)
    for i in range(size):
        key[:n - i] |= text[i:].astype(np.uint64) << np.uint64(SYMBOL_BITS * (size - 1 - i))
    while True:
        order = np.argsort(key).astype(np.int32)
        key = key[order]
        steps = np.concatenate(([False], key[1:] != key[:-1]))
        if size >= depth or steps.sum() == n - 1:
            return order
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(steps, dtype=np.uint32)
        key = rank << np.uint64(32)
        key[:n - size] |= rank[size:] + np.uint64(1)
        size *= 2


def open_boundaries(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each place of the suffix order whether it shares ``length`` symbols or more with the one before.

    ``text`` ends each block with symbol 0; a string that the expansion
    follows may end with 0 but not hold it elsewhere.
    """
    n = len(text)
    bwt = text[order - 1]
    by_symbol = np.argsort(bwt, kind="stable").astype(np.int32)  # place of the first column -> place of the last column
    to_first = np.empty(n, np.int32)
    to_first[by_symbol] = np.arange(n, dtype=np.int32)
    sorted_symbols = bwt[by_symbol]
    same = sorted_symbols[1:] == sorted_symbols[:-1]
    following = np.full(n, n, np.int32)                   # the next place with the same symbol
    following[by_symbol[:-1][same]] = by_symbol[1:][same]
    ranks = sorted_symbols.astype(np.int64) * (n + 1)     # increasing: occurrences of a symbol before a place, by search
    ranks += by_symbol
    del by_symbol, sorted_symbols, same
    closed = np.zeros(n + 1, bool)
    closed[0] = closed[n] = True
    low, high = np.array([0], np.int32), np.array([n], np.int32)
    for level in range(length):
        # The last occurrence of each symbol in each interval ends the interval of the string with that symbol in front.
        sizes = high - low
        total = np.cumsum(sizes, dtype=np.int32)
        place = np.arange(total[-1], dtype=np.int32)
        place += np.repeat(low - (total - sizes), sizes)
        last = following[place] >= np.repeat(high, sizes)
        if level:
            last &= bwt[place] != 0
        own = np.repeat(np.arange(len(low), dtype=np.int32), sizes)[last]
        place = place[last]
        end = to_first[place] + 1
        fresh = ~closed[end]
        place, end, own = place[fresh], end[fresh], own[fresh]
        if not len(place):
            break
        closed[end] = True                                # the common prefix at this boundary is ``level`` long
        low, high = np.searchsorted(ranks, bwt[place].astype(np.int64) * (n + 1) + low[own]).astype(np.int32), end
    return ~closed[:n]


def repeated_windows(pieces: list[bytes], d: np.ndarray, e: np.ndarray, first: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """(block, from, to): ranges of windows of the blocks, as offsets in them, that start earlier elsewhere.

    ``first`` is the place of each block's first byte in document (d, e).
    """
    sizes = np.array([len(p) for p in pieces], np.int32)
    begins = np.cumsum(sizes + 1, dtype=np.int32) - sizes - 1
    text = np.zeros(int(sizes.sum()) + len(pieces), np.uint16)
    block = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes + 1)
    offset = np.arange(len(text), dtype=np.int32)
    offset -= begins[block]
    text[offset < sizes[block]] = np.frombuffer(b"".join(pieces), np.uint8).astype(np.uint16) + 1
    order = suffix_order(text, length + 2)
    group = np.cumsum(~open_boundaries(text, order, length), dtype=np.int32)
    at_block, at = block[order], offset[order]
    del block, offset, order
    window = at <= sizes[at_block] - length
    group, at_block, at = group[window], at_block[window], at[window]
    # Windows alone in their group are first; of the others, all but the earliest.
    shared = np.bincount(group)[group] > 1
    group, at_block, at = group[shared], at_block[shared], at[shared]
    if not len(group):
        return
    by = np.lexsort((first[at_block] + at, e[at_block], d[at_block], group))
    later = by[np.concatenate(([False], group[by][1:] == group[by][:-1]))]
    b, o = at_block[later], at[later]
    by = np.lexsort((o, b))
    b, o = b[by], o[by]
    cut = np.flatnonzero((b[1:] != b[:-1]) | (o[1:] != o[:-1] + 1))
    for i, j in zip(np.concatenate(([0], cut + 1)).tolist(), np.concatenate((cut, [len(b) - 1])).tolist(), strict=True):
        if len(b):
            yield int(b[i]), int(o[i]), int(o[j])


def transform(distinct: DataFrame, length: int = LENGTH, text_bytes: int = TEXT_BYTES) -> DataFrame:
    """COVERED rows ``(d, e, first, last)`` from distinct blocks ``(anchor, d, e, first, bytes)``."""
    dealt = distinct.repartition("anchor").sortWithinPartitions("anchor")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, before = [], 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > text_bytes and row[0] != before:
                    yield from work(held)
                    held, size = [], 0
                before = row[0]
                held.append(row)
                size += len(row[4])
        if held:
            yield from work(held)

    def work(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        d, e, first = (np.array([r[i] for r in rows], np.int64) for i in (1, 2, 3))
        found = list(repeated_windows([r[4] for r in rows], d, e, first, length))
        if found:
            b, low, high = (np.array(x, np.int64) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (d[b], e[b], first[b] + low, first[b] + high + length)],
                                             ["d", "e", "first", "last"])

    return dealt.mapInArrow(run, "d bigint, e bigint, first bigint, last bigint")


# -- operator ----------------------------------------------------------------------------

def _keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """``docs`` with its order key ``(d, e)``: the id, and where ids repeat or are null, the text's hash behind it."""
    ids = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(id_col).isNull())
    tied = ids.limit(1).count() > 0
    e = F.xxhash64(F.col(text_col)) if tied else F.lit(0)
    return docs.withColumns({"d": F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)), "e": e.cast("long")}), tied


def covered(keyed: DataFrame, tied: bool, text_col: str, length: int, hot: int, text_bytes: int) -> DataFrame:
    """``(d, e, spans)``: the covered ranges of each document that has any."""
    texts = keyed.select("d", "e", F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("_text"))
    merged = merge_blocks(block_rows(texts.dropDuplicates(["d", "e"]) if tied else texts, length), length, hot)
    # A document's blocks that are asked for, as one row.
    wanted = merged.where(F.col("kind") != COVERED).groupBy("d", "e").agg(F.collect_list(F.struct("kind", "anchor", "first", "last")).alias("_wanted"))
    # All columns go along, so that this join and the last one share one shuffle of the documents.
    both = keyed.join(wanted, ["d", "e"]).select(*keyed.columns, "_wanted")
    if tied:
        both = both.dropDuplicates(["d", "e"])
    places = [both.columns.index(c) for c in ("d", "e", text_col, "_wanted")]

    def asked(batch: pa.RecordBatch, kind: int) -> Iterator[tuple[int, int, int, int, bytes]]:
        """(anchor, d, e, first, bytes) of the blocks of a kind that a batch's documents are asked for."""
        for d, e, text, wanted_ in zip(*(batch.column(i) for i in places), strict=True):
            blocks_ = [w for w in wanted_.as_py() if w["kind"] == kind]
            if blocks_:
                d, e, text = d.as_py(), e.as_py(), (text.as_py() or "").encode()
                for w in blocks_:
                    yield w["anchor"], d, e, w["first"], text[w["first"]:w["last"] + length]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["anchor", "d", "e", "first", "bytes"], [pa.int64()] * 4 + [pa.binary()]
        for batch in batches:
            rows = asked(batch, DISTINCT)
            while some := list(islice(rows, FETCH_ROWS)):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], names)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(2 * (256 + length))
        for batch in batches:
            rows = asked(batch, HOT)
            while some := list(islice(rows, FETCH_ROWS // 64)):
                anchor, d, e, first = (np.array(c, np.int64) for c in list(zip(*some, strict=True))[:4])
                whole, place = [], []
                for start, (*_, data) in zip(first, some, strict=True):
                    at = np.arange(len(data) - length + 1)
                    whole.append(hasher.of(hasher.sums(np.frombuffer(data, np.uint8)), at, at + length).view(np.int64))
                    place.append((start + at) << 8)
                n = list(map(len, whole))
                columns = (np.concatenate(whole), np.repeat(anchor, n), np.repeat(d, n), np.repeat(e, n), np.concatenate(place))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "block", "d", "e", "place"])

    ends = transform(both.mapInArrow(fetch, "anchor bigint, d bigint, e bigint, first bigint, bytes binary"), length, text_bytes)
    # Windows are cut and merged by one Python worker: a second mapInArrow in the stage would take one more for each core.
    again = merge_blocks(both.mapInArrow(lambda batches: combined(windows(batches)), BLOCK_SCHEMA), length, hot)
    spans = ends.unionByName(merged.where(F.col("kind") == COVERED).select("d", "e", "first", "last")).unionByName(
        again.where(F.col("kind") == COVERED).select("d", "e", "first", "last"))
    return spans.groupBy("d", "e").agg(F.collect_list(F.struct("first", "last")).alias("_spans"))


ADDED = ["n_bytes", "n_removed", "n_spans", "kept"]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The columns of ``docs`` plus ``n_bytes, n_removed, n_spans`` (long) and ``kept`` (binary: the remaining bytes).

    Null or empty text: empty, nothing removed.  Rows with one id are ordered
    by their texts' hashes; a null id is behind all others.  Rows repeated
    with id and text are one document: each gets its result.  An empty table
    gives an empty result.  A column of ``docs`` that has the name of one of these is replaced by it.
    """
    place = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    result = _remove(docs.toDF(*place.values()), place[id_col], place[text_col], **settings)
    return result.select(*[F.col(place[c]).alias(c) for c in docs.columns if c not in ADDED], *ADDED)


def _remove(docs: DataFrame, id_col: str, text_col: str, length: int = LENGTH, hot: int = HOT_BLOCKS, text_bytes: int = TEXT_BYTES,
            as_text: bool = False) -> DataFrame:
    """``docs``, whose columns are named ``_c<number>``, plus ``ADDED``; with ``as_text``, ``kept`` is a string of the whole characters
    that remain (what is left of one that was covered in part is dropped)."""
    if length <= GRAM:
        raise ValueError(f"length must be over {GRAM}")
    keyed, tied = _keyed(docs, id_col, text_col)
    spans = covered(keyed, tied, text_col, length, hot, text_bytes)
    joined = keyed.join(spans, ["d", "e"], "left").select(*docs.columns, "_spans")
    names = [*docs.columns, *ADDED]
    place = docs.columns.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, kept = [], []
            for text, spans_ in zip(batch.column(place), batch.column(batch.num_columns - 1), strict=True):
                data = (text.as_py() or "").encode()
                left, end, removed, runs, at = [], -1, 0, 0, 0
                for first, last in sorted((s["first"], s["last"]) for s in spans_.as_py() or ()):
                    if first > end:  # runs that touch are one
                        left.append(data[at:first])
                        runs += 1
                        removed += last - first
                        end = last
                    elif last > end:
                        removed += last - end
                        end = last
                    at = end
                left.append(data[at:])
                numbers.append((len(data), removed, runs))
                # Part by part, so that no character comes about from pieces of two.
                kept.append("".join(part.decode("utf-8", "ignore") for part in left) if as_text else b"".join(left))
            columns = [pa.array([n[i] for n in numbers], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns, pa.array(kept, pa.string() if as_text else pa.binary())], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return joined.mapInArrow(cut, schema + ", n_bytes bigint, n_removed bigint, n_spans bigint, kept " + ("string" if as_text else "binary"))


def cut_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str = "n_chars", **settings) -> DataFrame:
    """``docs`` with the covered bytes cut out of its texts, and ``count_col`` (if there is one) counted anew.

    A character stays in part only if some of its bytes are covered; such
    torn characters are dropped.  Null texts stay null.
    """
    place = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    result = _remove(docs.toDF(*place.values()), place[id_col], place[text_col], **settings, as_text=True)
    old = F.col(place[text_col])
    same = (F.col("n_removed") == 0) | old.isNull()
    text = F.when(same, old).otherwise(F.col("kept"))
    new = {text_col: text}
    if count_col in place:
        new[count_col] = F.when(same, F.col(place[count_col])).otherwise(F.length(text).cast(docs.schema[count_col].dataType))
    return result.select(*[new.get(c, F.col(place[c])).alias(c) for c in docs.columns])


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
