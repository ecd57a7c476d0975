"""Row-local scoring of two texts: clipped n-gram matches and the longest common subsequence of their tokens.

Both compare the tokens of one row, so they need no shuffle, and neither a
join nor an aggregate per n-gram: rows go through Python once, in Arrow
batches, and are tokenized there.

Memory is bounded by bytes of text, not by rows: Spark cuts its Arrow batches by
bytes (``spark.sql.execution.arrow.maxBytesPerBatch``), and a batch is counted
in slices of at most ``MAX_BYTES`` (or one row).  N-grams of a slice
are numbered exactly, order by order, in a hash table.  The common subsequence uses
the bit-parallel algorithm of Crochemore, Iliopoulos, Pinzon and Reid (2001)
in blocks of ``BLOCK`` bits: a block of the shorter text meets the whole longer
one, and hands each position's carry to the next block, so masks take
``BLOCK`` bits a distinct token of the block, whatever the texts' length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from quire.functions.tokens import numbers

BLOCK = 4096
MAX_BYTES = 1 << 19   # n-gram numbers of a slice stay in the processor's cache


def _masks(tokens: Sequence) -> dict:
    """For each token the bits of its places."""
    masks: dict = {}
    bit = 1
    for token in tokens:
        masks[token] = masks.get(token, 0) | bit
        bit <<= 1
    return masks


def lcs_len(a: Sequence, b: Sequence, block: int = BLOCK) -> int:
    """Length of the longest common subsequence of ``a`` and ``b``."""
    if len(b) > len(a):
        a, b = b, a
    if len(b) <= block:
        get, full = _masks(b).get, (1 << len(b)) - 1
        v = full
        for token in a:
            if mask := get(token):
                u = v & mask
                v = ((v + u) | (v - u)) & full
        return len(b) - v.bit_count()
    carries, length = bytearray(len(a)), 0
    for start in range(0, len(b), block):
        part = b[start:start + block]
        bits, get, last = len(part), _masks(part).get, start + block >= len(b)
        full = v = (1 << bits) - 1
        for i, token in enumerate(a):
            mask, carry = get(token, 0), carries[i]
            if mask or carry:
                u = v & mask
                s = v + u + carry
                v = (s | (v - u)) & full
                if not last:
                    carries[i] = s >> bits
        length += bits - v.bit_count()
    return length


def clipped_matches(a: Sequence, b: Sequence, order: int) -> int:
    """N-grams of ``order`` that both sequences hold, each as often as in the one that has fewer."""
    if len(a) < order or len(b) < order:
        return 0
    if order == 1:
        return (Counter(a) & Counter(b)).total()
    return (Counter(zip(*(a[i:] for i in range(order)), strict=False)) & Counter(zip(*(b[i:] for i in range(order)), strict=False))).total()


class Tokens:
    """Tokens of some rows as numbers: all in one array, and where each row's start."""

    def __init__(self, rows: list[np.ndarray]):
        self.rows = rows
        self.sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        self.ends = np.concatenate([[0], np.cumsum(self.sizes)])
        self.flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)


def tokenized(texts: list[str | None], words: Callable[[str], list[str]]) -> Tokens:
    """Numbered tokens of texts; null counts as empty.  A text equal to the one before it is not tokenized again."""
    rows, last, ids = [], None, numbers([])
    for text in texts:
        if text != last:
            last, ids = text, numbers(words(text or ""))
        rows.append(ids)
    return Tokens(rows)


def all_clipped_matches(left: Tokens, right: Tokens, orders: int) -> list[np.ndarray]:
    """Per order 1..``orders`` and row, what :func:`clipped_matches` gives.

    Grams are numbered by (row, gram) over both sides, order by order: a gram
    is the number of its head and its last token.  One whose head is not on
    both sides is on neither's list of matches, so it is left out.
    """
    rows, n_left = len(left.sizes), len(left.flat)
    owner = np.concatenate([np.repeat(np.arange(rows), left.sizes), np.repeat(np.arange(rows), right.sizes)])
    token, words = pd.factorize(np.concatenate([left.flat, right.flat]))
    token, kinds = token.astype(np.int64), max(1, len(words))
    last = np.concatenate([np.repeat(left.ends[1:], left.sizes), np.repeat(right.ends[1:] + n_left, right.sizes)])   # where the row ends
    start, gram, out = np.arange(len(token)), owner, []
    for order in range(1, orders + 1):
        fits = start + order <= last[start]
        start, gram = start[fits], gram[fits]
        number, found = pd.factorize(gram * kinds + token[start + order - 1])
        cut = int(np.searchsorted(start, n_left))   # starts are in order: the left side's come first
        both = np.minimum(np.bincount(number[:cut], minlength=len(found)), np.bincount(number[cut:], minlength=len(found)))
        of = np.zeros(len(found), np.int64)
        of[number] = owner[start]
        out.append(np.bincount(of, weights=both, minlength=rows).astype(np.int64))
        shared = both[number] > 0
        start, gram = start[shared], number[shared].astype(np.int64)
    return out


def _slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` together, or one row."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right")))
        yield at, to
        at = to


def count_matches(rows: DataFrame, keys: list[str], texts: tuple[str, str], tokenizers: dict[str, Callable[[str], list[str]]],
                  grams: dict[str, list[str]], lcs: dict[str, str], max_bytes: int = MAX_BYTES) -> DataFrame:
    """The columns ``keys`` and counts (long) of the tokens of the two text columns ``texts``.

    By kind of token (a key of ``tokenizers``): ``n_left_<kind>`` and ``n_right_<kind>``, how many there are; in ``grams``
    the names for clipped matches of order 1, 2, ...; ``lcs`` gives the kind for each name of a common subsequence's length.
    """
    names = [f"n_{side}_{kind}" for kind in tokenizers for side in ("left", "right")] + [n for of in grams.values() for n in of] + list(lcs)

    def count(part: pa.RecordBatch) -> list[np.ndarray]:
        both = [part.column(len(keys) + i).to_pylist() for i in (0, 1)]
        tokens = {kind: [tokenized(side, words) for side in both] for kind, words in tokenizers.items()}
        out = [side.sizes for sides in tokens.values() for side in sides]
        for kind, of in grams.items():
            out += all_clipped_matches(*tokens[kind], len(of))
        for kind in lcs.values():
            out.append(np.array([lcs_len(a.tolist(), b.tolist()) for a, b in zip(tokens[kind][0].rows, tokens[kind][1].rows)], np.int64))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = sum(pc.fill_null(pc.binary_length(batch.column(len(keys) + i)), 0).to_numpy().astype(np.int64) for i in (0, 1))
            for at, to in _slices(sizes, max_bytes):
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keys)], *[pa.array(c, pa.int64()) for c in count(part)]], [*keys, *names])

    picked = rows.select(*keys, *texts)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in picked.select(*keys).schema)
    return picked.mapInArrow(run, schema + ", ".join(f"`{n}` bigint" for n in names))
