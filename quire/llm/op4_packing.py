"""Mixture-controlled packing: deficit round-robin over source queues.

Each source is a queue of its documents' tokens, and a window is one sequence
of ``capacity`` tokens that takes each queue's share of them.  Shares are not
whole, so a queue serves whole tokens, and the rest is a deficit that later
windows serve.

The deficits of all windows are carried along a binary tree over the windows.
Its root holds all tokens, as running totals C_1 <= C_2 <= ... over the queues
in turn.  A node with T tokens gives its left half, with L of them,
``C * L div T`` of each total, and the right half what is left: a fraction of a
token that the left half could not serve is the deficit its right neighbour
serves.  Totals stay in order, so each half serves every queue its share,
rounded up or down, and both halves are full.  At a leaf, the totals are the
places in the sequence where the queues' turns begin and end.

A queue's way down the tree needs its own two totals only.  So a document
finds its windows and places by itself, in any task, in steps logarithmic in the
number of windows; no task holds a queue, and all queues run dry in the last window.

The last ``N mod capacity`` tokens fill sequences whose lengths are powers of
two, so nothing is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import checkpointed, counted_broadcast
from quire.llm.tokens import chunks, encoder

CAPACITY = 2048
END_ID = 1


def token_table(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``(id, source, part, before, n, ids)`` per row, checkpointed.

    ``part`` is the task, ``before`` the tokens of the same source earlier in
    the task: a row's place in its source's queue needs no second look at the
    ids.  ``ids`` are little-endian 16-bit numbers, or 32-bit where an id needs it.
    """
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tok, part = encoder(tokenizer), TaskContext.get().partitionId()
        queued: dict[str | None, int] = {}
        for batch in batches:
            sources = batch.column(1).to_pylist()
            for first, texts in chunks(batch.column(2)):
                before, n, data = [], [], []
                for source, ids in zip(sources[first:], tok.ids(texts), strict=False):
                    ids = np.append(ids, np.uint32(end_id))
                    before.append(queued.get(source, 0))
                    n.append(len(ids))
                    queued[source] = before[-1] + len(ids)
                    data.append((ids.astype("<u2") if ids.max() < 1 << 16 else ids.astype("<u4")).tobytes())
                part_rows = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [part_rows.column(0), part_rows.column(1), pa.array([part] * len(texts), pa.int32()), pa.array(before, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(data, pa.binary())], ["id", "source", "part", "before", "n", "ids"])

    return checkpointed(rows.mapInArrow(run, f"id {kind}, source string, part int, before bigint, n bigint, ids binary"))


def queue_starts(tokens: DataFrame) -> DataFrame:
    """``(source, part, start, below, own, total)``: where a task's rows start in their queue, the tokens of
    the queues before it, of the queue, and of all.  Decimals, as sums may outgrow a long when multiplied."""
    sums = checkpointed(tokens.groupBy("source", "part").agg(F.sum("n").alias("sum")))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("sum").over(earlier), F.lit(0)))
    # One row per source; null is the last queue.
    queues = sums.groupBy("source").agg(F.sum("sum").alias("own"))
    turn = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    queues = queues.withColumn("below", F.coalesce(F.sum("own").over(turn), F.lit(0))).withColumn("total", F.sum("own").over(Window.partitionBy()))
    queues = queues.select(F.col("source").alias("_s"), "own", "below", "total")
    return checkpointed(starts.join(queues, F.col("source").eqNullSafe(F.col("_s"))).select("source", "part", "start", "below", "own", "total"))


class Windows:
    """The sequences: full windows, then powers of two."""

    def __init__(self, total: int, capacity: int):
        self.capacity, self.full = capacity, total // capacity
        rest, at = total % capacity, self.full * capacity
        self.tail = [at]
        size = 1 << max(0, capacity.bit_length() - 1)
        while rest:
            while size > rest:
                size >>= 1
            rest -= size
            self.tail.append(self.tail[-1] + size)

    def edge(self, w: int) -> int:
        """Tokens in the sequences before number w."""
        return w * self.capacity if w <= self.full else self.tail[w - self.full]

    @property
    def count(self) -> int:
        return self.full + len(self.tail) - 1


def cut(start: int, n: int, below: int, own: int, windows: Windows) -> list[tuple[int, int, int, int]]:
    """(from, length, sequence, offset) of the pieces of a document at places start .. start + n of its queue,
    which has ``own`` tokens behind ``below`` of the queues before it."""
    end, out = start + n, []
    # Nodes to visit: windows [first, last), the queue's totals in the node, and the queue's place where the node begins.
    todo = [(0, windows.count, below, below + own, 0)]
    while todo:
        first, last, low, high, at = todo.pop()
        if low == high or at >= end or at + high - low <= start:
            continue
        if last - first == 1:
            a, b = max(start, at), min(end, at + high - low)
            out.append((a - start, b - a, first, low + a - at))
            continue
        middle = (first + last) // 2
        left = windows.edge(middle) - windows.edge(first)
        total = windows.edge(last) - windows.edge(first)
        low_left, high_left = low * left // total, high * left // total
        todo.append((middle, last, low - low_left, high - high_left, at + high_left - low_left))
        todo.append((first, middle, low_left, high_left, at))
    return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source", with_ids: bool = True) -> DataFrame:
    """One row per piece: ``(id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids)``.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers;
    without ``with_ids`` the column is left out.
    Null or empty texts have the end id only, and so one piece.  A null source
    is the last queue.  Repeated rows are documents of their own.  An empty
    table gives an empty result.  Columns not named are not read.
    """
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    tokens = token_table(docs, tokenizer, end_id, id_col, text_col, source_col)
    starts = queue_starts(tokens)
    placed = tokens.alias("t").join(counted_broadcast(starts).alias("s"), F.col("t.source").eqNullSafe(F.col("s.source")) & (F.col("t.part") == F.col("s.part"))).select(
        "id", (F.col("start") + F.col("before")).cast("long").alias("start"), "n", *[F.col(c).cast("long") for c in ("below", "own", "total")], "ids")
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = None
        for batch in batches:
            starts, ns, below, own, total = (batch.column(i).to_pylist() for i in range(1, 6))
            rows, columns = [], [[] for _ in names[1:]]

            def flush() -> pa.RecordBatch:
                out = [batch.column(0).take(pa.array(rows, pa.int64()))]
                out += [pa.array(c, pa.binary() if k == "ids" else pa.int64()) for k, c in zip(names[1:], columns, strict=True)]
                rows.clear()
                for c in columns:
                    c.clear()
                return pa.RecordBatch.from_arrays(out, names)

            for i in range(batch.num_rows):
                windows = windows or Windows(total[i], capacity)
                data = batch.column(6)[i].as_buffer()
                ids = np.frombuffer(data, "<u2" if data.size == 2 * ns[i] else "<u4").astype("<u4")
                for at, length, sequence, offset in cut(starts[i], ns[i], below[i], own[i], windows):
                    raw = ids[at:at + length].tobytes()
                    rows.append(i)
                    for c, v in zip(columns, (at, length, zlib.crc32(raw), ns[i], sequence, offset, raw), strict=False):
                        c.append(v)
                if len(rows) > 20_000:
                    yield flush()
            if rows:
                yield flush()

    return placed.mapInArrow(run, f"`{id_col}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                                  "sequence_id bigint, offset bigint" + ", ids binary" * with_ids)


def op4_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
