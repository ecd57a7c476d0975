"""Exact top-k inner products by no-random-access aggregation (NRA).

Candidates come in blocks.  In a block each dimension is a list of its values
in order, sorted once for all queries; a query reads list d from the end where q_d * x_d is largest.  At a
depth the last value read of a list is its frontier: whatever was not read
there contributes at most the frontier and at least the list's last value.
So a candidate has

    upper = sum over lists of (its contribution if read, else the frontier)
    lower = sum over lists of (its contribution if read, else the least one)

All lists are read on together, depth by depth.  A candidate goes when its
upper bound is below the k-th largest lower bound, or below the k-th score that
the query already has.  Reading stops when no more
than k candidates are left or the lists end; then the scores of those
left are resolved.  Candidates that tie with the k-th stay, so ties are exact.
A contribution is in the read part of its list exactly when it is not below
the frontier, so a depth costs one vectorised pass over the candidates left.

Candidates stay where they are read.  Queries come to them by broadcast, in
rounds of at most ``ROUND_BYTES``.  Each round meets the candidates in three
steps of growing shares (``STEPS``, by a hash of the id), and the k-th score of
a query after one step is its bound in the next: a task hands on the
candidates that reach it, about as many in all tasks together as the shares'
ratio times k.  So what is shuffled grows with the queries, not with queries times tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import checkpointed

SCALE = 256
QUERY_MOD = 50
K = 5
BLOCK_ROWS = 8192
DEPTHS = (0.5, 0.7, 0.85, 1.0)   # shares of the lists read before bounds are compared
ROUND_BYTES = 32 << 20           # of query vectors that are broadcast at once
PARTS, STEPS = 64, (1, 8, 64)    # candidates are cut into 64 parts; the steps end at these


def integer_vectors(table: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """``(id, v)`` with ``v = floor(scale * x)`` as longs; rows without an id or with a null or non-finite component go."""
    finite = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return table.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(F.col(vec_col), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("v"))


def _exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products as longs; by Python's integers where 64 bits may not hold a term."""
    most = (int(np.abs(x).max(initial=0)) * int(np.abs(q).max(initial=0))) * max(1, len(q))
    if most < 1 << 62:
        return x @ q
    return np.array([sum(int(a) * int(b) for a, b in zip(r, q, strict=True)) for r in x], dtype=object)


def _merge(old: tuple[np.ndarray, np.ndarray], scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    scores, ids = np.concatenate([old[0], scores]), np.concatenate([old[1], ids])
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


class Lists:
    """A block's candidates and the sorted list of each dimension."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.floats = x.astype(np.float64 if np.abs(x).max(initial=0) >= 1 << 20 else np.float32)
        self.sorted = np.sort(x, axis=0).astype(np.float64)

    def frontier(self, q: np.ndarray, share: float) -> np.ndarray:
        """The contribution of the last entry read of each list at a depth."""
        last = min(len(self.ids) - 1, max(0, math.ceil(share * len(self.ids)) - 1))
        return np.where(q >= 0, self.sorted[len(self.ids) - 1 - last], self.sorted[last]) * q

    def top(self, q: np.ndarray, own: int, k: int, so_far: tuple[np.ndarray, np.ndarray], reach: float = -math.inf) -> tuple[np.ndarray, np.ndarray]:
        """The k best of ``so_far`` (scores, ids) and this block for one query, of those that score ``reach`` or more."""
        qf = q.astype(self.floats.dtype)
        at, parts = None, self.floats * qf
        least = self.frontier(q, 1.0)
        # Sums of floats differ from the integers by far less than this part of the largest possible sum.
        slack = 1e-4 * float(np.abs(self.sorted[[0, -1]] * q).max(axis=0, initial=0).sum()) if self.floats.dtype == np.float32 else 1e-9 * float(
            np.abs(self.sorted[[0, -1]] * q).max(axis=0, initial=0).sum())
        floor = max(reach, float(so_far[0][-1]) if len(so_far[0]) == k else -math.inf)
        for share in DEPTHS[:-1]:
            front = self.frontier(q, share).astype(qf.dtype)
            upper = np.maximum(parts, front).sum(axis=1)
            alive = np.flatnonzero(upper >= floor - slack)
            if len(alive) < len(upper):
                at = alive if at is None else at[alive]
                parts, upper = parts[alive], upper[alive]
            if len(parts) > k:
                lower = np.where(parts >= front, parts, least.astype(qf.dtype)).sum(axis=1)
                if at is None:
                    lower[self.ids == own] = -math.inf
                else:
                    lower[self.ids[at] == own] = -math.inf
                bound = float(np.partition(lower, len(lower) - k)[len(lower) - k])
                if bound > floor:
                    floor = bound
                    alive = np.flatnonzero(upper >= floor - slack)
                    at = alive if at is None else at[alive]
                    parts = parts[alive]
            if len(parts) <= k:
                break
        at = np.arange(len(self.ids)) if at is None else at
        at = at[self.ids[at] != own]
        scores = _exact(self.x[at], q)
        high = scores >= reach
        return _merge(so_far, scores[high], self.ids[at][high], k)


def _met(sent, k: int):
    """Of a task's candidates (id, v), the best of each query that was sent: (query id, vector, bound) by length of the vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}   # (dim, row of the query) -> scores, ids
        held: dict[int, list] = {}

        def meet(dim: int) -> None:
            ids, x = (np.concatenate(part) for part in zip(*held.pop(dim), strict=True))
            if dim not in sent.value:
                return
            query_ids, vectors, bounds = sent.value[dim]
            lists, none = Lists(ids, x), (np.empty(0, np.int64), np.empty(0, np.int64))
            for r, own in enumerate(query_ids.tolist()):
                found = lists.top(vectors[r], own, k, best.get((dim, r), none), float(bounds[r]))
                if len(found[0]):
                    best[dim, r] = found

        for batch in batches:
            ids, v = batch.column(0).to_numpy(), batch.column(1)
            flat, ends = v.flatten().to_numpy(), np.cumsum(np.asarray(v.value_lengths()))
            width = np.diff(ends, prepend=0)
            for dim in np.unique(width).tolist():
                rows = np.flatnonzero(width == dim)
                for i in range(0, len(rows), BLOCK_ROWS):
                    part = rows[i:i + BLOCK_ROWS]
                    held.setdefault(dim, []).append((ids[part], flat[(ends[part] - dim)[:, None] + np.arange(dim)[None, :]] if dim
                                                     else np.empty((len(part), 0), np.int64)))
                    if sum(len(h[0]) for h in held[dim]) >= BLOCK_ROWS:
                        meet(dim)
        for dim in list(held):
            meet(dim)
        if best:
            yield pa.RecordBatch.from_arrays([
                pa.array([int(sent.value[dim][0][r]) for (dim, r), (s, _) in best.items() for _ in range(len(s))], pa.int64()),
                pa.array([int(x) for _, i in best.values() for x in i], pa.int64()),
                pa.array([int(x) for s, _ in best.values() for x in s], pa.int64())], ["query_id", "vec_id", "score"])

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    # Queries of one id with unlike vectors are ranked together: an id is one query.
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", query: Column | None = None, k: int = K,
          scale: int = SCALE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query row the k rows of the highest integer inner product.

    ``query`` says which rows are queries (default: ids divisible by 50);
    every row with another id is a candidate.  Ties go to the smaller id.  Rows without
    an id, with a null vector, or with null or non-finite components take no
    part.  Vectors of unlike lengths are not compared.  Query rows repeated
    exactly count once; repeated candidates are candidates each.  Fewer than k
    candidates: all of them.  An empty table gives an empty result.
    """
    spark = table.sparkSession
    query = F.col("id") % QUERY_MOD == 0 if query is None else query
    vectors = integer_vectors(table, id_col, vec_col, scale)
    asked = vectors.where(query).distinct()
    n, width = asked.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    rounds = max(1, -(-n * (width + 2) * 8 // ROUND_BYTES))
    asked = checkpointed(asked.withColumn("round", F.pmod(F.xxhash64("id"), F.lit(rounds))))
    parted = vectors.withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(PARTS)))
    schema = "query_id bigint, vec_id bigint, score bigint"
    results = None
    for number in range(rounds):
        by_dim: dict[int, list] = {}
        for r in asked.where(F.col("round") == number).collect():
            by_dim.setdefault(len(r.v), []).append((r.id, r.v))
        best, bounds, begin = None, {}, 0
        for end in STEPS:
            sent = spark.sparkContext.broadcast({dim: (np.array([i for i, _ in of], np.int64), np.array([v for _, v in of], np.int64).reshape(len(of), dim),
                                                       np.array([bounds.get(i, -math.inf) for i, _ in of])) for dim, of in by_dim.items()})
            found = parted.where((F.col("part") >= begin) & (F.col("part") < end)).select("id", "v").mapInArrow(_met(sent, k), schema)
            best = checkpointed(_ranked(found if best is None else best.select("query_id", "vec_id", "score").unionByName(found), k))
            sent.destroy()                 # the step is written, so no lost executor needs it again
            if end != STEPS[-1]:
                bounds = {r.query_id: r.score for r in best.where(F.col("rank") == k).collect()}   # a number for each query of the round
            begin = end
        results = best if results is None else results.unionByName(best)
    return results.select("query_id", "rank", "vec_id", "score")


def op8_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
