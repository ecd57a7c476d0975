"""Importance resampling towards a target distribution over hashed features.

Features are all runs of 1 to ``n`` consecutive words; a feature's bucket is
its CRC-32 modulo ``buckets``.  A bucket's gain compares its share of the
target's features with its share of the documents'; a document's weight is the
mean gain of its features, and the documents with the highest weight plus
Gumbel noise (a hash of their id) are drawn.

Head and tail vocabulary: the words of a corpus are few in the head, so the
CRC state of each frequent word is broadcast, and the bucket of each frequent
pair.  A word in the table costs one look-up, and a longer run goes on from its
words' state; a word or pair that is not in the table takes the CRC of its own
bytes.  Both give the same number, so bucket totals are exact whatever the
table holds.  It is found by counting in every task with a summary of bounded
size over all texts (what falls out of a full summary is rare), and merging
the summaries' heads; entries over ``HEAD_BYTES`` stay in the tail, so the
broadcast is under 4 MB.

Texts are read twice: once for the table, once for the features.  A document's
features are kept as (bucket, count) in a checkpoint, which gives the bucket
totals (one row a bucket after partial aggregation) and then the weights.
Ranks come from the histogram of scores, which has a bounded number of
distinct values, and a window inside each score; only documents that can be
drawn are shuffled.

A null text has no words, and a document without features has weight 0.  A null
id is hashed as an empty text and is the smallest.  Rows that repeat, and rows
that share an id, are documents of their own, ties going to fewer features,
then to the lower weight.  No documents give no rows; with no target all gains
follow from zero counts.  Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from quire.llm.common import checkpointed, counted_broadcast
from quire.sources.tables import table

# On UTF-8 bytes after A-Z are lowered: digits, small letters and every byte of a character beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

N = 1
BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
# The head: entries that are broadcast, their longest size, entries a task's summary holds at most and hands on.
HEAD = 20_000
HEAD_BYTES = 64
SUMMARY = 100_000
HANDED_ON = 4_096
# Distinct scores: weights and noise are logarithms of ratios of 64-bit counts, times 1,000, so under 90,000 and 26,000 apart.
MAX_SCORES = 200_000


class _States(dict):
    """CRC states of the head's words; any other word takes its own CRC, which is not kept."""

    def __missing__(self, word: bytes) -> int:
        return zlib.crc32(word)


class Features:
    """Bucket numbers of a text's features by the head's tables and, for the tail, by direct CRC."""

    def __init__(self, n: int, buckets: int, words: list[bytes], pairs: list[bytes]):
        self.n, self.buckets = n, buckets
        self.states = _States({w: zlib.crc32(w) for w in words})
        self.pairs = {tuple(p.split(b" ")): zlib.crc32(p) % buckets for p in pairs}

    def __call__(self, text: str | None) -> tuple[int, np.ndarray]:
        """Number of words, and the bucket of every feature."""
        words = words_of(text)
        states = np.fromiter(map(self.states.__getitem__, words), np.int64, len(words))
        found = [states % self.buckets]
        if self.n > 1:
            known = self.pairs.get
            found.append(np.array([b if (b := known(p)) is not None else zlib.crc32(b" " + p[1], s) % self.buckets
                                   for p, s in zip(zip(words, words[1:]), states.tolist())], np.int64))
        if self.n > 2:
            spaced, run = [b" " + w for w in words], states.tolist()
            for k in range(1, self.n):
                run = [zlib.crc32(w, s) for w, s in zip(spaced[k:], run)]
                if k > 1:
                    found.append(np.array(run, np.int64) % self.buckets)
        return len(words), np.concatenate(found)


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


class _Summary(Counter):
    """Counts of frequent entries in bounded memory: when full, the count of the entry in the middle is taken from all."""

    def add(self, entries) -> None:
        self.update(entries)
        if len(self) > 2 * SUMMARY:
            kept = heapq.nlargest(SUMMARY, self.items(), key=lambda e: e[1])
            floor = kept[-1][1]
            self.clear()
            for entry, count in kept:
                if count > floor:
                    self[entry] = count - floor

    def head(self) -> list[tuple[bytes, int]]:
        return heapq.nlargest(HANDED_ON, self.items(), key=lambda e: (e[1], e[0]))


def head_table(docs: DataFrame, text_col: str = "text", n: int = N, size: int = HEAD) -> tuple[list[bytes], list[bytes]]:
    """The frequent words and (if ``n`` > 1) pairs of words, at most ``size`` of both together, of ``HEAD_BYTES`` at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = _Summary(), _Summary()
        for batch in batches:
            for text in batch.column(0):
                found = words_of(text.as_py())
                for at in range(0, len(found), SUMMARY):
                    words.add(w for w in found[at:at + SUMMARY] if len(w) <= HEAD_BYTES)
                    if n > 1:
                        pairs.add(p for a, b in zip(found[at:at + SUMMARY], found[at + 1:at + SUMMARY + 1]) if len(p := a + b" " + b) <= HEAD_BYTES)
        top = words.head() + pairs.head()
        yield pa.RecordBatch.from_arrays([pa.array([e for e, _ in top], pa.binary()), pa.array([c for _, c in top], pa.int64())], ["entry", "n"])

    counted = docs.select(text_col).mapInArrow(count, "entry binary, n long").groupBy("entry").agg(F.sum("n").alias("n"))
    top = [bytes(r.entry) for r in counted.orderBy(F.desc("n"), "entry").limit(size).collect()]
    return [e for e in top if b" " not in e], [e for e in top if b" " in e]


def features(docs: DataFrame, head: tuple[list[bytes], list[bytes]], text_col: str = "text", n: int = N, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` without its text, and ``n_words``, ``n_features``, ``features``: an array of ``count * buckets + bucket`` for each bucket met."""
    others = [c for c in docs.columns if c != text_col]
    sent = docs.sparkSession.sparkContext.broadcast(head)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Features(n, buckets, *sent.value)
        for batch in batches:
            n_words, n_features, rows = [], [], []
            for text in batch.column(len(others)):
                count, found = of(text.as_py())
                bucket, times = np.unique(found, return_counts=True)
                n_words.append(count)
                n_features.append(len(found))
                rows.append(times * buckets + bucket)
            ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
            flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            arrays = [*batch.columns[:len(others)], pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()),
                      pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, [*others, "n_words", "n_features", "features"])

    kept = docs.select(*others, text_col)
    schema = kept.select(*others).schema.add("n_words", LongType()).add("n_features", LongType()).add("features", ArrayType(LongType()))
    return kept.mapInArrow(measure, schema)


def bucket_totals(measured: DataFrame, buckets: int = BUCKETS) -> dict[int, int]:
    """Features by bucket over all rows; at most ``buckets`` rows reach the driver."""
    one = measured.select(F.explode("features").alias("f"))
    counted = one.groupBy((F.col("f") % buckets).alias("bucket")).agg(F.sum(F.expr(f"f div {buckets}")).alias("n"))
    return {r.bucket: r.n for r in counted.collect()}


def gains(documents: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """By bucket, 1,000 times the logarithm of its smoothed share of the target over that of the documents, rounded down."""
    s_all, t_all = sum(documents.values()), sum(target.values())
    return [math.floor(1000 * math.log((target.get(b, 0) + 1) * (s_all + buckets) / ((documents.get(b, 0) + 1) * (t_all + buckets))))
            for b in range(buckets)]


def _scored(measured: DataFrame, gain: list[int], buckets: int) -> DataFrame:
    """Replaces the features by ``weight`` and adds the noise to ``score``, from ``_h``."""
    names = [c for c in measured.columns if c not in ("features", "_h")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket = np.array(gain, np.int64)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("features"))
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            sums = np.concatenate([[0], np.cumsum(by_bucket[flat % buckets] * (flat // buckets))])
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            total = sums[ends[1:]] - sums[ends[:-1]]
            weight = total // np.maximum(batch.column(batch.schema.get_field_index("n_features")).to_numpy(), 1)
            noise = [math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))) for h in batch.column(batch.schema.get_field_index("_h")).to_pylist()]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(weight, pa.int64()), pa.array(weight + np.array(noise, np.int64), pa.int64())],
                                             [*names, "weight", "score"])

    return measured.mapInArrow(score, measured.select(*names).schema.add("weight", LongType()).add("score", LongType()))


def importance_resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", n: int = N,
                        buckets: int = BUCKETS, seed: int = SEED, min_words: int = MIN_WORDS, percent: int = PERCENT, head: int = HEAD) -> DataFrame:
    """``id_col, n_words, n_features, weight, score, rank`` of every document; ``rank`` (1, 2, ...) is null for those not drawn.

    Of the documents with at least ``min_words`` words, ``percent`` per cent (rounded down) are drawn.
    """
    tables = head_table(docs, text_col, n, head)
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    rows = docs.select(F.col(id_col).alias("_id"), noise.alias("_h"), F.col(text_col).alias("_text"))
    measured = checkpointed(features(rows, tables, "_text", n, buckets))
    goal = features(target.select(F.col(target_col).alias("_text")), tables, "_text", n, buckets)
    gain = gains(bucket_totals(measured, buckets), bucket_totals(goal, buckets), buckets)
    scored = checkpointed(_scored(measured, gain, buckets))
    return _ranked(scored, min_words, percent).withColumnRenamed("_id", id_col)


def _ranked(scored: DataFrame, min_words: int, percent: int) -> DataFrame:
    may = F.col("n_words") >= min_words
    by_score = checkpointed(scored.where(may).groupBy("score").agg(F.count(F.lit(1)).alias("_n")))
    draws = percent * (by_score.agg(F.sum("_n")).first()[0] or 0) // 100
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)  # one row a distinct score: see MAX_SCORES
    starts = checkpointed(by_score.select("score", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_start")).where(F.col("_start") < draws))
    placed = scored.where(may).join(counted_broadcast(starts, MAX_SCORES), "score")
    order = Window.partitionBy("score").orderBy(F.asc_nulls_first("_id"), "n_features", "weight", "n_words")
    rank = F.col("_start") + F.row_number().over(order)
    drawn = placed.withColumn("rank", F.when(rank <= draws, rank).cast("long")).drop("_start")
    lowest = starts.agg(F.min("score")).first()[0]
    rest = scored.where(~may | (F.lit(lowest).isNull() | (F.col("score") < F.coalesce(F.lit(lowest), F.lit(0))))).withColumn("rank", F.lit(None).cast("long"))
    names = ["_id", "n_words", "n_features", "weight", "score", "rank"]
    return drawn.select(*names).unionByName(rest.select(*names))


def drawn_documents(docs: DataFrame, ranked: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id was drawn, with all their columns; rows that share a drawn id all come."""
    ids = ranked.where(F.col("rank").isNotNull()).select(F.col(id_col).alias("_drawn_id")).distinct()
    return docs.join(ids, docs[id_col].eqNullSafe(ids["_drawn_id"]), "left_semi")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight, score and rank towards the texts of ``benchmark``."""
    docs, goal = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance_resample(docs, goal).select("doc_id", "n_features", "weight", "score", "rank")


# CRC-32 by its table of 256 entries, itself computed, over the bytes of each distinct word.
ORACLE = r"""
WITH crc_table AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([0, 1, 2, 3, 4, 5, 6, 7],
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, CAST(i AS BIGINT)) AS c FROM range(256) r(i))),
w AS MATERIALIZED (SELECT part, id, word, count(*) AS n FROM (SELECT 's' AS part, doc_id AS id,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
    FROM documents UNION ALL SELECT 't', 0,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))
    FROM benchmark) GROUP BY ALL),
bytes AS (SELECT word, hex(encode(word)) AS x FROM (SELECT DISTINCT word FROM w)),
crc AS MATERIALIZED (SELECT word, xor(list_reduce([CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT) FOR i IN range(length(x) // 2)],
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket FROM bytes, crc_table),
totals AS (SELECT bucket, sum(n) FILTER (part = 's') AS s, sum(n) FILTER (part = 't') AS t FROM w JOIN crc USING (word) GROUP BY bucket),
gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM totals) + 10000) AS DOUBLE)
    / CAST((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM totals) + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM totals),
weights AS (SELECT id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight
    FROM w JOIN crc USING (word) JOIN gain USING (bucket) WHERE part = 's' GROUP BY id),
scored AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
    FROM documents LEFT JOIN weights ON id = doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= 20 AND place <= 10 * (SELECT count(*) FROM scored WHERE n_features >= 20) // 100 THEN place END AS rank
FROM ranked
"""
