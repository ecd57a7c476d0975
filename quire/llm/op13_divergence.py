"""Divergence audit of sources: term shares of every (language, source) against the other sources and the whole language.

Minimal-perfect-hash recount in two passes over the texts:

1. Exact frequency filter: documents are counted by (language, term), in each
   task first, and terms in fewer than ``MIN_DOCS`` documents of their language go.
2. The kept terms are cut into shards of about ``SHARD_KEYS`` by a hash.  Each
   shard gets a minimal perfect hash (hash and displace: keys fall into small
   buckets, largest first, each with the first seed that sends its keys to free
   slots), which keeps its keys, as the hash of a term that is not kept also
   points somewhere: a look-up compares the stored key.  Shards are broadcast,
   at most ``ROUND_BYTES`` at once, and texts are read once for each such round.
   A task counts the terms it meets in a dense array of slots for every
   (language, source), and hands the arrays' non-zero slots on when they take
   ``SLOT_BYTES``, and at its end.

Sums by (language, source, slot) then meet in blocks of ``BLOCK`` slots of one
shard, as a matrix of all sources of the language, where zero counts have their
share too.  A block gives partial sums for pairs of sources and its own best
terms, so neither a language nor a source lies in one task.

All arithmetic is in integers (``_per_billion`` in two steps of long division,
exact while counts stay under 2.9e14).

A null text, language or source counts as empty.  A document is a row:
rows that repeat count each.  Ties go to the smaller item in UTF-8.  A
language without kept terms has pairs of value 0, a lone source has none.  No
documents give no rows.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import checkpointed, counted_broadcast
from quire.sources.tables import table

# On UTF-8 bytes after A-Z are lowered: small letters and every byte of a character beyond ASCII.
TERM = re.compile(rb"[a-z\x80-\xff]+")

MIN_DOCS = 10
TOP = 10
SHARD_KEYS = 16_384
BLOCK = 1_024
KEYS_A_BUCKET = 4
# Broadcast at once (keys and 16 bytes each); slots, counted terms and characters of text a task holds before it hands them on.
ROUND_BYTES = 64 << 20
SLOT_BYTES = 128 << 20
HELD_TERMS = 1_000_000
TEXT_CHARS = 8 << 20

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def terms_of(text: str | None) -> list[bytes]:
    return TERM.findall((text or "").encode("utf-8", "surrogatepass").lower())


def _texts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, str]]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


# -- first pass --------------------------------------------------------------

def kept_terms(texts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, term`` (binary) of the terms in at least ``min_docs`` rows of their language."""
    def rows(counts: dict[str, Counter]) -> pa.RecordBatch:
        langs = [lang for lang, c in counts.items() for _ in c]
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array([t for c in counts.values() for t in c], pa.binary()),
                                           pa.array([n for c in counts.values() for n in c.values()], pa.int64())], ["lang", "term", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held = defaultdict(Counter), 0
        for lang, _, text in _rows(batches):
            found = set(terms_of(text))
            held += len(found)
            counts[lang].update(found)
            if held > HELD_TERMS and (held := sum(map(len, counts.values()))) > HELD_TERMS // 2:
                yield rows(counts)
                counts, held = defaultdict(Counter), 0
        yield rows(counts)

    counted = texts.mapInArrow(count, "lang string, term binary, n long").groupBy("lang", "term").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_docs).select("lang", "term")


# -- minimal perfect hashes --------------------------------------------------

def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))


def _slots(hashes: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    x = (hashes ^ (seeds * _SPREAD)) * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(32)
    return ((x * np.uint64(0xC4CEB9FE1A85EC53)) >> np.uint64(33)) % np.uint64(n)


def build_hash(keys: list[bytes]) -> tuple[np.ndarray, list[bytes], int]:
    """Displacements of a minimal perfect hash of distinct keys, the keys by slot, and how many of them it places.

    A displacement >= 0 is the seed of its bucket; a negative one, -1 - slot, is the place of a bucket's only key.
    No seed parts keys with equal 64-bit hashes: all but one of them come behind the others, and are looked up by themselves.
    """
    hashes, first = np.unique(_hashes(keys), return_index=True)
    twins = [keys[i] for i in sorted(set(range(len(keys))) - set(first.tolist()))] if len(first) < len(keys) else []
    keys, n = [keys[i] for i in first.tolist()], len(first)
    bucket = (hashes % np.uint64(max(1, n // KEYS_A_BUCKET))).astype(np.int64)
    seeds, by_slot, free = np.zeros(max(1, n // KEYS_A_BUCKET), np.int64), [None] * n, np.ones(n, bool)
    order = np.argsort(bucket, kind="stable")
    groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if n else []
    rest = []
    for group in sorted(groups, key=len, reverse=True):
        if len(group) == 1:
            rest.append(group[0])
            continue
        at = 0
        while True:  # 64 seeds at once
            tried = np.arange(at, at + 64, dtype=np.uint64)
            to = _slots(hashes[group][None, :], tried[:, None], n).astype(np.int64)
            fits = free[to].all(1) & (np.diff(np.sort(to, 1), axis=1) > 0).all(1)
            if fits.any():
                break
            at += 64
        first = int(fits.argmax())
        seeds[bucket[group[0]]] = at + first
        free[to[first]] = False
        for k, slot in zip(group, to[first]):
            by_slot[slot] = keys[k]
    for k, slot in zip(rest, np.flatnonzero(free)):
        seeds[bucket[k]] = -1 - slot
        by_slot[slot] = keys[k]
    return seeds, by_slot + twins, n


class Shard:
    """A perfect hash with its keys; ``first`` is where its slots start among those of the round."""

    def __init__(self, seeds: bytes, keys: list[bytes], hashed: int, first: int):
        self.seeds, self.keys, self.hashed, self.first = np.frombuffer(seeds, np.int64), keys, hashed, first
        self.twins = {k: hashed + i for i, k in enumerate(keys[hashed:])}

    def find(self, terms: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """Slot of each term, or -1 where the stored key is another."""
        seed = self.seeds[(hashes % np.uint64(len(self.seeds))).astype(np.int64)]
        slot = np.where(seed < 0, -1 - seed, _slots(hashes, np.maximum(seed, 0).astype(np.uint64), self.hashed).astype(np.int64))
        keys, twin = self.keys, self.twins.get
        return np.fromiter((s if keys[s] == t else twin(t, -1) for t, s in zip(terms, slot.tolist())), np.int64, len(terms))


def shard_number(hashes: np.ndarray, shards: int | np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) % shards


def hash_shards(terms: DataFrame) -> DataFrame:
    """``lang, shards, shard, n, bytes, hashed, seeds, keys``: one row a shard, ``keys`` in slot order."""
    def build(key: tuple[pa.Scalar, ...], batch: pa.Table) -> pa.Table:
        seeds, by_slot, hashed = build_hash(batch.column("term").to_pylist())
        return pa.table({"lang": [key[0].as_py()], "shards": pa.array([batch.column("shards")[0].as_py()], pa.int64()), "shard": pa.array([key[1].as_py()], pa.int64()),
                         "n": pa.array([len(by_slot)], pa.int64()), "bytes": pa.array([sum(map(len, by_slot)) + 16 * len(by_slot)], pa.int64()),
                         "hashed": pa.array([hashed], pa.int64()), "seeds": pa.array([seeds.tobytes()], pa.binary()), "keys": pa.array([by_slot], pa.list_(pa.binary()))})

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = shard_number(_hashes(batch.column("term").to_pylist()), batch.column("shards").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number, pa.int64())], [*batch.schema.names, "shard"])

    counts = terms.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / F.lit(SHARD_KEYS)).cast("long").alias("shards"))
    cut = terms.join(counted_broadcast(checkpointed(counts)), "lang").select("lang", "term", "shards")
    return cut.mapInArrow(number, "lang string, term binary, shards long, shard long").groupBy("lang", "shard").applyInArrow(
        build, "lang string, shards long, shard long, n long, bytes long, hashed long, seeds binary, keys array<binary>")


def _rounds(shards: DataFrame, limit: int) -> Iterator[list[tuple]]:
    """The shards in rounds of at most ``limit`` bytes (or one shard)."""
    chosen, size = [], 0
    for r in shards.orderBy("lang", "shard").toLocalIterator():
        if chosen and size + r.bytes > limit:
            yield chosen
            chosen, size = [], 0
        chosen.append((r.lang, r.shards, r.shard, r.hashed, bytes(r.seeds), [bytes(k) for k in r["keys"]]))
        size += r.bytes
    if chosen:
        yield chosen


# -- second pass -------------------------------------------------------------

class Recount:
    """Dense counts of the round's slots by (language, source)."""

    def __init__(self, shards: list[tuple]):
        self.number, self.shards, self.size = {}, defaultdict(dict), defaultdict(int)
        for lang, total, shard, hashed, seeds, keys in shards:
            self.number[lang] = total
            self.shards[lang][shard] = Shard(seeds, keys, hashed, self.size[lang])
            self.size[lang] += len(keys)
        self.slots: dict[tuple[str, str], np.ndarray] = {}

    def add(self, lang: str, source: str, counts: Counter) -> None:
        if lang not in self.number:
            return
        terms = list(counts)
        hashes, times = _hashes(terms), np.fromiter(counts.values(), np.int64, len(terms))
        if (lang, source) not in self.slots:
            self.slots[lang, source] = np.zeros(self.size[lang], np.int64)
        dense, number = self.slots[lang, source], shard_number(hashes, self.number[lang])
        for shard in np.unique(number).tolist():
            if shard in self.shards[lang]:
                mine = np.flatnonzero(number == shard)
                slot = self.shards[lang][shard].find([terms[i] for i in mine.tolist()], hashes[mine])
                hit = slot >= 0
                dense[self.shards[lang][shard].first + slot[hit]] += times[mine[hit]]   # distinct terms: no slot twice

    def full(self) -> bool:
        return sum(8 * len(s) for s in self.slots.values()) > SLOT_BYTES

    def take(self) -> Iterator[pa.RecordBatch]:
        for (lang, source), dense in self.slots.items():
            for shard, of in self.shards[lang].items():
                part = dense[of.first:of.first + len(of.keys)]
                slot = np.flatnonzero(part)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slot), pa.string()), pa.array([source] * len(slot), pa.string()),
                                                  pa.array(np.full(len(slot), shard), pa.int64()), pa.array(slot, pa.int64()), pa.array(part[slot], pa.int64())],
                                                 ["lang", "source", "shard", "slot", "n"])
        self.slots = {}


def recount(texts: DataFrame, shards: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame | None:
    """``lang, source, shard, slot, n``: occurrences of the kept terms by source; None where no term is kept."""
    counted = None
    for chosen in _rounds(shards, round_bytes):
        sent = texts.sparkSession.sparkContext.broadcast(chosen)
        met = texts.mapInArrow(_counter(sent), "lang string, source string, shard long, slot long, n long")
        one = checkpointed(met.groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n")))
        sent.destroy()   # its counts are written, so no lost executor needs it again
        counted = one if counted is None else counted.unionByName(one)
    return counted


def _counter(sent):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held, size = Recount(sent.value), defaultdict(Counter), 0

        def meet() -> Iterator[pa.RecordBatch]:
            for group, counts in held.items():
                of.add(*group, counts)
                if of.full():
                    yield from of.take()

        for lang, source, text in _rows(batches):
            held[lang, source].update(terms_of(text))
            size += len(text)
            if size > TEXT_CHARS:
                yield from meet()
                held, size = defaultdict(Counter), 0
        yield from meet()
        yield from of.take()

    return count


# -- shares and divergences --------------------------------------------------

def _per_billion(count: np.ndarray, total: int) -> np.ndarray:
    """``1 + floor(10**9 * (count + 2) / total)`` in 64-bit integers."""
    first, rest = np.divmod((count + 2) * 31_250, total)
    return 1 + first * 32_000 + rest * 32_000 // total


def _block(top: int):
    """Of one block: sums of divergences by pair of sources, and the best terms of every source."""
    def one(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        lang = key[0].as_py()
        kept = rows.column("v")[0].as_py()
        group, term, count = (rows.filter(pc.equal(rows.column("kind"), k)).select(["name", "slot", "n"]).to_pydict() for k in ("group", "term", "count"))
        groups = {name.decode(): n for name, n in zip(group["name"], group["n"])}
        sources, names = sorted(groups), [name for _, name in sorted(zip(term["slot"], term["name"]))]
        place = {s.encode(): i for i, s in enumerate(sources)}
        counts = np.zeros((len(sources), len(names)), np.int64)
        if count["n"]:
            counts[[place[s] for s in count["name"]], np.array(count["slot"]) - min(term["slot"])] = count["n"]
        p = np.stack([_per_billion(row, groups[s] + 2 * kept) for s, row in zip(sources, counts)])
        q = _per_billion(counts.sum(0), sum(groups.values()) + 2 * kept)
        out = []
        for i, source in enumerate(sources):
            apart = p - p[i]
            sums = (apart * apart // (p + p[i])).sum(1)
            out += [(source, "pair", sources[j].encode(), int(sums[j])) for j in range(len(sources)) if j != i]
            value = (p[i] - q) * (p[i] - q) // (p[i] + q)
            hit = np.flatnonzero((counts[i] > 0) & (p[i] > q))
            best = sorted(hit.tolist(), key=lambda t: (-value[t], names[t]))[:top]
            out += [(source, "term", names[t], int(value[t])) for t in best]
        return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "source": pa.array([r[0] for r in out], pa.string()), "part": pa.array([r[1] for r in out], pa.string()),
                         "item": pa.array([r[2] for r in out], pa.binary()), "value": pa.array([r[3] for r in out], pa.int64())})

    return one


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, top: int = TOP,
               round_bytes: int = ROUND_BYTES) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    ``pair``: every other source of the language, with the divergence of the two sources' shares summed over all kept terms.
    ``term``: the ``top`` terms whose share lies furthest above the language's.  ``rank`` is by value, falling, then by item.
    """
    texts = _texts(docs, text_col, lang_col, source_col)
    groups = checkpointed(texts.select("lang", "source").distinct())
    other = groups.select("lang", F.col("source").alias("other"))
    pairs = groups.join(other, "lang").where(F.col("source") != F.col("other")).select(
        "lang", "source", F.lit("pair").alias("part"), F.encode("other", "UTF-8").alias("item"), F.lit(0).cast("long").alias("value"))
    shards = checkpointed(hash_shards(checkpointed(kept_terms(texts, min_docs))))
    counts = recount(texts, shards, round_bytes)
    if counts is None:
        return _ranked(pairs, top)
    kept = shards.groupBy("lang").agg(F.sum("n").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    sizes = groups.join(totals, ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    block = F.expr(f"slot div {BLOCK}")
    blocks = shards.select("lang", "shard", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {BLOCK}"))).alias("block"))
    keys = shards.select("lang", "shard", F.posexplode("keys").alias("slot", "name"))
    rows = [keys.select("lang", "shard", block.alias("block"), F.lit("term").alias("kind"), "name", F.col("slot").cast("long").alias("slot"), F.lit(0).cast("long").alias("n")),
            counts.select("lang", "shard", block.alias("block"), F.lit("count").alias("kind"), F.encode("source", "UTF-8").alias("name"), "slot", "n"),
            blocks.join(sizes, "lang").select("lang", "shard", "block", F.lit("group").alias("kind"), F.encode("source", "UTF-8").alias("name"), F.lit(0).cast("long").alias("slot"), "n")]
    met = rows[0].unionByName(rows[1]).unionByName(rows[2]).join(counted_broadcast(checkpointed(kept)), "lang")
    found = met.groupBy("lang", "shard", "block").applyInArrow(_block(top), "lang string, source string, part string, item binary, value long")
    return _ranked(found.unionByName(pairs), top)


def _ranked(found: DataFrame, top: int) -> DataFrame:
    summed = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = summed.withColumn("rank", F.row_number().over(order)).where((F.col("part") == "pair") | (F.col("rank") <= top))
    return ranked.select("lang", "source", "part", F.decode("item", "UTF-8").alias("item"), "value", "rank")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source of ``documents`` from the other sources of its language, and its most telling terms."""
    return divergence(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
w AS MATERIALIZED (SELECT doc, lang, source, term, count(*) AS n FROM (SELECT doc, lang, source, unnest(terms) AS term FROM d) GROUP BY ALL),
kept AS MATERIALIZED (SELECT lang, term FROM w GROUP BY lang, term HAVING count(*) >= 10),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT lang, source, term, sum(n) AS n FROM w GROUP BY ALL),
dense AS MATERIALIZED (SELECT g.lang, g.source, k.term, v, CAST(coalesce(n, 0) AS HUGEINT) AS n
    FROM groups g JOIN kept k USING (lang) JOIN size USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
langs AS (SELECT lang, term, v, sum(n) AS n FROM dense GROUP BY ALL),
p AS MATERIALIZED (SELECT lang, source, term, n, 1 + 1000000000 * (n + 2) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p FROM dense),
q AS (SELECT lang, term, 1 + 1000000000 * (n + 2) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q FROM langs),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
