"""SimHash near-duplicates found by deletion-variant signatures.

A fingerprint has 64 bits; two link when they differ in at most two.  Cut
into two segments of 32 bits, at least one segment of a linked pair differs by
at most one bit.  So each fingerprint is indexed under 64 variants, each with
one bit of one segment masked (a wildcard): a linked pair is equal in at least
one variant.  Rows are brought together by an equality shuffle on the variant,
and pairs are verified on all 64 bits.

Only distinct fingerprints are indexed, so exact copies cost nothing.  In a
variant's group pairs are never emitted all against all: a task turns the
group's links into a spanning forest (one row per fingerprint at most).  Small
groups are compared directly, large ones by sorting the other segment under
every mask of one or two bits, which is linear in the group and finds the same
components.  A group's rows are what remains after exact copies are merged
and 31 or more bits are fixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import checkpointed
from quire.llm.components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
SEGMENT = 32
CHUNK = 1 << 16      # shingles whose bits are summed at once
DIRECT = 48          # groups up to this size are compared pair by pair


# -- fingerprints ----------------------------------------------------------------

def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a UTF-8 text as an unsigned 64-bit integer; 0 when it has no word."""
    import xxhash

    words = text.lower().split()  # bytes: A-Z only, and space and 9 to 13 only
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
        return hashes[0]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    ends = (ends[shingle - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        h = np.array([digest(joined[s:e], seed) for s, e in zip(starts[at:at + CHUNK], ends[at:at + CHUNK], strict=True)], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 seed: int = SEED) -> DataFrame:
    """``(id_col, fp)`` with ``fp`` the fingerprint's bits as a signed long; a null text is empty."""
    ids = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], [id_col, "fp"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return ids.mapInArrow(run, f"`{id_col}` {kind}, fp bigint")


# -- links -------------------------------------------------------------------------

def variants(distinct: DataFrame) -> DataFrame:
    """``(key, fp)``: each fingerprint under its one-wildcard variants.  ``key`` = segment, masked bit, masked segment."""
    rows = distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit"))
    segment = F.when(F.col("bit") < SEGMENT, F.col("fp").bitwiseAND(F.lit((1 << SEGMENT) - 1))).otherwise(
        F.shiftrightunsigned("fp", SEGMENT))
    mask = F.expr(f"~shiftleft(1L, bit % {SEGMENT})")
    return rows.select((F.shiftleft(F.col("bit").cast("long"), SEGMENT)).bitwiseOR(segment.bitwiseAND(mask)).alias("key"), "fp")


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _forest(links: np.ndarray) -> np.ndarray:
    """A spanning forest of the links: (member, smallest member) of each component; int64 columns."""
    nodes, at = np.unique(links, return_inverse=True)
    at = at.reshape(links.shape)
    root = np.arange(len(nodes))
    while True:
        a, b = root[at[:, 0]], root[at[:, 1]]
        if (a == b).all():
            break
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
    out = np.stack([nodes, nodes[root]], axis=1)
    return out[out[:, 0] != out[:, 1]]


def _small_groups(key: np.ndarray, fp: np.ndarray) -> list[np.ndarray]:
    """Verified links between neighbours at distance 1, 2, ... in key order: all pairs of groups of at most DIRECT rows."""
    found, left = [], np.arange(len(key))
    for step in range(1, DIRECT):
        left = left[left + step < len(key)]
        left = left[key[left] == key[left + step]]
        if not len(left):
            break
        far = _popcount((fp[left] ^ fp[left + step]).view(np.uint64)) <= MAX_BITS
        near = left[far]
        if len(near):
            found.append(np.stack([fp[near], fp[near + step]], axis=1))
    return found


def _large_group(key: int, fp: np.ndarray) -> np.ndarray:
    """Links that join the same fingerprints as all verified pairs of one variant's group do; linear in the group.

    Equal in the group's segment: linked within two bits of the other
    segment.  Differing in the masked bit: linked within one bit of it.
    """
    bit = key >> SEGMENT
    bits = fp.view(np.uint64)
    low, high = bits & np.uint64((1 << SEGMENT) - 1), bits >> np.uint64(SEGMENT)
    own, other = (low, high) if bit < SEGMENT else (high, low)
    side = (own >> np.uint64(bit % SEGMENT)) & np.uint64(1)
    found = []

    def chain(values: np.ndarray, members: np.ndarray) -> None:
        order = np.argsort(values, kind="stable")
        same = np.flatnonzero(values[order][1:] == values[order][:-1])
        if len(same):
            found.append(np.stack([members[order[same]], members[order[same + 1]]], axis=1))
        if len(found) > 64:
            found[:] = [_forest(np.concatenate(found))]

    one = [np.uint64(((1 << 32) - 1) & ~(1 << i)) for i in range(SEGMENT)]
    if len(np.unique(side)) == 2:
        for m in one:
            chain(other & m, fp)
    if bit % SEGMENT == 0:  # pairs with an equal segment are in the groups of all its bits: once is enough
        for s in (0, 1):
            part = side == s
            if part.sum() > 1:
                for i in range(SEGMENT):
                    for j in range(i + 1, SEGMENT):
                        chain(other[part] & one[i] & one[j], fp[part])
    return _forest(np.concatenate(found)) if found else np.empty((0, 2), np.int64)


def links(distinct: DataFrame) -> DataFrame:
    """``(a, b)``: verified links whose components are those of all pairs within MAX_BITS bits.  ``distinct``: column ``fp``."""
    grouped = variants(distinct).repartition("key").sortWithinPartitions("key", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.concatenate([key, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy()])
            cut = int(np.searchsorted(key, key[-1]))  # the last group may go on in the next batch
            if cut:
                yield from out(key[:cut], fp[:cut])
                key, fp = key[cut:], fp[cut:]
        if len(key):
            yield from out(key, fp)

    def out(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes = np.diff(np.append(starts, len(key)))
        large = sizes > DIRECT
        small = np.repeat(~large & (sizes > 1), sizes)
        found = _small_groups(key[small], fp[small])
        found += [_large_group(int(key[s]), fp[s:s + n]) for s, n in zip(starts[large], sizes[large], strict=True)]
        if found:
            pairs = _forest(np.concatenate(found))
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return grouped.mapInArrow(run, "a bigint, b bigint")


# -- operator ----------------------------------------------------------------------

def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   seed: int = SEED) -> DataFrame:
    """``(id_col, fingerprint, component_id)`` per row of ``docs``.

    ``component_id`` is the smallest id that is reachable over links.  Null
    and empty texts have fingerprint zero and link like any other.  A row
    with a null id is in its group too, but never names it; a group of null
    ids only has a null component.  Repeated rows give repeated rows.  An
    empty table gives an empty result.  Other columns are not read.
    """
    fps = checkpointed(fingerprints(docs.select(F.col(id_col), F.col(text_col)), id_col, text_col, shingle, seed))
    distinct = fps.groupBy("fp").agg(F.min(id_col).alias("_least"))
    found = components(links(distinct.select("fp")))
    member = checkpointed(distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "_least", F.coalesce("component", "fp").alias("component")))
    named = member.join(member.groupBy("component").agg(F.min("_least").alias("component_id")), "component").select(
        "fp", "component_id")
    return fps.join(named, "fp").select(
        F.col(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document left of each group: the one of the smallest id.

    Repeated rows of that id count as copies: the row with the smallest hash
    over all its columns stays.  Rows of groups without any id stay, one per text.
    """
    from pyspark.sql import Window

    groups = simhash_groups(docs, id_col, text_col)
    keep = groups.where(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("_keep")).distinct()
    hashed = docs.withColumn("_hash", F.xxhash64(*[F.col(c) for c in docs.columns]))
    kept = hashed.join(keep, F.col(id_col).eqNullSafe(F.col("_keep")), "left_semi")
    copy = Window.partitionBy(id_col, F.when(F.col(id_col).isNull(), F.xxhash64(text_col))).orderBy("_hash")
    return kept.withColumn("_n", F.row_number().over(copy)).where("_n = 1").select(*docs.columns)


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    return simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
