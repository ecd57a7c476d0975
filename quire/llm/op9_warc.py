"""WARC archives: a writer with deduplicated payloads and a salvaging reader.

Writer: a record per row, each in a gzip member of its own.  Of records with
equal payloads the one with the smallest id is a ``response``, the others are
``revisit`` records without a payload that name it (profile
identical-payload-digest of the WARC 1.1 standard).

Reader: files are read by Spark as whole byte strings and parsed member by
member.  It takes any valid WARC 1.0 or 1.1 archive: all record types, any
record ids, compressed by record, as a whole or not, with or without digests,
with fields it does not know (kept in ``fields``).  A record is accepted after
its checks: the gzip checksum, the WARC version line, the four fields that each
record must have, the content length, and its block digest if it has one of a
known kind.  After a failed check the reader goes on one byte later and searches for the
next place that may start a record: a gzip member or, in files or stretches
that are not compressed, a version line.  Bytes passed over are logged as a
gap: (file, offset, length, reason).  So one damaged record costs that record;
in a member of several records, those before it are kept and the rest of the member is the gap.

A file's size is bounded by the writer (``FILE_BYTES`` of payload), so a file
fits into a task; what a member unpacks to is bounded by ``MEMBER_BYTES``, and a larger one is a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.bytefiles import read_files, write_records
from quire.llm.common import checkpointed, remove
from quire.session import scratch_path

VERSION = b"WARC/1.1"
MIN_PAYLOAD = 0           # smaller payloads are not deduplicated
FILE_BYTES = 8 << 20      # payload bytes a file holds, about
SALTS = 16                # parts into which the rows of one payload are dealt
GZIP = b"\x1f\x8b\x08"
EMPTY_MEMBER = zlib.compress(b"", wbits=31)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MEMBER_BYTES = 1 << 30
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
HASHES = {"sha1": hashlib.sha1, "md5": hashlib.md5, "sha256": hashlib.sha256}
START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
# Every record is dated alike, so that a rerun writes the same bytes.
DATE = "2000-01-01T00:00:00Z"

COLUMNS = {"file": "string", "offset": "bigint", "record_type": "string", "record_id": "string", "date": "string", "page_id": "bigint", "url": "string",
           "payload_bytes": "bigint", "payload_digest": "string", "refers_to": "bigint", "refers_to_id": "string", "payload": "binary",
           "fields": "map<string,string>", "gap_bytes": "bigint", "reason": "string"}


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _header_text(value: str) -> str:
    """A header value in one line: line ends and percent signs are percent-encoded."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _plain(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def encode_record(page_id: int | None, url: str | None, payload: bytes, length: int, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member: a response, or with ``refers_to`` a revisit, which keeps its payload's length and digest only."""
    block = payload if refers_to is None else b""
    head = [VERSION.decode(), f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_uri(page_id)}",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {length}",
            f"WARC-Block-Digest: sha1:{digest if refers_to is None else sha1_base32(block)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_text(url)}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_uri(refers_to)}"]
    head += ["Content-Type: text/html", f"Content-Length: {len(block)}"]
    return member("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def member(data: bytes) -> bytes:
    """A gzip member without a time stamp.  It ends with a zero byte, the highest of the length field; larger data get an empty member behind."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = packer.compress(data) + packer.flush()
    return out if out.endswith(b"\0") else out + EMPTY_MEMBER


# -- writer ------------------------------------------------------------------------

def digests(pages: DataFrame, id_col: str, payload_col: str) -> DataFrame:
    """``pages`` plus ``_payload`` (UTF-8; null: empty) and ``_sha1`` (hex)."""
    return pages.withColumn("_payload", F.coalesce(F.col(payload_col), F.lit("")).cast("binary")).withColumn(
        "_sha1", F.sha1("_payload"))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_payload: int = MIN_PAYLOAD, file_bytes: int = FILE_BYTES) -> None:
    """Writes a record per row into WARC files under ``path``.

    Which payloads repeat is found from narrow rows (digest, id), aggregated
    before the shuffle; whole rows are joined to the repeated digests by
    (digest, salt), so copies of one payload are dealt to many tasks.  Rows
    that tie for the smallest id are all responses; a null id is larger than
    any other.
    """
    hashed = digests(pages.select(F.col(id_col).cast("bigint").alias("_id"), F.col(url_col).cast("string").alias("_url"),
                                  F.col(payload_col)), "_id", payload_col).drop(payload_col)
    firsts = hashed.where(F.length("_payload") >= min_payload).groupBy("_sha1").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    firsts = checkpointed(firsts.select(F.col("_sha1").alias("_key"), "_first"))
    size = hashed.agg(F.coalesce(F.sum(F.length("_payload") + 500), F.lit(0))).first()[0]
    salted = firsts.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    files = max(1, -(-size // file_bytes))
    joined = hashed.withColumn("_salt", F.pmod(F.xxhash64("_id", "_url"), F.lit(SALTS)).cast("int")).join(
        salted, (F.col("_sha1") == F.col("_key")) & (F.col("_salt") == F.col("_part")) & (F.length("_payload") >= min_payload), "left")
    revisit = F.col("_first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first"))
    rows = joined.select("_id", "_url", F.when(revisit, F.lit(b"")).otherwise(F.col("_payload")).alias("_block"),
                         F.length("_payload").alias("_length"), "_sha1", F.when(revisit, F.col("_first")).alias("_first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, url, block, length, sha1, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out.append(encode_record(page_id, url, block, length, base64.b32encode(bytes.fromhex(sha1)).decode(), first))
            yield pa.RecordBatch.from_arrays([pa.array([x[:-1] for x in out], pa.binary())], ["record"])

    # The separator is the zero byte that ends each member.
    write_records(rows.mapInArrow(run, "record binary").repartition(files), path, "record", "\0")


# -- reader ------------------------------------------------------------------------

class Damaged(Exception):
    """A check failed; the message names it."""


def _unpack(content: bytes, at: int, limit: int) -> tuple[bytes, int]:
    """The data of the gzip member at ``at`` and the offset behind it."""
    d, view, fed, size = zlib.decompressobj(31), memoryview(content), at, 0
    parts = []
    try:
        while not d.eof:
            if fed >= len(content):
                raise Damaged("truncated member")
            chunk = view[fed:fed + 65536]
            parts.append(d.decompress(chunk, limit + 1 - size))
            size += len(parts[-1])
            if size > limit:
                raise Damaged("member too large")
            fed += len(chunk)
    except zlib.error as e:
        raise Damaged("gzip check") from e
    return b"".join(parts), fed - len(d.unused_data)


def _digest_fits(stated: str, block: bytes) -> bool:
    """False if a digest of a known kind, in base 32 or hex, is not the block's."""
    kind, _, value = stated.partition(":")
    if kind.lower() not in HASHES:
        return True
    digest = HASHES[kind.lower()](block)
    if len(value) == 2 * digest.digest_size:
        return value.lower() == digest.hexdigest()
    return value.upper().rstrip("=") == base64.b32encode(digest.digest()).decode().rstrip("=")


def _page(record_id: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", record_id or "")
    return int(found[1]) if found else None


def _payload(kind: str, head: dict[str, str], block: bytes) -> bytes | None:
    """What a record carries: of an HTTP response what follows its header, else the block; nothing for a revisit."""
    if kind == "revisit":
        return None
    if kind == "response" and head.get("content-type", "").lower().replace(" ", "").startswith("application/http"):
        return block[block.find(b"\r\n\r\n") + 4:] if b"\r\n\r\n" in block else b""
    return block


def _record(data: bytes, at: int) -> tuple[dict, int]:
    """The record at ``at`` as a row, and the offset behind it."""
    end = data.find(b"\r\n\r\n", at)
    if not START.match(data, at) or data.startswith(GZIP, at) or end < 0 or START.search(data, at + 1, end):
        raise Damaged("version line or header")
    # A line that begins with white space goes on with the field before it.
    lines = re.sub(r"\r\n[ \t]+", " ", data[at:end].decode("utf-8", "replace")).split("\r\n")[1:]
    head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    if any(not head.get(k) for k in REQUIRED) or not head["content-length"].isdecimal():
        raise Damaged("header fields")
    length = int(head["content-length"])
    block, stop = data[end + 4:end + 4 + length], end + 8 + length
    if data[stop - 4:stop] != b"\r\n\r\n" or len(block) != length:
        raise Damaged("content length")
    if not _digest_fits(head.get("warc-block-digest", ""), block):
        raise Damaged("block digest")
    kind, ours = head["warc-type"].lower(), head.get("x-payload-length", "").isdecimal()
    payload, url, digest = _payload(kind, head, block), head.get("warc-target-uri"), head.get("warc-payload-digest")
    size = int(head["x-payload-length"]) if ours else None if payload is None else len(payload)
    if digest is None and payload is not None:
        digest = sha1_base32(payload)
    return {"record_type": kind, "record_id": head["warc-record-id"], "date": head["warc-date"], "page_id": _page(head["warc-record-id"]),
            "url": _plain(url) if ours and url is not None else url.strip("<>") if url is not None else None, "payload_bytes": size,
            "payload_digest": digest.removeprefix("sha1:") if digest is not None else None, "refers_to": _page(head.get("warc-refers-to")),
            "refers_to_id": head.get("warc-refers-to"), "payload": payload, "fields": list(head.items())}, stop


def _records(data: bytes) -> Iterator[dict]:
    """The records of a member's data, which must fill it."""
    at = 0
    while at < len(data):
        row, at = _record(data, at)
        yield row


def salvage(content: bytes, member_bytes: int = MEMBER_BYTES) -> Iterator[dict]:
    """The valid records of a file and its gaps, by offset.  Every byte is in a record, an empty member or a gap."""
    at, bad, reason = 0, None, None
    while at < len(content):
        rows, failed, stop = [], None, None
        try:
            if content.startswith(GZIP, at):
                data, stop = _unpack(content, at, member_bytes)
                for row in _records(data):
                    rows.append(row)
            elif START.match(content, at):
                row, stop = _record(content, at)
                rows.append(row)
            else:
                raise Damaged("no record starts here")
        except Damaged as e:
            failed = str(e)
        if rows or failed is None:
            if bad is not None:
                yield {"offset": bad, "gap_bytes": at - bad, "reason": reason}
                bad = None
            yield from (row | {"offset": at} for row in rows)
            if failed is not None:   # the member's records before the damage are kept, its rest cannot be told apart in the file
                yield {"offset": at, "gap_bytes": stop - at, "reason": f"{failed} after {len(rows)} records"}
            at = stop
            continue
        if bad is None:
            bad, reason = at, failed
        found = START.search(content, at + 1)
        at = found.start() if found else len(content)
    if bad is not None:
        yield {"offset": bad, "gap_bytes": len(content) - bad, "reason": reason}


def read_warc(spark: SparkSession, path: str, payloads: bool = True, batch_bytes: int = 16 << 20, names: str = "part-*") -> DataFrame:
    """One row per record and one per gap (``record_type`` null) of the files ``names`` under ``path``; see COLUMNS.

    ``page_id`` and ``refers_to`` are numbers in ids that this module writes, else null; ``fields`` has all header
    fields, names in lower case.  A record without a payload digest gets its payload's SHA-1.
    """
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "map<string,string>": pa.map_(pa.string(), pa.string())}
    fields = pa.schema([(n, kinds[kind]) for n, kind in COLUMNS.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file, rows, held = batch.column(0)[i].as_py(), [], 0
                for row in salvage(batch.column(1)[i].as_py()):
                    held += len(row.get("payload") or b"")
                    rows.append(row | {"file": file} | ({} if payloads else {"payload": None}))
                    if len(rows) >= 5000 or held > batch_bytes:
                        yield pa.RecordBatch.from_pylist(rows, fields)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, fields)

    return read_files(spark, path, names).mapInArrow(run, ", ".join(f"{n} {kind}" for n, kind in COLUMNS.items()))


def op9_warc(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    rows = checkpointed(read_warc(spark, path, payloads=False).where("record_type IS NOT NULL").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    remove(spark, path)
    return rows


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS f FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(x, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM f THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM f THEN NULL ELSE f END AS refers_to
FROM d
"""
