import hashlib
import random
from base64 import b32encode

import pytest

from quire.llm import op9_warc as op

SCHEMA = "page_id bigint, url string, html string, record_type string"


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(4)
    rows = [(i, f"http://x/{i}\r\n%41", "".join(rng.choice("<p>aé\r\n\x00WARC/1.1\x1f\x8b") for _ in range(rng.randrange(400))), "extra") for i in range(60)]
    rows += [(100 + i, None, rows[3][2], None) for i in range(20)]
    rows += [(200, "u", None, "x"), (201, "u", "", "x"), (202, "big", "".join(rng.choice("abc") for _ in range(300_000)), "x")]
    rows += [(None, "null", rows[3][2], "x"), (None, "alone", "only here", "x"), (5, rows[5][1], rows[5][2], "x"), (203, "w", "WARC/1.1\r\nContent-Length: 0\r\n\r\n", "x")]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(4)


def brute(rows):
    first = {}
    for i, _, h, _ in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h, _ in rows:
        data, f = (h or "").encode(), first.get(h or "")
        revisit = f is not None and i != f
        out.append((i, len(data), b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


def fields(rows):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)


def test_round_trip(spark, pages, tmp_path):
    rows, df = pages
    path = str(tmp_path / "warc")
    op.write_warc(df, path, file_bytes=50_000)
    got = op.read_warc(spark, path).collect()
    assert all(r.record_type for r in got)
    assert fields(got) == brute(rows)
    by_id = {(i, u): (h or "").encode() for i, u, h, _ in rows}
    for r in got:
        assert (r.page_id, r.url) in by_id
        if r.record_type == "response":
            assert bytes(r.payload) == by_id[r.page_id, r.url]


def test_salvage_recovers_all_but_the_damaged(tmp_path):
    rng = random.Random(9)
    bodies = [bytes(rng.randrange(256) for _ in range(rng.randrange(20, 900))) for _ in range(40)]
    members = [op.encode_record(i, "u", b, len(b), op.sha1_base32(b), None) for i, b in enumerate(bodies)]
    whole = b"".join(members)
    starts = [len(b"".join(members[:i])) for i in range(41)]
    for trial in range(60):
        bad = bytearray(whole)
        hit = rng.randrange(40)
        kind = trial % 4
        if kind == 0:
            bad[rng.randrange(starts[hit], starts[hit + 1])] ^= 0xFF
        elif kind == 1:
            del bad[starts[hit] + 5:starts[hit + 1] - rng.randrange(0, 5)]
        elif kind == 2:
            bad[starts[hit]:starts[hit]] = b"junk\x1f\x8b\x08more"
        else:
            del bad[starts[hit] + 10:]
        rows = list(op.salvage(bytes(bad)))
        found = {r["page_id"]: r["payload"] for r in rows if "record_type" in r}
        assert all(bodies[i] == p for i, p in found.items())
        lost = set(range(40)) - set(found)
        assert lost <= (set(range(hit, 40)) if kind == 3 else {hit})
        # Records and gaps cover the file.
        gaps = [(r["offset"], r["gap_bytes"]) for r in rows if "gap_bytes" in r]
        assert (not lost and kind != 2) or gaps or (kind == 3 and bytes(bad) == whole[:len(bad)])
        assert all(n > 0 for _, n in gaps)


def test_salvage_of_records_without_compression():
    import zlib

    raw = [zlib.decompress(op.encode_record(i, None, b"payload %d" % i, 9, op.sha1_base32(b"payload %d" % i), None), 31) for i in range(5)]
    data = raw[0] + raw[1] + raw[2][:40] + raw[3] + b"\x00\x01" + op.member(raw[4]) + b"tail"
    rows = list(op.salvage(data))
    assert [r["page_id"] for r in rows if "record_type" in r] == [0, 1, 3, 4]
    assert [(r["offset"], r["gap_bytes"]) for r in rows if "gap_bytes" in r] == [
        (len(raw[0] + raw[1]), 40), (len(raw[0] + raw[1]) + 40 + len(raw[3]), 2), (len(data) - 4, 4)]


def test_gaps_are_rows(spark, pages, tmp_path):
    _, df = pages
    path = str(tmp_path / "warc")
    op.write_warc(df, path)
    (file,) = [p for p in (tmp_path / "warc").iterdir() if p.name.startswith("part-")]
    data = bytearray(file.read_bytes())
    data[len(data) // 2] ^= 0x55
    (tmp_path / "warc" / f".{file.name}.crc").unlink(missing_ok=True)
    file.write_bytes(data)
    rows = op.read_warc(spark, path).collect()
    assert sum(r.record_type is None for r in rows) == 1
    assert sum(r.record_type is not None for r in rows) == df.count() - 1


def test_members_end_with_a_zero_byte():
    for data in (b"", b"x", bytes(1 << 24), b"y" * ((1 << 24) + 5)):
        assert op.member(data).endswith(b"\0")
    assert [r["page_id"] for r in op.salvage(op.encode_record(1, "u", b"z" * (1 << 24), 1 << 24, op.sha1_base32(b"z" * (1 << 24)), None))] == [1]


def test_small_payloads_may_stay_whole_and_empty_tables(spark, pages, tmp_path):
    rows, df = pages
    op.write_warc(df, str(tmp_path / "a"), min_payload=1)
    got = op.read_warc(spark, str(tmp_path / "a")).where("payload_bytes = 0").collect()
    assert {r.record_type for r in got} == {"response"}
    op.write_warc(spark.createDataFrame([], SCHEMA), str(tmp_path / "b"))
    assert op.read_warc(spark, str(tmp_path / "b")).count() == 0


def foreign(kind, body, version="1.0", digest=None, **fields):
    """A record as other software writes it."""
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{hashlib.md5(body + kind.encode()).hexdigest()}>", "WARC-Date": "2020-02-02T02:02:02Z",
            **{k.replace("_", "-"): v for k, v in fields.items()}, "Content-Length": str(len(body))}
    if digest:
        head["WARC-Block-Digest"] = digest(body)
    return f"WARC/{version}\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + body + b"\r\n\r\n"


DIGESTS = [None, lambda b: "sha1:" + op.sha1_base32(b), lambda b: "sha1:" + hashlib.sha1(b).hexdigest(), lambda b: "SHA256:" + hashlib.sha256(b).hexdigest(),
           lambda b: "md5:" + hashlib.md5(b).hexdigest().upper(), lambda b: "crc:whatever"]
PAGE = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>page \xc3\xa9</p>\r\n\r\n"


def archive(version, digest):
    return [foreign("warcinfo", b"software: other\r\n", version, digest, Content_Type="application/warc-fields", X_Own="kept"),
            foreign("request", b"GET / HTTP/1.1\r\n\r\n", version, digest, WARC_Target_URI="http://h/%25a", Content_Type="application/http; msgtype=request"),
            foreign("response", PAGE, version, digest, WARC_Target_URI="<http://h/%25a>", Content_Type="application/http; msgtype=response"),
            foreign("revisit", b"HTTP/1.1 304 Not\r\n modified\r\n\r\n", version, digest, WARC_Refers_To="<urn:uuid:1>", WARC_Profile="x\r\n  folded", WARC_Payload_Digest="sha1:ABC"),
            foreign("metadata", b"", version, digest), foreign("resource", b"WARC/1.0\r\n not a record", version, digest, Content_Type="text/plain")]


@pytest.mark.parametrize("packed", ["no", "records", "whole"])
@pytest.mark.parametrize("digest", DIGESTS)
@pytest.mark.parametrize("version", ["1.0", "1.1"])
def test_archives_of_other_software(version, digest, packed):
    import gzip

    records = archive(version, digest)
    content = {"no": b"".join(records), "records": b"".join(map(gzip.compress, records)), "whole": gzip.compress(b"".join(records))}[packed]
    rows = list(op.salvage(content))
    assert [r.get("record_type") for r in rows] == ["warcinfo", "request", "response", "revisit", "metadata", "resource"]
    info, request, response, revisit, metadata, resource = rows
    assert dict(info["fields"])["x-own"] == "kept" and info["page_id"] is None and info["record_id"].startswith("<urn:uuid:")
    assert request["url"] == response["url"] == "http://h/%25a"
    assert response["payload"] == PAGE.split(b"\r\n\r\n", 1)[1] and response["payload_bytes"] == len(response["payload"])
    assert response["payload_digest"] == op.sha1_base32(response["payload"])
    assert (revisit["payload"], revisit["payload_bytes"], revisit["payload_digest"], revisit["refers_to_id"]) == (None, None, "ABC", "<urn:uuid:1>")
    assert dict(revisit["fields"])["warc-profile"] == "x folded" and metadata["payload"] == b"" and resource["payload"].startswith(b"WARC/1.0")


@pytest.mark.parametrize("digest", DIGESTS[1:5])
@pytest.mark.parametrize("packed", [False, True])
def test_a_damaged_foreign_record_costs_itself(digest, packed):
    import gzip

    records = archive("1.0", digest)
    for hit in range(len(records)):
        bad = bytearray(records[hit])
        at = bytes(bad).find(b"\r\n\r\n") + 4 if hit != 4 else 5   # the block's first byte; the empty block's version
        bad[at] ^= 0x20
        if not packed:
            parts = [*records[:hit], bytes(bad), *records[hit + 1:]]
        else:
            parts = [gzip.compress(x) for x in records]
            parts[hit] = parts[hit][:-6] + b"\0\0" + parts[hit][-4:]
        rows = list(op.salvage(b"".join(parts)))
        kinds = ["warcinfo", "request", "response", "revisit", "metadata", "resource"]
        assert [r["record_type"] for r in rows if "record_type" in r] == kinds[:hit] + kinds[hit + 1:]
        assert sum(r["gap_bytes"] for r in rows if "gap_bytes" in r) == len(parts[hit])


def test_a_member_of_several_records_keeps_those_before_the_damage():
    import gzip

    records = archive("1.1", DIGESTS[1])
    bad = gzip.compress(b"".join([*records[:3], records[3].replace(b"304", b"305"), *records[4:]]))
    rows = list(op.salvage(bad + gzip.compress(records[0])))
    assert [r.get("record_type") for r in rows] == ["warcinfo", "request", "response", None, "warcinfo"]
    assert rows[3]["gap_bytes"] == len(bad) and "block digest" in rows[3]["reason"]


def test_missing_fields_and_large_members():
    import gzip

    for field in ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"):
        record = foreign("resource", b"x").replace(field.encode(), b"X-Other")
        (row,) = op.salvage(record)
        assert row["reason"] == "header fields" and row["gap_bytes"] == len(record)
    packed = gzip.compress(foreign("resource", b"y" * 100_000))
    assert [r.get("reason") for r in op.salvage(packed, 50_000)][0] == "member too large"
    assert [r.get("record_type") for r in op.salvage(packed + packed)] == ["resource", "resource"]


def test_files_of_other_names(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(b"".join(archive("1.0", None)) + b"tail")
    rows = op.read_warc(spark, str(tmp_path), names="*.warc").orderBy("offset").collect()
    assert [r.record_type for r in rows] == ["warcinfo", "request", "response", "revisit", "metadata", "resource", None]
    assert rows[0].fields["x-own"] == "kept" and rows[-1].gap_bytes == 4 and rows[2].date == "2020-02-02T02:02:02Z"
