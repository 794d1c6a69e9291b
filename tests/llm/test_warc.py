"""Operator 12: archives written, normalised and read back."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib

import pytest
from pyspark.sql import functions as F

from rareseries.llm import warc
from rareseries.llm.common import files

SCHEMA = "page_id long, url string, html string"


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def pages_of():
    rows = [(i, f"http://a.example/{i}?q=ü x", f"<html>page {i % 17} é</html>" * (1 + i % 5)) for i in range(300)]
    rows += [(1000 + i, None, "hot copy") for i in range(200)]
    rows += [(2000, "http://b.example/\r\nX-Page-Id: 7", "WARC/1.1\r\n\r\nbody"), (2001, "", ""), (2002, "u", None), (2003, "u", ""), (2004, "u", "\r\n\r\n" * 5), (2005, "u", "x\x00y" * 800_000)]
    return rows


def expected(rows, min_bytes=0):
    best = {}
    for i, _, t in rows:
        best[t or ""] = max(best.get(t or "", -1), i)
    out = []
    for i, _, t in rows:
        t = t or ""
        first = best[t] == i or len(t.encode()) < min_bytes
        out.append((i, len(t.encode()), sha(t), "response" if first else "revisit", None if first else best[t]))
    return sorted(out)


@pytest.mark.parametrize(("file_bytes", "min_bytes"), [(32 << 20, 0), (3000, 0), (20_000, 30)])
def test_round_trip(spark, tmp_path, file_bytes, min_bytes):
    rows = pages_of()
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit("x") for c in ("id", "file", "place", "payload", "record", "target")})
    root = f"file://{tmp_path}"
    manifest = warc.write_warc(pages, root, min_bytes=min_bytes, file_bytes=file_bytes)
    assert manifest.count() >= (3 if file_bytes > 1 << 20 else 10)
    got = warc.read_warc(manifest, root).collect()
    assert sorted((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == expected(rows, min_bytes)
    text = {i: (t or "").encode() for i, _, t in rows}
    for r in got:
        assert (bytes(r["payload"]) == text[r["page_id"]]) if r["record_type"] == "response" else r["payload"] is None
    assert {r["page_id"]: r["url"] for r in got}[5] == "http://a.example/5?q=%C3%BC%20x" and {r["page_id"]: r["url"] for r in got}[1000] is None


def test_members_stand_alone(spark, tmp_path):
    """Every line of an index names a gzip member that holds one whole record; the members are the whole file."""
    root = f"file://{tmp_path}"
    manifest = warc.write_warc(spark.createDataFrame(pages_of(), SCHEMA).coalesce(2), root, file_bytes=50_000)
    ids, refers = set(), []
    for row in manifest.collect():
        raw, at = open(row["data"], "rb").read(), 0
        for line in open(row["index"], encoding="utf-8").read().splitlines():
            first, n, kind, record, digest, _ = line.split(" ")
            assert int(first) == at
            z = zlib.decompressobj(31)
            record_bytes = z.decompress(raw[at : at + int(n)])
            assert z.eof and not z.unused_data
            fields, block = warc.read_record(raw[at : at + int(n)])
            assert record_bytes.startswith(b"WARC/1.1\r\n") and fields["warc-type"] == kind and fields["warc-record-id"] == record
            at += int(n)
            if kind == "response":
                assert digest == "sha1:" + base64.b32encode(hashlib.sha1(block.partition(b"\r\n\r\n")[2]).digest()).decode()
                ids.add(record)
            if kind == "revisit":
                assert fields["warc-profile"] == warc.REVISIT
                refers.append(fields["warc-refers-to"])
        assert at == len(raw) == row["bytes"]
        assert gzip.decompress(raw).count(b"WARC/1.1\r\nWARC-Type: warcinfo") == 1
    assert refers and set(refers) <= ids


def test_repeated_and_missing_ids(spark, tmp_path):
    rows = [(None, "u", "same")] * 40 + [(7, "u", "same")] * 40 + [(3, "u", "same"), (None, "v", "lone"), (None, "v", "pair"), (None, "v", "pair")]
    root = f"file://{tmp_path}"
    got = warc.read_warc(warc.write_warc(spark.createDataFrame(rows, SCHEMA).repartition(4), root), root).collect()
    assert len(got) == len(rows)
    same = [r for r in got if r["payload_digest"] == sha("same")]
    assert [(r["page_id"], r["refers_to"]) for r in same if r["record_type"] == "response"] == [(7, None)]
    assert {r["refers_to"] for r in same if r["record_type"] == "revisit"} == {7}
    assert sorted(r["record_type"] for r in got if r["payload_digest"] == sha("pair")) == ["response", "revisit"]


def test_empty(spark, tmp_path):
    root = f"file://{tmp_path}"
    manifest = warc.write_warc(spark.createDataFrame([], SCHEMA), root)
    assert manifest.count() == 0 and warc.read_warc(manifest, root).count() == 0


def rewrite(raw: bytes, decisions=()):
    data, index = io.BytesIO(), io.BytesIO()
    return warc._rewrite(io.BytesIO(raw), data, index, iter(decisions), 6, "d"), data.getvalue(), index.getvalue()


def record(kind, block, *more):
    return warc.head([("WARC-Type", kind), ("WARC-Record-ID", f"<{kind}>"), *more, ("Content-Length", len(block))]) + block + b"\r\n\r\n"


def test_foreign_streams():
    """Other record types pass unchanged, members of the input may hold any number of records, and damage raises."""
    http = b"HTTP/1.1 200 OK\r\n\r\nhello"
    good = record("response", http, ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{sha('hello')}"))
    other = record("metadata", b"a: b\r\n\r\n" * 9) + record("response", b"20260101 an answer", ("Content-Type", "text/dns"))
    (count, size), data, index = rewrite(gzip.compress(other + good) + gzip.compress(good))
    assert count == 4 and size == len(data) and gzip.decompress(data) == other + good + good
    assert [line.split()[2] for line in index.decode().splitlines()] == ["metadata", "response", "response", "response"]
    with pytest.raises(ValueError, match="cut short"):
        rewrite(gzip.compress(other + good)[:-9])
    with pytest.raises(ValueError, match="digest"):
        rewrite(gzip.compress(good.replace(b"hello", b"jello")))
    with pytest.raises(ValueError, match="longer"):
        rewrite(gzip.compress(good[:-4] + b"more" + good))
    with pytest.raises(ValueError, match="inside"):
        rewrite(gzip.compress(good[:-12]))


def test_inflate_bombs_in_runs():
    raw = gzip.compress(bytes(40 << 20))
    sizes = [len(x) for x in warc.inflate(io.BytesIO(raw))]
    assert sum(sizes) == 40 << 20 and max(sizes) <= warc.RUN_BYTES


def test_file_systems():
    assert files("file:/tmp/x")[1] == files("file:///tmp/x")[1] == files("/tmp/x")[1] == "/tmp/x"
    with pytest.raises(Exception, match="(?i)scheme|unrecognized"):
        files("nowhere://x/y")
