"""Operator 12: WARC archives of pages, normalised to one gzip member a record, with a sidecar offset index.

A crawl writes each archive as one gzip stream. The normaliser inflates such a stream once, from its start to its end, and
rewrites every record as a member of its own; a sidecar index holds each member's place, so any record can be read alone.
On the way, records whose payload another one holds become revisits of it. Payloads never move through a shuffle: Spark
groups their digests and sends each file's decisions to the task that rewrites the file.

Streams are read and written in bounded runs; a task holds one run of a stream, and the decisions one at a time. Files
go through pyarrow's file systems (``common.files``). Attempts write files of their own names, and only the attempt whose row is kept counts.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import groupby
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareseries.llm.common import cut, files, neighbours, written

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
#: Bytes of records, headers included, that an archive holds before the next one begins.
FILE_BYTES = 32 << 20
#: Bytes that are read, or inflated, at a time; an upper bound of a record's header.
RUN_BYTES = 1 << 20

_URI = "!#$%&'()*+,/:;=?@[]~"


def head(fields: Iterable[tuple[str, object]]) -> bytes:
    """A record's header; fields without a value are left out."""
    return b"\r\n".join([VERSION, *[f"{k}: {v}".encode() for k, v in fields if v is not None]]) + END


def fields_of(header: bytes) -> dict[str, str]:
    """Field names in lower case and their values; raises unless it is a WARC header with a length."""
    first, *lines = header.removesuffix(END).split(b"\r\n")
    found = {k.strip().lower(): v.strip() for k, _, v in (line.decode().partition(":") for line in lines)}
    if not first.startswith(b"WARC/") or not found.get("content-length", "").isdigit():
        raise ValueError(f"no WARC header: {header[:80]!r}")
    return found


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def inflate(raw) -> Iterator[bytes]:
    """A gzip stream's content in runs, member after member; raises if the stream is cut short."""
    z, data, open_ = zlib.decompressobj(31), b"", False
    while data := data or raw.read(RUN_BYTES):
        out = z.decompress(data, RUN_BYTES)
        if out:
            yield out
        open_ = not z.eof
        data = z.unconsumed_tail if open_ else z.unused_data
        if not open_:
            z = zlib.decompressobj(31)
    if open_:
        yield z.flush()
        if not z.eof:
            raise ValueError("the gzip stream is cut short")


class Records:
    """Records of an inflated stream, front to back; each body must be read before the next header."""

    def __init__(self, runs: Iterable[bytes]):
        self.runs, self.held = iter(runs), bytearray()

    def header(self, optional: bool = False) -> bytes | None:
        """All up to a blank line, with it; None at the end of the stream."""
        seen = 0
        while (at := self.held.find(END, seen)) < 0:
            seen = max(0, len(self.held) - 3)
            more = next(self.runs, None)
            if more is None:
                if optional and not self.held:
                    return None
                raise ValueError("the archive ends inside a header")
            if len(self.held) > RUN_BYTES + len(END):
                raise ValueError("a header has no end")
            self.held += more
        out = bytes(self.held[: at + len(END)])
        del self.held[: at + len(END)]
        return out

    def body(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes in runs."""
        while n:
            if not self.held:
                more = next(self.runs, None)
                if more is None:
                    raise ValueError("the archive ends inside a record")
                self.held += more
            run = bytes(self.held[:n])
            del self.held[: len(run)]
            n -= len(run)
            yield run

    def close(self) -> None:
        if b"".join(self.body(len(END))) != END:
            raise ValueError("a record is longer than its header says")


class Deflated:
    """Writes gzip members to a stream and counts their bytes."""

    def __init__(self, out, level: int):
        self.out, self.level, self.at = out, level, 0
        self.begin()

    def begin(self) -> None:
        self.z = zlib.compressobj(self.level, zlib.DEFLATED, 31)

    def put(self, data: bytes) -> None:
        self.at += self.out.write(self.z.compress(data))

    def end(self) -> None:
        self.at += self.out.write(self.z.flush())


_RECORDS = "file string, place int, page_id long, target string, record string, payload_bytes long, payload_key binary"


def _crawl(batches: Iterator[pa.RecordBatch], root: str, date: str, level: int, file_bytes: int) -> Iterator[pa.RecordBatch]:
    fs, folder = files(root)
    part, attempt = TaskContext.get().partitionId(), uuid.uuid4()
    out = z = None
    number = place = size = 0

    def put(fields, blocks):
        nonlocal place, size
        header = head(fields)
        for block in (header, *blocks, END):
            z.put(block)
            size += len(block)
        place += 1

    def close():
        if out is not None:
            z.end()
            out.close()

    for batch in batches:
        rows = []
        for page, url, payload in zip(batch.column("id").to_pylist(), batch.column("url").to_pylist(), batch.column("payload"), strict=True):
            payload = payload.as_py() or b""
            if out is None or size > file_bytes:
                close()
                name = f"{folder}/crawl-{part:06d}-{number:04d}-{attempt.hex}.warc.gz"
                out = fs.open_output_stream(name, compression=None)
                z, place, size = Deflated(out, level), 0, 0
                number += 1
                about = b"format: WARC File Format 1.1\r\n"
                put([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(attempt, name)}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields"), ("Content-Length", len(about))], [about])
            http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(payload) + END
            record, target = f"urn:uuid:{uuid.uuid5(attempt, f'{number}/{place}')}", None if url is None else quote(url, safe=_URI)
            rows.append((name, place, page, target, record, len(payload), hashlib.sha256(payload).digest()))
            put([
                ("WARC-Type", "response"), ("WARC-Record-ID", f"<{record}>"), ("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
                ("X-Page-Id", page), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(http) + len(payload)),
            ], [http, payload])
        if rows:
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            names = [c.split()[0] for c in _RECORDS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    close()


def crawl(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "2000-01-01T00:00:00Z", level: int = 6, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write every page as a response record to archives that are one gzip stream each; returns a row for each record.

    Columns: file, place (in the file), page_id, target (the URL with spaces, controls and non-ASCII percent-encoded, or null),
    record, payload_bytes, payload_key (SHA-256). A null payload is empty. Rows that repeat an id, or have none, are records
    of their own; the header names no page then. An empty table gives no files. Other columns are not read.
    """
    fs, folder = files(root)
    fs.create_dir(folder, recursive=True)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(payload_col).cast("binary").alias("payload"))
    return written(rows.mapInArrow(partial(_crawl, root=root, date=date, level=level, file_bytes=file_bytes), _RECORDS))


def revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """file, place of every record, and the record, page and target that it revisits (null: it is a response).

    Of records with equal payloads of at least ``min_bytes`` the one with the largest page_id (null last, then by file and
    place) is the response. Only digests are grouped; the join back is split by Spark where one payload is very common.
    """
    eligible = records.where(F.col("payload_bytes") >= min_bytes)
    best = eligible.groupBy("payload_key").agg(F.max(F.struct("page_id", "file", "place", "record", "target")).alias("best"), F.count("*").alias("n")).where("n > 1")
    other = (F.col("best.file") != F.col("file")) | (F.col("best.place") != F.col("place"))
    found = records.join(best, "payload_key", "left").withColumn("is_revisit", F.coalesce(other & (F.col("payload_bytes") >= min_bytes), F.lit(False)))
    return found.select("file", "place", "is_revisit", *[F.when(F.col("is_revisit"), F.col(f"best.{c}")).alias(f"to_{c}") for c in ("record", "page_id", "target")])


_MANIFEST = "data string, index string, records long, bytes long"


def _rewrite(source, data, index, decisions: Iterator[dict], level: int, date: str) -> tuple[int, int]:
    """Rewrite an inflated archive record by record, with its index; returns the number of records and the bytes written."""
    records, out, count = Records(inflate(source)), Deflated(data, level), 0
    decision = next(decisions, None)
    while (header := records.header(optional=True)) is not None:
        fields, at = fields_of(header), out.at
        left = int(fields["content-length"])
        blocks: Iterable[bytes] = records.body(left)
        kind, seen = fields.get("warc-type", ""), hashlib.sha1()
        mine = decision if decision and decision["place"] == count else None
        whole = kind == "response" and fields.get("content-type", "").startswith("application/http")
        if whole:
            http = records.header()
            if len(http) > left:
                raise ValueError(f"{fields.get('warc-record-id')}: a response without an HTTP header")
            payload = records.body(left - len(http))
            if mine and mine["is_revisit"]:
                kind = "revisit"
                for run in payload:
                    seen.update(run)
                header = head([
                    ("WARC-Type", kind), ("WARC-Record-ID", fields.get("warc-record-id")), ("WARC-Date", fields.get("warc-date")), ("WARC-Target-URI", fields.get("warc-target-uri")),
                    ("WARC-Payload-Digest", fields.get("warc-payload-digest")), ("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<{mine['to_record']}>"), ("WARC-Refers-To-Target-URI", mine["to_target"]),
                    ("WARC-Refers-To-Date", date), ("X-Page-Id", fields.get("x-page-id")), ("X-Refers-To-Page-Id", mine["to_page_id"]), ("Content-Type", fields.get("content-type")), ("Content-Length", len(http)),
                ])
                blocks = [http]
            else:
                def hashed(http=http, payload=payload, seen=seen):
                    yield http
                    for run in payload:
                        seen.update(run)
                        yield run
                blocks = hashed()
        out.begin()
        out.put(header)
        for block in blocks:
            out.put(block)
        records.close()
        out.put(END)
        out.end()
        said = fields.get("warc-payload-digest")
        if whole and said and said != f"sha1:{base64.b32encode(seen.digest()).decode()}":
            raise ValueError(f"{fields.get('warc-record-id')}: the payload does not have the digest of its header")
        line = [at, out.at - at, kind, fields.get("warc-record-id", "-"), said or "-", fields.get("warc-target-uri", "-")]
        index.write(" ".join(map(str, line)).encode() + b"\n")
        if mine:
            decision = next(decisions, None)
        count += 1
    if decision is not None:
        raise ValueError("the archive has fewer records than it was written with")
    return count, out.at


def _normalise(batches: Iterator[pa.RecordBatch], root: str, level: int, date: str) -> Iterator[pa.RecordBatch]:
    fs, folder = files(root)
    rows = (row for batch in batches for row in batch.to_pylist())
    for file, decisions in groupby(rows, key=lambda row: row["file"]):
        name = f"{folder}/{file.rsplit('/', 1)[-1].removesuffix('.warc.gz').replace('crawl-', 'pages-')}-{uuid.uuid4().hex}"
        with fs.open_input_stream(file, compression=None) as source, fs.open_output_stream(f"{name}.warc.gz", compression=None) as data, fs.open_output_stream(f"{name}.idx") as index:
            records, size = _rewrite(source, data, index, iter(decisions), level, date)
        yield pa.RecordBatch.from_pylist([{"data": f"{name}.warc.gz", "index": f"{name}.idx", "records": records, "bytes": size}], schema=pa.schema([("data", pa.string()), ("index", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))


def normalise(decisions: DataFrame, root: str, date: str = "2000-01-01T00:00:00Z", level: int = 6) -> DataFrame:
    """Rewrite the archives that ``decisions`` name, one gzip member a record; returns data, index, records, bytes by file.

    A line of an index: offset and length of a member, record type, record id, payload digest, target, parted by spaces
    (``-``: none). Records without a decision are kept as they are. A payload that lacks its digest raises.
    """
    number = decisions.select("file").distinct().count()
    rows = decisions.repartitionByRange(max(1, number), "file").sortWithinPartitions("file", "place")
    return cut(rows.mapInArrow(partial(_normalise, root=root, level=level, date=date), _MANIFEST))


def write_warc(pages: DataFrame, root: str, min_bytes: int = 0, **options) -> DataFrame:
    """``crawl``, ``revisits`` and ``normalise`` in turn; returns the manifest of the normalised archives."""
    return normalise(revisits(crawl(pages, root, **options), min_bytes), root)


_READ = "page_id long, url string, record string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def read_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a member that holds one record."""
    records = Records([zlib.decompress(raw, 31)])
    fields = fields_of(records.header())
    block = b"".join(records.body(int(fields["content-length"])))
    records.close()
    return fields, block


def _read(batches: Iterator[pa.RecordBatch], root: str, payloads: bool) -> Iterator[pa.RecordBatch]:
    fs, _ = files(root)
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in _READ.split(", ")]

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for batch in batches:
        for row in batch.to_pylist():
            with fs.open_input_stream(row["index"]) as f:
                places = [tuple(map(int, line.split(b" ", 2)[:2])) for line in f.read().splitlines()]
            if len(places) != row["records"] or sum(n for _, n in places) != row["bytes"]:
                raise ValueError(f"{row['index']} does not hold what the manifest says")
            rows, size = [], 0
            with fs.open_input_file(row["data"]) as data:
                for first, last in neighbours(places, RUN_BYTES):
                    base = places[first][0]
                    raw = memoryview(data.read_at(places[last - 1][0] + places[last - 1][1] - base, base))
                    for at, n in places[first:last]:
                        fields, block = read_record(raw[at - base : at - base + n])
                        kind = fields.get("warc-type")
                        if kind not in ("response", "revisit"):
                            continue
                        http, _, payload = block.partition(END)
                        said = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                        length = next(int(v) for k, _, v in (h.partition(b":") for h in http.split(b"\r\n")) if k.lower() == b"content-length")
                        if kind == "response" and (len(payload) != length or digest(payload) != said):
                            raise ValueError(f"{row['data']} at {at}: the payload is not what its headers say")
                        page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
                        rows.append((None if page is None else int(page), fields.get("warc-target-uri"), fields.get("warc-record-id"), kind, None if refers is None else int(refers), length, said, payload if payloads and kind == "response" else None))
                        size += 400 + len(payload) * payloads
                        if size > 8 << 20:
                            yield out(rows)
                            rows, size = [], 0
            if rows:
                yield out(rows)


def read_warc(manifest: DataFrame, root: str, id_col: str = "page_id", payloads: bool = True) -> DataFrame:
    """A row for each response and revisit of the archives, each read by its place in the index.

    Columns: id_col, url (as the record names it), record, record_type, refers_to (id of the response, for revisits),
    payload_bytes, payload_digest (both of the full payload), payload (of responses; null if ``payloads`` is false).
    """
    places = manifest.repartitionByRange(max(1, manifest.count()), "data")
    return places.mapInArrow(partial(_read, root=root, payloads=payloads), _READ).withColumnRenamed("page_id", id_col)
