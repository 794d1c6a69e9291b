"""Operator 5: token ids in length-delimited binary record files with offset indexes.

A record: length (u64), masked CRC-32 of those eight bytes (u32), payload, masked CRC-32 of the payload (u32), all
little-endian. The payload is a serialized sequence: flags (u8; 1: the id is null), width of an id in bytes (u8),
document id (i64), ids. Each data file ``part-N.rec`` has an index ``part-N.idx`` of (offset u64, record length u64) by
record, so records can be read in any order. Masking is a rotation by 15 bits plus a constant, so that the checksum of
data that holds checksums stays sound. Files go through pyarrow's file systems, by URI (``common.files`` names the schemes).
"""

from __future__ import annotations

import math
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rareseries.llm.common import cut, files, neighbours, slices
from rareseries.llm.tokens import encoder, tokenizer_path, with_end
from rareseries.session import ensure_checkpoint_dir

_HEAD, _CRC, _META, _INDEX = "<Q", "<I", "<BBq", "<QQ"
#: Bytes that are read from a file at a time, or one record.
READ_BYTES = 1 << 20
#: Files whose first places are broadcast (a number and a sum each, some 8 MB).
MAX_BROADCAST_FILES = 1 << 18
#: Bytes of text that go to one file, on average.
FILE_BYTES = 32 << 20


def masked(crc: int) -> int:
    """Rotate right by 15 bits and add a constant."""
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack(_HEAD, len(payload))
    return b"".join((head, struct.pack(_CRC, masked(zlib.crc32(head))), payload, struct.pack(_CRC, masked(zlib.crc32(payload)))))


def unframe(raw, at: int = 0) -> tuple[memoryview, int]:
    """The payload at a place in a buffer and the place after its record; raises on a wrong checksum or a short file."""
    raw = memoryview(raw)
    if at + 16 > len(raw):
        raise ValueError(f"record at {at} is cut short")
    (n,) = struct.unpack_from(_HEAD, raw, at)
    if masked(zlib.crc32(raw[at : at + 8])) != struct.unpack_from(_CRC, raw, at + 8)[0]:
        raise ValueError(f"wrong checksum of the length at {at}")
    if at + 16 + n > len(raw):
        raise ValueError(f"record at {at} is cut short")
    payload = raw[at + 12 : at + 12 + n]
    if masked(zlib.crc32(payload)) != struct.unpack_from(_CRC, raw, at + 12 + n)[0]:
        raise ValueError(f"wrong checksum of the payload at {at}")
    return payload, at + 16 + n


def serialize(name: int | None, ids: np.ndarray, width: int) -> bytes:
    return struct.pack(_META, name is None, width, name or 0) + ids.astype(f"<u{width}").tobytes()


def deserialize(payload) -> tuple[int | None, np.ndarray]:
    null, width, name = struct.unpack_from(_META, payload)
    return (None if null else name), np.frombuffer(payload, dtype=f"<u{width}", offset=struct.calcsize(_META))


_MANIFEST = "part int, data string, index string, records long, tokens long"


def _write(batches: Iterator[pa.RecordBatch], root: str, path: str, end: int) -> Iterator[pa.RecordBatch]:
    """Write one task's sorted rows; attempts have names of their own, and only the attempt that ends is listed."""
    fs, folder = files(root)
    encode, part = encoder(path), TaskContext.get().partitionId()
    width = 2 if encode.size <= 1 << 16 else 4
    name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}"
    at = records = total = 0
    with fs.open_output_stream(f"{name}.rec") as data, fs.open_output_stream(f"{name}.idx") as index:
        for batch in batches:
            for run in slices(batch, "text"):
                ids, offsets = with_end(*encode(run.column("text")), end)
                for doc, a, b in zip(run.column("id").to_pylist(), offsets[:-1], offsets[1:], strict=True):
                    record = frame(serialize(doc, ids[a:b], width))
                    data.write(record)
                    index.write(struct.pack(_INDEX, at, len(record)))
                    at += len(record)
                    records += 1
                total += len(ids)
    yield pa.RecordBatch.from_pylist([{"part": part, "data": f"{name}.rec", "index": f"{name}.idx", "records": records, "tokens": total}], schema=pa.schema([("part", pa.int32()), ("data", pa.string()), ("index", pa.string()), ("records", pa.int64()), ("tokens", pa.int64())]))


def write_records(docs: DataFrame, root: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end: int = 0) -> DataFrame:
    """Write the files below ``root`` (a URI) in ascending id order; returns the manifest: part, data, index, records, tokens.

    A null id comes first; rows with equal ids follow one another by a hash of their text, then by text. Null
    texts are empty and give a record with the id ``end`` only. An empty table may give files without records.
    """
    path = path or tokenizer_path()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    rows = rows.withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange(max(1, math.ceil(total / FILE_BYTES)), "id", "h").sortWithinPartitions("id", "h", "text").select("id", "text")
    fs, folder = files(root)
    fs.create_dir(folder, recursive=True)
    return cut(rows.mapInArrow(partial(_write, root=root, path=path, end=end), _MANIFEST))


_READ = "id long, part int, place long, before long, ids binary"


def _read(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    fs, _ = files(root)
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        for row in batch.to_pylist():
            with fs.open_input_file(row["index"]) as f:
                index = np.frombuffer(f.read(), dtype="<u8").reshape(-1, 2).astype(np.int64)
            out, before, size = [[], [], [], [], []], 0, 0
            with fs.open_input_file(row["data"]) as data:
                places = [tuple(x) for x in index.tolist()]
                for first, last in neighbours(places, READ_BYTES):
                    base, end = places[first][0], sum(places[last - 1])
                    raw = memoryview(data.read_at(end - base, base))
                    for place in range(first, last):
                        at, n = places[place]
                        payload, stop = unframe(raw[at - base : at - base + n])
                        if stop != n:
                            raise ValueError(f"{row['data']}: the index disagrees with the record at {at}")
                        name, ids = deserialize(payload)
                        for column, x in zip(out, (name, row["part"], place, before, ids.astype("<u4").tobytes()), strict=True):
                            column.append(x)
                        before += len(ids)
                        size += len(out[-1][-1])
                        if size > 16 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], ["id", "part", "place", "before", "ids"])
                            out, size = [[], [], [], [], []], 0
            if before != row["tokens"] or len(index) != row["records"]:
                raise ValueError(f"{row['data']} does not hold what the manifest says")
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], ["id", "part", "place", "before", "ids"])


def read_records(manifest: DataFrame, root: str, id_col: str = "doc_id") -> DataFrame:
    """One row per record, from the files: id_col, start (ids of all records before it), ids (little-endian u32).

    ``manifest`` may be any subset of files, in any order; start always counts from its first part.
    """
    run = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = manifest.select("part", F.coalesce(F.sum("tokens").over(run), F.lit(0)).alias("first"))
    # one file to a task: a given number of partitions is not merged again, however short the manifest
    number = manifest.count()
    records = manifest.repartitionByRange(max(1, number), "part").mapInArrow(partial(_read, root=root), _READ)
    return records.join(F.broadcast(first) if number <= MAX_BROADCAST_FILES else first, "part").select(F.col("id").alias(id_col), (F.col("first") + F.col("before")).alias("start"), "ids")


def new_root(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
