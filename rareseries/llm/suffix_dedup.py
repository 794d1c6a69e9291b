"""Operator 3: removal of byte strings that repeat across documents, by rank doubling over sampled suffixes.

Ranking every byte position would shuffle some sixteen times the input, so the suffixes are sampled first: each
50-byte window stands under its smallest 24-byte string (by hash, leftmost on ties), the anchor. Equal windows have equal
anchors at equal offsets, so nothing is lost. Then comparison lengths grow, as in prefix doubling:

* round 1 ranks anchors by 24 bytes and, inside an equal rank, by the whole stretch that their windows cover (up to
  75 bytes). Anchors whose rank is unique are done, as are those whose whole stretch occurs in a smaller document;
* round 2 ranks the remaining windows (at the ends of repeats) by all 50 bytes, past the threshold.

Documents travel in chunks; a chunk sends each distinct rank once, with its smallest document, so a string that
a third of all documents share costs one entry for each chunk. Ranks are compared as hashes: 112 bits in round 1 and 96 bits
in round 2. Entries are packed as sorted arrays; the text itself is shuffled once and its exchange is used three times.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareseries.llm import textkernel as K
from rareseries.llm.common import slices

#: Bytes of text in a chunk, on average; entries that a task ranks together, on average.
CHUNK_BYTES = 4 << 20
BUCKET_ENTRIES = 300_000
#: Bytes of text taken at a time (some 150 bytes of arrays for each).
SLICE_BYTES = 1 << 19
#: A null id counts as larger than any.
_NULL_ID = np.iinfo(np.int64).max
_U = np.uint64


def _planes(x: np.ndarray) -> bytes:
    """Eight-byte numbers by byte planes (constant planes compress away in the shuffle)."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes()


def _numbers(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, dtype=np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


class _Part:
    """Anchors and windows of a run of documents."""

    def __init__(self, ids: np.ndarray, column: pa.Array, length: int, k: int):
        self.length, self.ids = length, ids
        self.data, self.offsets = K.text_buffers(column)
        n, w = len(self.data), length - k + 1
        if n < length:
            self.q = np.zeros(0, dtype=np.int64)
            self.g = self.f = np.zeros(0, dtype=_U)
            self.lo = self.hi = self.doc = self.q
            return
        up, self.down = K._power("up", K._P, n + 1), K._power("down", K._P_INV, n + 1)
        self.total = np.zeros(n + 1, dtype=_U)
        np.cumsum((self.data.astype(_U) + _U(1)) * up[:n], out=self.total[1:])
        grams = K.mix((self.total[k:] - self.total[:-k]) * self.down[: n - k + 1])
        low = (grams & _U(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=_U)
        size = 1
        while size * 2 <= w:
            low, size = np.minimum(low[:-size], low[size:]), size * 2
        if size < w:
            low = np.minimum(low[: len(low) - (w - size)], low[w - size :])
        # windows that stay inside a document, and the runs of them that share an anchor
        doc = np.repeat(np.arange(len(ids)), np.diff(self.offsets))[: len(low)]
        inside = np.arange(length, len(low) + length) <= self.offsets[1:][doc]
        p, doc = np.flatnonzero(inside), doc[inside]
        q = (low[p] & _U(0xFFFFFFFF)).astype(np.int64)
        if not len(p):
            self.q = np.zeros(0, dtype=np.int64)
            self.g = self.f = np.zeros(0, dtype=_U)
            self.lo = self.hi = self.doc = self.q
            return
        cut = np.flatnonzero(np.concatenate([[True], (q[1:] != q[:-1]) | (doc[1:] != doc[:-1]), [True]]))
        self.lo, self.hi, self.q, self.doc = p[cut[:-1]], p[cut[1:] - 1], q[cut[:-1]], doc[cut[:-1]]
        self.g = grams[self.q]
        stretch = (self.total[self.hi + length] - self.total[self.lo]) * self.down[self.lo]
        shape = (self.q - self.lo).astype(_U) * _U(0xC2B2AE3D27D4EB4F) + (self.hi - self.q + 1000).astype(_U) * _U(0x9FB21C651E98DF25)
        self.f = K.mix(stretch + shape) >> _U(16)

    def windows(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, 64-bit rank, 32 more bits, document) of all windows of these anchors."""
        count = self.hi[anchors] - self.lo[anchors] + 1
        first = np.concatenate([[0], np.cumsum(count)[:-1]]) if len(count) else np.zeros(0, dtype=np.int64)
        p = np.repeat(self.lo[anchors] - first, count) + np.arange(int(count.sum()))
        q, g = np.repeat(self.q[anchors], count), np.repeat(self.g[anchors], count)
        rank = K.mix((self.total[p + self.length] - self.total[p]) * self.down[p])
        return p, rank, (g >> _U(32)) ^ (q - p).astype(_U), np.repeat(self.doc[anchors], count)


def _parts(group: pa.Table, length: int, k: int):
    batch = group.combine_chunks().to_batches()
    for b in batch:
        for s in slices(b.select(["id", "text"]), "text", SLICE_BYTES):
            ids = s.column("id").fill_null(int(_NULL_ID)).to_numpy(zero_copy_only=False)
            yield s, _Part(ids, s.column("text"), length, k)


def _distinct(a: np.ndarray, b: np.ndarray, doc: np.ndarray):
    """Distinct (a, b) in order with the smallest document of each, and the place of each row among them."""
    order = np.lexsort((doc, b, a))
    a, b, doc = a[order], b[order], doc[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    place = np.empty(len(a), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return a[new], b[new], doc[new], place


def _bucket(a: np.ndarray, buckets: int) -> np.ndarray:
    return ((a >> _U(40)) * _U(buckets) >> _U(24)).astype(np.int64)


_ENTRIES = "bucket int, chunk int, a binary, b binary, doc binary"


def _packed(chunk, a, b, doc, buckets: int) -> pa.Table:
    place = _bucket(a, buckets)
    edges = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1], [True]])) if len(a) else np.zeros(1, dtype=np.int64)
    rows = list(zip(edges[:-1], edges[1:], strict=True))
    step = lambda i, j: _planes(np.diff(a[i:j], prepend=_U(0)))
    return pa.table({
        "bucket": pa.array([int(place[i]) for i, _ in rows], pa.int32()), "chunk": pa.array([chunk] * len(rows), pa.int32()),
        "a": pa.array([step(i, j) for i, j in rows], pa.binary()), "b": pa.array([_planes(np.ascontiguousarray(b[i:j])) for i, j in rows], pa.binary()),
        "doc": pa.array([_planes(np.ascontiguousarray(doc[i:j])) for i, j in rows], pa.binary()),
    })


def _merged_anchors(group: pa.Table, length: int, k: int):
    parts = list(_parts(group, length, k))
    cat = lambda name, kind: np.concatenate([np.zeros(0, dtype=kind), *(getattr(p, name) for _, p in parts)])
    doc = np.concatenate([np.zeros(0, dtype=np.int64), *(p.ids[p.doc] for _, p in parts)])
    return parts, doc, _distinct(cat("g", _U), cat("f", _U), doc)


def _anchor_entries(key, group, length: int, k: int, buckets: int):
    _, _, (g, f, doc, _) = _merged_anchors(group, length, k)
    return _packed(key[0].as_py(), g, f, doc, buckets)


def _gathered(group: pa.Table):
    a = [np.cumsum(_numbers(x), dtype=_U) for x in group.column("a").to_pylist()]
    b = [_numbers(x) for x in group.column("b").to_pylist()]
    doc = [_numbers(x).view(np.int64) for x in group.column("doc").to_pylist()]
    return np.concatenate(a), np.concatenate(b), np.concatenate(doc), np.cumsum([0, *(len(x) for x in a)])


def _judge(key, group, expand: bool):
    """For each entry 1 if a smaller document has it; with ``expand`` else 2 if its first rank has other stretches too."""
    a, b, doc, cuts = _gathered(group)
    ua, _, first, place = _distinct(a, b, doc)
    flags = (first[place] < doc).astype(np.uint8)
    if expand:
        new = np.concatenate([[True], ua[1:] != ua[:-1]])
        several = (np.bincount(np.cumsum(new) - 1) > 1)[np.cumsum(new) - 1]
        flags[(flags == 0) & several[place]] = 2
    rows = [flags[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.table({"chunk": group.column("chunk"), "bucket": group.column("bucket"), "flags": pa.array(rows, pa.binary())})


_FLAGS = "chunk int, bucket int, flags binary"


def _flags(group: pa.Table) -> np.ndarray:
    order = np.argsort(group.column("bucket").to_numpy())
    rows = group.column("flags").to_pylist()
    return np.frombuffer(b"".join(rows[i] for i in order), dtype=np.uint8)


def _resolved(group: pa.Table, flags: pa.Table, length: int, k: int):
    """Parts of a chunk; by part, which anchors are repeats as a whole, and the windows still open."""
    parts, doc, (_, _, first, place) = _merged_anchors(group, length, k)
    flag = _flags(flags)
    mine = flag[place] if len(place) else np.zeros(0, dtype=np.uint8)
    repeat = (doc > first[place]) | (mine == 1) if len(place) else np.zeros(0, dtype=bool)
    cuts = np.cumsum([0, *(len(p.q) for _, p in parts)])
    opened = [p.windows(np.flatnonzero((mine[i:j] == 2) & ~repeat[i:j])) if j > i else None for (_, p), i, j in zip(parts, cuts[:-1], cuts[1:], strict=True)]
    have = [(p, o) for (_, p), o in zip(parts, opened, strict=True) if o is not None]
    cat = lambda n, kind: np.concatenate([np.zeros(0, dtype=kind), *(o[n] for _, o in have)])
    wdoc = np.concatenate([np.zeros(0, dtype=np.int64), *(p.ids[o[3]] for p, o in have)])
    return parts, [repeat[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)], opened, wdoc, _distinct(cat(1, _U), cat(2, _U), wdoc)


def _window_entries(key, group, flags, length: int, k: int, buckets: int):
    if not group.num_rows:
        return _packed(0, np.zeros(0, _U), np.zeros(0, _U), np.zeros(0, np.int64), buckets)
    *_, (rank, more, doc, _) = _resolved(group, flags, length, k)
    return _packed(key[0].as_py(), rank, more, doc, buckets)


_OUT = "id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"


def _removed(key, group, flags, length: int, k: int):
    """The documents of a chunk with their removed runs and what is left of them."""
    anchor_flags = flags.filter(pa.compute.equal(flags.column("round"), 1))
    window_flags = flags.filter(pa.compute.equal(flags.column("round"), 2))
    out = [[], [], [], [], []]
    if group.num_rows:
        parts, repeat, opened, wdoc, (_, _, first, place) = _resolved(group, anchor_flags, length, k)
        flag = _flags(window_flags)
        again = (wdoc > first[place]) | (flag[place] == 1) if len(place) else np.zeros(0, dtype=bool)
        done = 0
        for (batch, p), whole, o in zip(parts, repeat, opened, strict=True):
            cover = np.zeros(len(p.data) + 1, dtype=np.int32)
            if o is not None:
                np.add.at(cover, p.lo[whole], 1)
                np.add.at(cover, p.hi[whole] + length, -1)
                hit = o[0][again[done : done + len(o[0])]]
                done += len(o[0])
                np.add.at(cover, hit, 1)
                np.add.at(cover, hit + length, -1)
            gone = np.cumsum(cover[:-1]) > 0
            for i, (name, s, e) in enumerate(zip(batch.column("id").to_pylist(), p.offsets[:-1], p.offsets[1:], strict=True)):
                mask = gone[s:e]
                turn = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
                out[0].append(name)
                out[1].append(int(e - s))
                out[2].append(int(mask.sum()))
                out[3].append([{"start": int(a), "end": int(b)} for a, b in zip(turn[::2], turn[1::2], strict=True)])
                out[4].append(p.data[s:e][~mask].tobytes())
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(span), pa.binary()]
    return pa.table([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=["id", "n_bytes", "n_removed", "spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """One row per document: id_col, n_bytes, n_removed, spans (array of start, end), kept (bytes).

    A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller id. Strings never
    cross documents and are judged on the input. Null texts are empty. Documents shorter than ``length`` stay whole.
    Rows that repeat an id do not remove one another; a null id counts as larger than any, and null ids do
    not remove one another. What is kept may cut a character, so it is binary. Other columns are ignored.
    """
    k = max(1, length // 2 - 1)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    chunks = max(1, math.ceil(total / CHUNK_BYTES))
    buckets = max(1, math.ceil(total * 2 / (length - k + 2) / BUCKET_ENTRIES))
    # by id and text, so that the rows of one id, and those without any, spread over the chunks
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks)).cast("int"))
    text = rows.groupBy("chunk")
    setting = {"length": length, "k": k}
    entries = text.applyInArrow(_bind(_anchor_entries, **setting, buckets=buckets), _ENTRIES)
    flags = entries.groupBy("bucket").applyInArrow(_bind(_judge, expand=True), _FLAGS)
    entries = text.cogroup(flags.groupBy("chunk")).applyInArrow(_bind(_window_entries, **setting, buckets=buckets), _ENTRIES)
    again = entries.groupBy("bucket").applyInArrow(_bind(_judge, expand=False), _FLAGS)
    both = flags.withColumn("round", F.lit(1)).union(again.withColumn("round", F.lit(2)))
    found = text.cogroup(both.groupBy("chunk")).applyInArrow(_bind(_removed, **setting), _OUT)
    return found.withColumnRenamed("id", id_col)


def _bind(function, **setting):
    """A plain function of the groups alone, as applyInArrow wants it."""
    if "flags" in function.__code__.co_varnames[:3]:
        return lambda key, left, right: partial(function, **setting)(key, left, right)
    return lambda key, group: partial(function, **setting)(key, group)
