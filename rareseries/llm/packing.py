"""Operator 9: packing documents into training sequences by first-fit decreasing in randomised groups.

Each document's ids are cut into whole sequences and one tail. Inside a group the tails go, longest first, to the
first open sequence with room, found in a tournament tree over the sequences' free capacities. Then the emptiest
sequences are taken apart to fill the gaps of the others exactly; what is left over (less than one
sequence a group) is cut into lengths that are powers of two, which need no padding.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareseries.llm.common import slices
from rareseries.llm.tokens import encoder, tokenizer_path, with_end

#: Documents and bytes of text in a group at most, on average.
GROUP_DOCS, GROUP_BYTES = 1024, 8 << 20


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[int]:
    """Bin of each item. The tree's inner nodes hold the largest free capacity below them; leaves are bins in order."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    leaves = 1
    while leaves < max(1, len(lengths)):
        leaves *= 2
    free = [capacity] * (2 * leaves)
    bins = [0] * len(lengths)
    for i in order:
        need, node = lengths[i], 1
        while node < leaves:
            node *= 2
            if free[node] < need:
                node += 1
        bins[i] = node - leaves
        free[node] -= need
        while node > 1:
            node //= 2
            best = max(free[2 * node], free[2 * node + 1])
            if free[node] == best:
                break
            free[node] = best
    return bins


def lay_out(sizes: np.ndarray, capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents with ``sizes`` ids each."""
    out, sequence = [], 0
    tails = []
    for d, n in enumerate(sizes):
        for s in range(0, n - n % capacity, capacity):
            out.append((d, s, capacity, sequence, 0))
            sequence += 1
        if n % capacity:
            tails.append((d, int(n - n % capacity), int(n % capacity)))
    bins = first_fit_decreasing([t[2] for t in tails], capacity)
    held: dict[int, list] = {}
    for tail, b in zip(tails, bins, strict=True):
        held.setdefault(b, []).append(tail)
    filled = sorted(held.values(), key=lambda x: -sum(t[2] for t in x))
    whole = sum(t[2] for t in tails) // capacity
    loose = [t for x in filled[whole:] for t in x][::-1]  # the pieces that fill gaps, last one first
    for x in filled[:whole]:
        at = 0
        for d, s, n in x:
            out.append((d, s, n, sequence, at))
            at += n
        while at < capacity:
            d, s, n = loose.pop()
            take = min(n, capacity - at)
            out.append((d, s, take, sequence, at))
            at += take
            if take < n:
                loose.append((d, s + take, n - take))
        sequence += 1
    rest = sum(t[2] for t in loose)
    while rest:
        size = 1 << (rest.bit_length() - 1)  # the largest power of two that is left
        at = 0
        while at < size:
            d, s, n = loose.pop()
            take = min(n, size - at)
            out.append((d, s, take, sequence, at))
            at += take
            if take < n:
                loose.append((d, s + take, n - take))
        sequence += 1
        rest -= size
    return out


_PIECES = "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _pack(key, group, path: str, end: int, capacity: int):
    encode = encoder(path)
    names, ids, sizes = [], [], []
    for batch in group.combine_chunks().to_batches():
        for part in slices(batch.select(["id", "text"]), "text"):
            tokens, offsets = with_end(*encode(part.column("text")), end)
            names += part.column("id").to_pylist()
            ids.append(tokens)
            sizes.append(np.diff(offsets))
    sizes = np.concatenate(sizes)
    flat = np.concatenate(ids).astype("<u4")
    begin = np.concatenate([[0], np.cumsum(sizes)])
    pieces = lay_out(sizes, capacity)
    raw = memoryview(flat.view(np.uint8))
    base = key[0].as_py() << 32
    return pa.table({
        "id": pa.array([names[p[0]] for p in pieces], pa.int64()),
        "start": pa.array([p[1] for p in pieces], pa.int64()),
        "length": pa.array([p[2] for p in pieces], pa.int64()),
        "ids": pa.array([bytes(raw[4 * int(begin[p[0]] + p[1]) : 4 * int(begin[p[0]] + p[1] + p[2])]) for p in pieces], pa.binary()),
        "doc_tokens": pa.array([int(sizes[p[0]]) for p in pieces], pa.int64()),
        "sequence_id": pa.array([base + p[3] for p in pieces], pa.int64()),
        "offset": pa.array([p[4] for p in pieces], pa.int64()),
    })


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end: int = 0, capacity: int = 1024, seed: int = 9) -> DataFrame:
    """One row per piece: id_col, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    A document's ids are those of its text (null: empty) and the id ``end``. Each id lies in exactly one
    piece. Sequences hold ``capacity`` ids, or a power of two. Groups are drawn by a seeded random number, so rows that
    repeat an id, or null ids, spread like others; they are documents of their own. Other columns are ignored.
    """
    path = path or tokenizer_path()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    count, size = rows.agg(F.count("*"), F.sum(F.octet_length("text").cast("long"))).first()
    groups = max(1, math.ceil(count / GROUP_DOCS), math.ceil((size or 0) / GROUP_BYTES))
    rows = rows.withColumn("group", F.floor(F.rand(seed) * groups).cast("long"))
    run = partial(_pack, path=path, end=end, capacity=capacity)
    return rows.groupBy("group").applyInArrow(lambda key, group: run(key, group), _PIECES).withColumnRenamed("id", id_col)
