"""Vectorised word spans and word hashes over Arrow string batches (numpy, one buffer at a time).

A word is ``[^\\x20\\x09-\\x0D]+`` on UTF-8 bytes; lower-casing touches A-Z only. Nothing here knows Spark.
"""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as this Python worker (functions themselves arrive anew with every task)."""
    return vars(sys.modules.setdefault("_rareseries_worker", types.ModuleType("_rareseries_worker"))).setdefault(name, {})


#: Bytes that belong to words (all but space and 0x09-0x0D), and A-Z lower-cased.
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

#: Odd multiplier of the polynomial hash modulo 2^64 and its inverse.
_P = np.uint64(0x9E6C63D0876A9A37)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
#: Bytes hashed at a time; arrays of eight bytes per byte stay near 4 MB.
WINDOW = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xA3B195354A39B70D)
    return x ^ (x >> np.uint64(29))


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    powers = worker_cache("powers")
    have = powers.get(name)
    if have is None or len(have) < n:
        step = np.full(n, base, dtype=np.uint64)
        step[0] = 1
        have = powers[name] = np.cumprod(step, dtype=np.uint64)
    return have


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and ``n + 1`` offsets; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of every word (run of ``word_bytes``); words never cross texts."""
    word = word_bytes[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    edges = offsets[:-1][(offsets[:-1] < offsets[1:])]
    first[edges] = word[edges]
    last = word.copy()
    last[:-1] &= ~word[1:]
    last[edges[edges > 0] - 1] = word[edges[edges > 0] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span (spans in ascending order)."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + WINDOW, side="right")))
        n = int(ends[j - 1] - base)
        up, down = _power("up", _P, max(n, WINDOW) + 1), _power("down", _P_INV, max(n, WINDOW) + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data[base : base + n].astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        i = j
    return out


def shingle_hashes(words: np.ndarray, text: np.ndarray, n_texts: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, offsets): the hashes of all ``k``-word shingles, text after text.

    A text of fewer than ``k`` words has its whole word sequence as its only shingle; without words it has none.
    """
    count = np.bincount(text, minlength=n_texts)
    begin = np.concatenate([[0], np.cumsum(count)])
    rolled = words * np.uint64(0x9FB21C651E98DF25)
    size = np.maximum(count - k + 1, (count > 0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(size)])
    inside = np.repeat(begin[:-1] - offsets[:-1], size) + np.arange(offsets[-1])
    whole = np.repeat(count < k, size)
    acc = np.zeros(len(inside), dtype=np.uint64)
    limit = np.repeat(begin[1:], size)
    for j in range(k):
        at = inside + j
        there = at < limit
        add = np.zeros(len(inside), dtype=np.uint64)
        add[there] = rolled[at[there]]
        acc = mix(acc + add + there.astype(np.uint64) * np.uint64(j + 1))
    del whole
    return acc, offsets
