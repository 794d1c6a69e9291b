"""Encoding of text columns with a public tokenizer, piece by piece, with a bounded cache in each Python worker."""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

from rareseries.llm import textkernel as K

#: Pieces that a worker's cache holds at most (some 40 bytes each); then it starts anew (results stay the same).
CACHE_WORDS = 600_000

# Classes of bytes: letters, digits, other printables, the apostrophe (which may open a contraction), space, newline; 0 is anything else.
LETTER, DIGIT, MARK, APOSTROPHE, SPACE, NEWLINE = range(1, 7)
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[0x21:0x7F] = MARK
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
_CLASS[0x30:0x3A] = DIGIT
_CLASS[[0x27, 0x20, 0x0A]] = APOSTROPHE, SPACE, NEWLINE


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str, special: bool = True) -> WordEncoder:
    """The encoder of this worker for a tokenizer file."""
    cache = K.worker_cache("encoders")
    if (path, special) not in cache:
        cache[path, special] = WordEncoder(path, special)
    return cache[path, special]


def byte_level() -> dict[str, int]:
    """The byte of each letter of a byte-level vocabulary: printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Pieces:
    """Known pieces, sorted by hash: their length in bytes, and where their ids lie in the pool."""

    def __init__(self, *columns: np.ndarray):
        self.columns = columns or (np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32))

    def __len__(self) -> int:
        return len(self.columns[0])

    def find(self, keys: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row of each key, and whether it is there."""
        if not len(self):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        row = np.minimum(np.searchsorted(self.columns[0], keys), len(self) - 1)
        return row, (self.columns[0][row] == keys) & (self.columns[1][row] == sizes)

    def plus(self, other: _Pieces) -> _Pieces:
        """Both; of equal hashes (a collision of pieces of other lengths) the other's stands."""
        columns = [np.concatenate(c) for c in zip(other.columns, self.columns, strict=True)]
        order = np.argsort(columns[0], kind="stable")
        columns = [c[order] for c in columns]
        new = np.ones(len(order), dtype=bool)
        new[1:] = columns[0][1:] != columns[0][:-1]
        return _Pieces(*(c[new] for c in columns))


class WordEncoder:
    """Encodes texts with a byte-level BPE tokenizer; equal to encoding each whole text, special tokens not added.

    The tokenizer's pattern parts letters, digits and other characters, and a word takes one space before it along. So texts
    are cut where printable ASCII characters or two-byte letters led by 0xC3 change class, and before a single space
    or around a single newline between such characters; after an apostrophe, which may open a contraction, and beside all other
    bytes nothing is cut. Distinct pieces are encoded once: those of one class are whole words to the tokenizer's model, others go through
    the tokenizer. Special tokens inside texts stay whole, or are plain text without ``special``. Pieces are told apart by a 64-bit hash and their length.
    """

    def __init__(self, path: str, special: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.normalizer or not str(self.tokenizer.pre_tokenizer).startswith("ByteLevel(add_prefix_space=False") or "use_regex=True" not in str(self.tokenizer.pre_tokenizer):
            raise ValueError(f"{path} does not part words as byte-level BPE does")
        self.tokenizer.encode_special_tokens = not special
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()] if special else []
        self.letters = {b: c for c, b in byte_level().items()}
        self.size = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self._clear()

    def _clear(self) -> None:
        self.known, self.recent = _Pieces(), _Pieces()
        self.pool, self.used = np.zeros(1 << 16, dtype=np.uint32), 0

    def classes(self, data: np.ndarray) -> np.ndarray:
        kind = _CLASS[data]
        two = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))  # not the signs of times and division
        kind[two] = kind[two + 1] = LETTER
        if self.special:
            raw = data.tobytes()
            for token in self.special:
                at = raw.find(token)
                while at >= 0:
                    kind[at : at + len(token)] = 0
                    at = raw.find(token, at + 1)
        return kind

    def pieces(self, kind: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of the pieces of all texts, in order."""
        word = (kind >= LETTER) & (kind <= APOSTROPHE)
        group = np.minimum(kind, MARK)
        brk = np.zeros(len(kind), dtype=bool)
        brk[1:] = word[1:] & word[:-1] & (group[1:] != group[:-1]) & (kind[:-1] != APOSTROPHE)
        alone = word[:-2] & word[2:]
        brk[1:-1] |= alone & ((kind[1:-1] == SPACE) | (kind[1:-1] == NEWLINE))
        brk[2:] |= alone & (kind[1:-1] == NEWLINE)
        brk[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        return np.flatnonzero(brk)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts of a column; a null text is empty."""
        data, offsets = K.text_buffers(column)
        if not len(data):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(offsets), dtype=np.int64)
        kind = self.classes(data)
        starts = self.pieces(kind, offsets)
        ends = np.append(starts[1:], len(data))
        keys, first, inverse = np.unique(K.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        sizes = (ends - starts)[first]
        if len(self.known) + len(self.recent) + len(keys) > CACHE_WORDS:
            self._clear()
        row, old = self.known.find(keys, sizes)
        row2, late = self.recent.find(keys, sizes)
        new = np.flatnonzero(~old & ~late)
        if len(new):
            learned = self._learn(data, kind, starts[first[new]], ends[first[new]], keys[new])
            self.recent = self.recent.plus(learned)
            if len(self.recent) > 1 << 16 and len(self.recent) > len(self.known) // 4:
                self.known, self.recent = self.known.plus(self.recent), _Pieces()
                row, old = self.known.find(keys, sizes)
            row2, late = self.recent.find(keys, sizes)
        at, count = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
        for pieces, rows, there in ((self.known, row, old & ~late), (self.recent, row2, late)):
            at[there], count[there] = pieces.columns[2][rows[there]], pieces.columns[3][rows[there]]
        at, count = at[inverse], count[inverse]
        begin = np.concatenate([[0], np.cumsum(count)])
        ids = self.pool[np.repeat(at - begin[:-1], count) + np.arange(begin[-1])]
        return ids, begin[np.searchsorted(starts, offsets)]

    def _learn(self, data: np.ndarray, kind: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> _Pieces:
        lead = starts + ((kind[starts] == SPACE) & (ends - starts > 1))
        changes = np.concatenate([[0], np.cumsum(kind[1:] != kind[:-1])])
        single = (kind[lead] >= LETTER) & (kind[lead] <= MARK) & (changes[ends - 1] == changes[lead])
        raw, tokenize = data.tobytes(), self.tokenizer.model.tokenize
        lists: list = [None] * len(starts)
        for i in np.flatnonzero(single).tolist():
            piece = raw[starts[i] : ends[i]].decode("latin-1").translate(self.letters)
            lists[i] = [t.id for t in tokenize(piece)]
        rest = np.flatnonzero(~single).tolist()
        for i in range(0, len(rest), 4096):
            run = rest[i : i + 4096]
            texts = [raw[starts[j] : ends[j]].decode("utf-8", "replace") for j in run]
            for j, e in zip(run, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                lists[j] = e.ids
        count = np.fromiter(map(len, lists), dtype=np.int32, count=len(lists))
        flat = np.fromiter(chain.from_iterable(lists), dtype=np.uint32, count=int(count.sum()))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), dtype=np.uint32)])
        self.pool[self.used : self.used + len(flat)] = flat
        at = (self.used + np.cumsum(count) - count).astype(np.int32)
        self.used += len(flat)
        return _Pieces(keys, (ends - starts).astype(np.int32), at, count)


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Append the id ``end`` to every text."""
    n = np.diff(offsets)
    at = offsets + np.arange(len(offsets))
    out = np.full(int(at[-1]), end, dtype=np.uint32)
    keep = np.ones(len(out), dtype=bool)
    keep[at[:-1] + n] = False
    out[keep] = ids
    return out, at
