"""Operator 11: alignment of the tokens of two tokenizers, with the counts of linked id pairs over the corpus.

Both tokenizers cut the same bytes; tokens whose byte ranges overlap are linked. Per pair of linked ids an inverted list of
documents is kept as compressed bitmaps: documents come in chunks, and in each chunk a pair has one bitmap for each binary
digit of its multiplicity (a plane), as sorted 16-bit places where it is sparse and as bits where it is dense. The planes
OR-merged and popcounted give a pair's document count, the planes' popcounts times their powers of two its link count. Spark
adds these up by pair, finds the best partner of each id of the second tokenizer, and sends the scores back to the chunks,
where the postings return them to their documents.

Texts are cut at single spaces between characters that are no white space: neither tokenizer joins what such a space parts,
so a cut text's tokens are those of its words, which each worker aligns once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareseries.llm import textkernel as K
from rareseries.llm.common import slices, written
from rareseries.llm.tokens import byte_level, encoder, tokenizer_path

#: Postings (documents of pairs) and documents of a chunk at most, but for a chunk of one document; places have 16 bits.
CHUNK_POSTINGS, CHUNK_DOCS = 1 << 20, 1 << 16
#: Words a worker remembers, and the longest of them in characters; when it holds more it starts anew.
CACHE_WORDS, CACHE_LETTERS = 500_000, 200

_BREAK = re.compile(r"(?<=\S) (?=\S)")


class Words:
    """Aligned words of two tokenizers: tokens, groups and links of a space and the word."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor

        self.a, self.b = encoder(path_a, special=False), SentencePieceProcessor(model_file=path_b)
        letters = byte_level()
        vocabulary = {i: t for t, i in self.a.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [bytes(letters[c] for c in vocabulary[i]) if i in vocabulary and all(c in letters for c in vocabulary[i]) else b"" for i in range(max(vocabulary) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.bytes_a, self.bytes_b))
        self.digits = np.array([str(i) for i in range(max(len(self.size_a), len(self.size_b)))], dtype=object)
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.groups: list[str] = []
        self.sizes = np.zeros((1 << 12, 4), dtype=np.int64)  # tokens of A and B, groups, and links; no tokens: not the text's bytes
        self.at = np.zeros((1 << 12) + 1, dtype=np.int64)
        self.pool = np.zeros(1 << 14, dtype=np.int64)

    def encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and their numbers by word, of A and B; none of a word whose ids do not spell it."""
        spaced = [" " + w for w in words]
        a, offsets = self.a(pa.array(spaced, pa.string()))
        lists = self.b.encode(words, num_threads=1)
        n_a, n_b = np.diff(offsets), np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        b = np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(n_b.sum()))
        whole = [w.encode() for w in spaced]
        length = np.fromiter(map(len, whole), dtype=np.int64, count=len(whole))
        spelt = [b"".join([names[i] for i in ids.tolist()]) for names, ids in ((self.bytes_a, a), (self.bytes_b, b))]
        word_a, word_b = np.repeat(np.arange(len(words)), n_a), np.repeat(np.arange(len(words)), n_b)
        of_a, of_b = (np.bincount(w, weights=size[ids], minlength=len(words)) for w, size, ids in ((word_a, self.size_a, a), (word_b, self.size_b, b)))
        if spelt[0] == spelt[1] == b"".join(whole) and (of_a == length).all() and (of_b == length).all():
            return a.astype(np.int64), n_a, b, n_b
        edges = [np.concatenate([[0], np.cumsum(of)]).astype(np.int64) for of in (of_a, of_b)]
        good = np.array([spelt[0][edges[0][i] : edges[0][i + 1]] == x == spelt[1][edges[1][i] : edges[1][i + 1]] for i, x in enumerate(whole)])
        return a[good[word_a]].astype(np.int64), n_a * good, b[good[word_b]], n_b * good

    def learn(self, words: list[str]) -> None:
        """Align words that are not known yet."""
        a, n_a, b, n_b = self.encoded(words)
        # words end to end: both tokenizers' tokens end where a word does
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        low = np.searchsorted(end_b, end_a - self.size_a[a], side="right")
        count = np.searchsorted(end_b - self.size_b[b], end_a) - low
        links = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
        pairs = np.repeat(a, count) * len(self.size_b) + b[links]
        word_a = np.repeat(np.arange(len(words)), n_a)
        n_links = np.bincount(word_a, weights=count, minlength=len(words)).astype(np.int64)
        word_of = np.zeros(len(both), dtype=np.int64)
        word_of[group_a] = word_a
        # the ids of a group, A's before B's, each followed by what parts it from the next
        side = np.concatenate([group_a * 2, group_b * 2 + 1])
        order = np.argsort(side, kind="stable")
        side = side[order]
        marks = np.full(len(side), ",", dtype=object)
        turn = np.flatnonzero(side[1:] != side[:-1])
        marks[turn] = "|"
        ends = np.flatnonzero(side[1:] // 2 != side[:-1] // 2)
        marks[ends] = np.where(word_of[side[ends + 1] // 2] == word_of[side[ends] // 2], ";", "\n")
        marks[-1:] = ""
        parts = np.empty(2 * len(side), dtype=object)
        parts[::2], parts[1::2] = self.digits[np.concatenate([a, b])[order]], marks
        texts = iter("".join(parts).split("\n"))
        have = len(self.groups)
        self.groups += [next(texts) if n else "" for n in n_a.tolist()]
        n = have + len(words)
        while len(self.sizes) < n:
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
            self.at = np.concatenate([self.at, np.zeros(len(self.at) - 1, dtype=np.int64)])
        self.sizes[have:n] = np.stack([n_a, n_b, np.bincount(word_of, minlength=len(words)), n_links], axis=1)
        self.at[have + 1 : n + 1] = self.at[have] + np.cumsum(n_links)
        while len(self.pool) < self.at[n]:
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.at[have] : self.at[n]] = pairs
        self.place.update(zip(words, range(have, n), strict=True))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """Of each text its four sizes and the hash of its groups, and of all links their text's number and pair."""
        if len(self.groups) > CACHE_WORDS or self.at[len(self.groups)] > CACHE_WORDS * 16:
            self.clear()
        cut = [_BREAK.split(t) if t else [] for t in texts]
        known = self.place
        new = list({w: None for words in cut for w in words if w not in known})
        for i in range(0, len(new), 1 << 14):
            self.learn(new[i : i + (1 << 14)])
        place = [[known[w] for w in words] for words in cut]
        flat = np.fromiter(chain.from_iterable(place), dtype=np.int64)
        text = np.repeat(np.arange(len(texts)), [len(words) for words in place])
        odd = np.unique(text[self.sizes[flat, 0] == 0]).tolist()
        for i in odd:  # some word's tokens are not its bytes: the text as a whole decides
            if texts[i] not in known:
                self.learn([texts[i]])
                new.append(texts[i])
            place[i] = [known[texts[i]]]
        if odd:
            flat = np.fromiter(chain.from_iterable(place), dtype=np.int64)
            text = np.repeat(np.arange(len(texts)), [len(words) for words in place])
        groups = self.groups
        hashes = [hashlib.sha256(";".join([groups[p] for p in words]).encode()).hexdigest() if words and groups[words[0]] else "" for words in place]
        sizes = np.stack([np.bincount(text, weights=self.sizes[flat, k], minlength=len(texts)) for k in range(4)], axis=1).astype(np.int64)
        count = self.sizes[flat, 3]
        links = np.repeat(self.at[flat] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        pairs = self.pool[links]
        for w in new:
            if len(w) > CACHE_LETTERS:
                groups[known.pop(w)] = ""
        return sizes, np.repeat(text, count), pairs, hashes


def planes_of(pair: np.ndarray, doc: np.ndarray, times: np.ndarray, n_docs: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Distinct pairs (ascending), their planes, and by pair a mask of the planes that are kept as bits.

    ``pair`` and ``doc`` are sorted and distinct as a whole; plane k of a pair holds the documents whose multiplicity has the bit 2^k.
    """
    first = np.ones(len(pair), dtype=bool)
    first[1:] = pair[1:] != pair[:-1]
    which = np.cumsum(first) - 1
    deep = int(times.max(initial=0)).bit_length()
    keys = np.sort(np.concatenate([(which[s] << 6 | k) << 16 | doc[s] for k in range(deep) for s in [np.flatnonzero(times >> k & 1)]] or [np.zeros(0, np.int64)]))
    element, place = keys >> 16, keys & 0xFFFF
    edge = np.ones(len(keys), dtype=bool)
    edge[1:] = element[1:] != element[:-1]
    number, start = np.cumsum(edge) - 1, np.flatnonzero(edge)
    card = np.diff(np.append(start, len(keys)))
    words = -(-n_docs // 16)
    dense = card > words
    begin = np.concatenate([[0], np.cumsum(np.where(dense, words, card))])
    out = np.zeros(begin[-1], dtype=np.uint16)
    bits = dense[number]
    out[(begin[number] + np.arange(len(keys)) - start[number])[~bits]] = place[~bits]
    np.bitwise_or.at(out, (begin[number] + (place >> 4))[bits], np.left_shift(1, place[bits] & 15).astype(np.uint16))
    element = element[start]
    mask = np.zeros(int(first.sum()), dtype=np.int64)
    np.bitwise_or.at(mask, element >> 6, np.where(dense, np.left_shift(1, element & 63), 0))
    # planes that no document has are empty entries below a pair's highest one
    top = np.zeros(len(mask), dtype=np.int64)
    np.maximum.at(top, element >> 6, (element & 63) + 1)
    base = np.concatenate([[0], np.cumsum(top)])
    size = np.zeros(base[-1], dtype=np.int64)
    size[base[element >> 6] + (element & 63)] = np.diff(begin) * 2
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    items = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(out)])
    return pair[first], pa.ListArray.from_arrays(pa.array(base.astype(np.int32)), items), mask


def postings(planes: pa.Array, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, document, multiplicity) of all planes: a pair's planes are OR-merged, each adds its power of two."""
    per_row = planes.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    items = planes.flatten()
    row = np.repeat(np.arange(len(per_row)), per_row)
    plane = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    offsets = np.frombuffer(items.buffers()[1], dtype=np.int32)[items.offset : items.offset + len(items) + 1].astype(np.int64) // 2
    data = np.frombuffer(items.buffers()[2], dtype=np.uint16)[offsets[0] : offsets[-1]] if len(items) and offsets[-1] > offsets[0] else np.zeros(0, np.uint16)
    size = np.diff(offsets)
    of, within = np.repeat(np.arange(len(size)), size), np.arange(len(data)) - np.repeat(offsets[:-1] - offsets[0], size)
    bits = (mask[row] >> plane & 1).astype(bool)[of]
    word, bit = np.nonzero(data[bits][:, None] >> np.arange(16, dtype=np.uint16) & 1)
    element = np.concatenate([of[~bits], of[bits][word]])
    doc = np.concatenate([data[~bits].astype(np.int64), within[bits][word] * 16 + bit])
    keys, inverse = np.unique(row[element] << 16 | doc, return_inverse=True)
    times = np.zeros(len(keys), dtype=np.int64)
    np.add.at(times, inverse, np.left_shift(1, plane[element]))
    return keys >> 16, keys & 0xFFFF, times


_CHUNKS = "chunk long, place int, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair long, planes array<binary>, dense long"
_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.binary()), pa.int64()]
_NAMES = [c.split()[0] for c in _CHUNKS.split(", ")]


def words(path_a: str, path_b: str) -> Words:
    cache = K.worker_cache("aligned")
    if (path_a, path_b) not in cache:
        cache[path_a, path_b] = Words(path_a, path_b)
    return cache[path_a, path_b]


def _batch(n: int, **columns) -> pa.RecordBatch:
    def column(name, kind):
        x = columns.get(name)
        return pa.nulls(n, kind) if x is None else x.cast(kind) if isinstance(x, pa.Array) else pa.array(x, kind)

    return pa.RecordBatch.from_arrays([column(name, kind) for name, kind in zip(_NAMES, _KINDS, strict=True)], _NAMES)


def _align(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    """Rows of two kinds: documents with their sizes, and pairs (``pair`` is not null) with their planes, by chunk."""
    aligned, part = words(path_a, path_b), TaskContext.get().partitionId()
    chunk, docs, held, count = part << 32, 0, [], 0

    def closed():
        pair_doc, times = (np.concatenate([x[i] for x in held]) for i in range(2))
        order = np.argsort(pair_doc, kind="stable")
        pair, planes, mask = planes_of(pair_doc[order] >> 16, pair_doc[order] & 0xFFFF, times[order], docs)
        for i in range(0, len(pair), 100_000):
            n = len(pair[i : i + 100_000])
            yield _batch(n, chunk=np.full(n, chunk), pair=pair[i : i + n], planes=planes.slice(i, n), dense=mask[i : i + n])

    for batch in batches:
        for run in slices(batch, "text"):
            for i in range(0, run.num_rows, CHUNK_DOCS):
                some = run.slice(i, CHUNK_DOCS)
                sizes, text, pair, hashes = aligned(some.column("text").to_pylist())
                keys, times = np.unique(pair << 16 | text, return_counts=True)
                if count and (count + len(keys) > CHUNK_POSTINGS or docs + some.num_rows > CHUNK_DOCS):
                    yield from closed()
                    chunk, docs, held, count = chunk + 1, 0, [], 0
                elif docs + some.num_rows > CHUNK_DOCS:
                    chunk, docs = chunk + 1, 0
                held.append((keys + docs, times))
                count += len(keys)
                n_a, n_b, n_groups, n_links = sizes.T
                yield _batch(some.num_rows, chunk=np.full(some.num_rows, chunk), place=np.arange(docs, docs + some.num_rows, dtype=np.int32), id=some.column("id"), n_a=n_a, n_b=n_b, n_groups=n_groups, n_links=n_links, groups_sha256=hashes)
                docs += some.num_rows
    if count:
        yield from closed()


def aligned_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """The written table of documents and bitmaps by chunk (its rows of a chunk come from one attempt of one task)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    run = partial(_align, path_a=path_a or tokenizer_path("byte_bpe_50k.json"), path_b=path_b or tokenizer_path("piece_bpe_32k.model"))
    return written(rows.mapInArrow(run, _CHUNKS))


def _popcount(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, _, times = postings(batch.column("planes"), batch.column("dense").to_numpy())
        docs = np.bincount(row, minlength=batch.num_rows)
        links = np.zeros(batch.num_rows, dtype=np.int64)
        np.add.at(links, row, times)
        yield pa.RecordBatch.from_arrays([batch.column("pair"), batch.column("chunk"), pa.array(docs), pa.array(links)], ["pair", "chunk", "docs", "links"])


def chunk_counts(chunks: DataFrame) -> DataFrame:
    """pair, chunk, docs, links: popcounts of each chunk's bitmaps."""
    return chunks.where("pair is not null").select("pair", "chunk", "planes", "dense").mapInArrow(_popcount, "pair long, chunk long, docs long, links long")


def pair_counts(counts: DataFrame, size_b: int) -> DataFrame:
    """pair, a, b, docs, links over all chunks, and whether no pair of the same b has more links (``best``)."""
    pairs = counts.groupBy("pair").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))
    pairs = pairs.select("pair", F.expr(f"pair div {size_b}").alias("a"), (F.col("pair") % size_b).alias("b"), "docs", "links")
    most = pairs.groupBy("b").agg(F.max("links").alias("most"))
    return pairs.join(most, "b").select("pair", "a", "b", "docs", "links", (F.col("links") == F.col("most")).alias("best"))


_DOCS = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _score(chunk, scores):
    """The documents of a chunk with the scores that their postings return."""
    chunk = chunk.combine_chunks()
    is_pair = chunk.column("pair").is_valid().combine_chunks()
    docs, found = chunk.filter(pc.invert(is_pair)).combine_chunks(), chunk.filter(is_pair).combine_chunks()
    n_best, total = np.zeros(CHUNK_DOCS, dtype=np.int64), np.zeros(CHUNK_DOCS, dtype=np.int64)
    if found.num_rows:
        of, links, best = (scores.column(c).to_numpy() for c in ("pair", "links", "best"))
        order = np.argsort(of)
        at = order[np.searchsorted(of, found.column("pair").to_numpy(), sorter=order)]
        row, doc, times = postings(found.column("planes").chunk(0), found.column("dense").to_numpy())
        np.add.at(total, doc, times * links[at][row])
        np.add.at(n_best, doc, times * best[at][row])
    place = docs.column("place").to_numpy()
    return pa.table({**{c: docs.column(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links")}, "n_best": n_best[place], "count_sum": total[place], "groups_sha256": docs.column("groups_sha256")}, schema=pa.schema([("id", pa.int64()), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], ("groups_sha256", pa.string())]))


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs) of a table of texts.

    Documents: id_col, n_a and n_b (tokens), n_groups (runs between places where both tokenizers' tokens end), n_links (pairs of
    tokens that overlap), n_best (links whose pair has the most links of all pairs of its b), count_sum (the pairs' link
    counts, over the links), groups_sha256. Pairs: pair, a, b, docs, links, best. Texts that are null, empty, or not what
    their tokens' bytes spell have no tokens: zeros and an empty string. Rows that repeat an id, or have none, are documents
    of their own. An empty table gives two empty ones. Other columns are not read.
    """
    path_b = path_b or tokenizer_path("piece_bpe_32k.model")
    chunks = aligned_chunks(docs, id_col, text_col, path_a, path_b)
    counts = written(chunk_counts(chunks))
    pairs = written(pair_counts(counts, _vocabulary(path_b)))
    scores = counts.select("pair", "chunk").join(pairs.select("pair", "links", "best"), "pair").select("chunk", "pair", "links", "best")
    found = chunks.groupBy("chunk").cogroup(scores.groupBy("chunk")).applyInArrow(lambda chunk, scores: _score(chunk, scores), _DOCS)
    return found.withColumnRenamed("id", id_col), pairs


def _vocabulary(path_b: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path_b).vocab_size()
