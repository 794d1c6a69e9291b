"""Operator 11 against whole-text encoding and nested loops."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rareseries.llm import alignment
from rareseries.llm.tokens import tokenizer_path


@pytest.fixture(scope="module")
def both():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


def by_hand(text, both):
    """(ids of A, ids of B, groups, links) of a whole text; empty without a text or where bytes differ."""
    a, b = both
    if not text:
        return [], [], [], []
    letters = alignment.byte_level()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not b"".join(bytes_a) == (" " + text).encode() == b"".join(bytes_b):
        return [], [], [], []
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
    groups, links, i, j = [], [], 0, 0
    for stop in sorted(set(ends_a) & set(ends_b)):
        i0, j0 = i, j
        while i < len(ends_a) and ends_a[i] <= stop:
            i += 1
        while j < len(ends_b) and ends_b[j] <= stop:
            j += 1
        groups.append((ids_a[i0:i], ids_b[j0:j]))
        for x in range(i0, i):
            for y in range(j0, j):
                if ends_a[x] - len(bytes_a[x]) < ends_b[y] and ends_b[y] - len(bytes_b[y]) < ends_a[x]:
                    links.append((ids_a[x], ids_b[y]))
    return ids_a, ids_b, groups, links


ODD = [
    "a ▁b", "x  y   z", "tab\tand\nnew line", " lead", "trail ", " ", "\n", "<s> </s> <unk> <0x41> <|endoftext|>", "日本語 の テスト", "emoji 👍🏽 ok", "don't can't I'll", "nbsp here  wide", "\x1c \x1f a",
    "ﬁ ligature é", "123 4567 89", "a" * 300, "▁", "Ġ ċ", "word\u0085next line", "ｆｕｌｌ　ｗｉｄｔｈ", "\x00 nul", "é é", "..., !!! ???", "don ' t",
]


def want_of(rows, both):
    found = [by_hand(t, both) for _, t in rows]
    counts = Counter(x for f in found for x in f[3])
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for (i, _), (ids_a, ids_b, groups, links) in zip(rows, found, strict=True):
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((i, len(ids_a), len(ids_b), len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if ids_a else ""))
    docs = Counter(x for f in found for x in set(f[3]))
    return out, {(x, y): (docs[x, y], n, n == most[y]) for (x, y), n in counts.items()}


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("postings", [1 << 20, 700])
def test_align(spark, small_docs, both, monkeypatch, postings):
    monkeypatch.setattr(alignment, "CHUNK_POSTINGS", postings)
    rows = [(r[0], r[1]) for r in small_docs if r[1] is None or len(r[1]) < 20_000] + [(20_000 + i, t) for i, t in enumerate(ODD)]
    rows += [(None, "no id here"), (None, None), (rows[0][0], "a repeated id"), rows[1]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("id", "pair", "chunk", "place", "links", "best", "planes")})
    found, pairs = alignment.align(docs.repartition(3))
    want, want_pairs = want_of(rows, both)
    key = lambda r: (r[0] is None, r[0] or 0, r[-1])
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)
    assert {(r["a"], r["b"]): (r["docs"], r["links"], r["best"]) for r in pairs.collect()} == want_pairs


def test_align_empty(spark, empty_docs):
    found, pairs = alignment.align(empty_docs)
    assert found.count() == 0 and pairs.count() == 0 and found.columns == COLUMNS


def test_words_equal_whole_texts(both):
    """Texts cut at single spaces have the tokens of the whole text, whatever stands around the spaces."""
    rng = np.random.default_rng(11)
    letters = list("abzAZ09éßñ日👍.,!?'\"-_ \t\n  \x85\x1c<>▁") + [" "] * 25
    aligned = alignment.words(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    texts = ["".join(rng.choice(letters, rng.integers(1, 60))) for _ in range(3000)]
    sizes, _, _, hashes = aligned(texts)
    for t, s, h in zip(texts, sizes.tolist(), hashes, strict=True):
        ids_a, ids_b, groups, links = by_hand(t, both)
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        assert (s, h) == ([len(ids_a), len(ids_b), len(groups), len(links)], hashlib.sha256(text.encode()).hexdigest() if ids_a else ""), t


def test_planes_round_trip():
    rng = np.random.default_rng(5)
    for n_docs in (1, 40, 3000, 1 << 16):
        keys = np.unique(rng.integers(0, 50, 4000) << 16 | rng.integers(0, n_docs, 4000))
        keys = np.unique(np.concatenate([keys, (60 << 16) + np.arange(n_docs)]))  # a pair that every document has
        times = np.minimum(rng.geometric(0.4, len(keys)) * rng.choice([1, 1, 1, 900], len(keys)), 1 << 20)
        pair, planes, mask = alignment.planes_of(keys >> 16, keys & 0xFFFF, times, n_docs)
        for part in (slice(None), slice(3, 20)):
            p = planes if part == slice(None) else planes.slice(3, 17)
            row, doc, found = alignment.postings(p, mask[part])
            inside = np.isin(keys >> 16, pair[part])
            assert (pair[part][row] << 16 | doc).tolist() == keys[inside].tolist() and found.tolist() == times[inside].tolist()
    assert mask.any() and isinstance(planes, pa.ListArray)
