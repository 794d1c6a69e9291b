"""Word spans, hashes and shingles against plain Python."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from rareseries.llm import textkernel as K
from rareseries.llm.common import local_components, slices

WORD = re.compile(rb"[^\x20\x09-\x0d]+")
TEXT = st.text(alphabet="ab Cé \n\t", max_size=30)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_spans_and_hashes(texts):
    data, offsets = K.text_buffers(pa.array(texts, pa.string()))
    starts, ends, owner = K.word_spans(data, offsets)
    got = [(int(t), bytes(data[a:b])) for a, b, t in zip(starts, ends, owner, strict=True)]
    want = [(i, w) for i, t in enumerate(texts) for w in WORD.findall((t or "").encode())]
    assert got == want
    names = {}
    for (_, w), h in zip(want, K.hash_spans(data, starts, ends).tolist(), strict=True):
        assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6), st.integers(1, 5))
def test_shingles(texts, k):
    data, offsets = K.text_buffers(pa.array(texts, pa.string()))
    s, e, t = K.word_spans(data, offsets)
    hashes, cuts = K.shingle_hashes(K.hash_spans(data, s, e), t, len(texts), k)
    seen = {}
    for i, text in enumerate(texts):
        words = WORD.findall(text.encode())
        want = [tuple(words[a : a + k]) for a in range(max(1, len(words) - k + 1))] if words else []
        got = hashes[cuts[i] : cuts[i + 1]].tolist()
        assert len(got) == len(want)
        for w, h in zip(want, got, strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_hash_across_windows(monkeypatch):
    text = "one two " * 50 + "x" * 300 + " two one"
    data, offsets = K.text_buffers(pa.array([text]))
    s, e, _ = K.word_spans(data, offsets)
    whole = K.hash_spans(data, s, e)
    monkeypatch.setattr(K, "WINDOW", 64)
    K.worker_cache("powers").clear()
    assert (K.hash_spans(data, s, e) == whole).all()
    assert whole[0] == whole[-1] and whole[1] == whole[-2]


def test_slices_bound_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (3, 4, 50, 1, 1)] + [None])], ["text"])
    assert [b.num_rows for b in slices(batch, "text", 8)] == [2, 1, 3]
    assert not list(slices(batch.slice(0, 0), "text"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 14), st.integers(0, 14)), max_size=25))
def test_local_components(edges):
    label = list(range(15))
    for _ in range(15):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    u, v = (np.array([e[i] for e in edges], dtype=np.int64) for i in (0, 1))
    assert local_components(u, v, 15).tolist() == label
