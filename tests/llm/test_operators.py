"""Each dealt operator against brute force, on the smallest table plus nulls, empties, ties, repeats and long texts."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rareseries.llm import packing, quality, suffix_dedup, token_files, toxicity, vector_dedup
from rareseries.llm import textkernel as K
from rareseries.llm.common import components, cut
from rareseries.llm.exact_dedup import drop_copies, exact_groups
from rareseries.llm.jaccard_join import jaccard_groups, keep_one_per_group
from rareseries.llm.mixing import mix, mixed_documents, targets
from rareseries.llm.tokens import WordEncoder, tokenizer_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0d]+")


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def roots(ids, links):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))] + [(i, i + 1) for i in range(500, 560)] + [(600, j) for j in range(700, 900)]
    got = {r["id"]: r["component_id"] for r in components(spark.createDataFrame(edges, "u long, v long").repartition(7)).collect()}
    want = roots({x for e in edges for x in e}, edges)
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {i: want[i] for i in touched}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- 1 ---------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_groups(docs, small_docs, keep):
    groups = defaultdict(list)
    for i, t, *_ in small_docs:
        groups[(t or "").translate(LOWER)].append(i)
    got = by_id(exact_groups(docs, keep=keep))
    assert len(got) == len(small_docs)
    for text, ids in groups.items():
        best = min(ids) if keep == "smallest" else max(ids)
        for i in ids:
            assert got[i][1:] == (best, len(ids), i == best, hashlib.sha256(text.encode()).hexdigest())


def test_drop_copies(docs, small_docs, clashing, empty_docs):
    kept = {r["doc_id"] for r in drop_copies(docs).collect()}
    assert kept == {r["doc_id"] for r in exact_groups(docs).where("kept").collect()}
    out = drop_copies(clashing)
    assert out.columns == clashing.columns and out.count() > 0
    assert exact_groups(empty_docs).count() == 0 and drop_copies(empty_docs).count() == 0


def test_native_plans(docs):
    plan = exact_groups(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- 2 ---------------------------------------------------------------------------------------------------------------


def shingles(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[a : a + k]) for a in range(max(1, len(words) - k + 1))} if words else set()


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80), (2, 50)])
def test_jaccard_groups(docs, small_docs, k, percent):
    sets = {r[0]: shingles(r[1], k) for r in small_docs}
    index, links = defaultdict(list), []
    for i, s in sets.items():
        for x in s:
            index[x].append(i)
    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in index[x] if j > i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                links.append((i, j))
    want = roots(sets, links)
    got = by_id(jaccard_groups(docs, k=k, percent=percent))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == {i: (len(s), want[i]) for i, s in sets.items()}


def test_jaccard_large_cells(spark, monkeypatch):
    """Cells larger than a chunk are compared chunk by chunk, with the same links."""
    from rareseries.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "CHUNK", 4)
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(40):
        w = list(words)
        for at in rng.integers(0, 60, int(rng.integers(0, 4))):
            w[at] = f"x{rng.integers(0, 9)}"
        rows.append((i, " ".join(w)))
    sets = {i: shingles(t, 3) for i, t in rows}
    links = [(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    got = by_id(jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), k=3, percent=85))
    assert {i: r["component_id"] for i, r in got.items()} == roots(sets, links)


def test_jaccard_equal_sets_dealt_anew(spark, monkeypatch):
    """The pass that leaves a row out names the row it stands for, however another pass dealt the rows."""
    from rareseries.llm import jaccard_join

    split = jaccard_join._first_pass
    monkeypatch.setattr(jaccard_join, "_first_pass", lambda batches, k: (out for b in batches for i in range(b.num_rows) for out in split(iter([b.slice(i, 1)]), k)))
    docs = spark.createDataFrame([(i, "one and the same text of some words") for i in range(6)], "doc_id long, text string").repartition(2)
    got = by_id(jaccard_groups(docs, k=3, percent=85))
    assert [got[i]["component_id"] for i in range(6)] == [0] * 6


def test_jaccard_edges(clashing, empty_docs):
    assert jaccard_groups(empty_docs).count() == 0
    rows = jaccard_groups(clashing).collect()
    assert len(rows) == clashing.count() and sum(r["doc_id"] is None and r["component_id"] is None for r in rows) == 2
    assert keep_one_per_group(clashing).columns == clashing.columns


# --- 3 ---------------------------------------------------------------------------------------------------------------


def brute_repeats(rows, length):
    seen, out = set(), {}
    for i, t in sorted((r[0], (r[1] or "").encode()) for r in rows):
        grams = [t[a : a + length] for a in range(len(t) - length + 1)]
        mask = bytearray(len(t))
        for a, g in enumerate(grams):
            if g in seen:
                mask[a : a + length] = b"\1" * length
        seen.update(grams)
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(mask))]
        out[i] = (len(t), sum(mask), spans, bytes(c for c, m in zip(t, mask, strict=True) if not m))
    return out


@pytest.mark.parametrize(("length", "chunk"), [(50, 1 << 22), (50, 20_000), (17, 50_000)])
def test_remove_repeats(docs, small_docs, monkeypatch, length, chunk):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(suffix_dedup, "BUCKET_ENTRIES", 5_000)
    got = by_id(suffix_dedup.remove_repeats(docs, length=length))
    want = brute_repeats(small_docs, length)
    assert {i: (r["n_bytes"], r["n_removed"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for i, r in got.items()} == want


def test_remove_repeats_edges(clashing, empty_docs):
    assert suffix_dedup.remove_repeats(empty_docs).count() == 0
    assert suffix_dedup.remove_repeats(clashing).count() == clashing.count()


# --- 4 ---------------------------------------------------------------------------------------------------------------


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        w = sum(weight[s] for s in names if s not in full)
        target = {s: 3 * sizes[s] if s in full else rest * weight[s] / w for s in names}
        over = {s for s in names if s not in full and target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def test_targets(spark):
    sizes = {"b": 10, "a": 1000, "C": 5, "d": 0, None: 40, "é": 3, "z": 900}
    rows = targets(spark.createDataFrame([(s, 1, n) for s, n in sizes.items()], "source string, n long, source_size long")).collect()
    want = brute_targets(sizes)
    for r in rows:
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9, abs_tol=1e-9)


def test_mix(docs, small_docs, empty_docs, clashing):
    got = by_id(mix(docs))
    size = {r[0]: len(WORD.findall(r[1] or "")) for r in small_docs}
    assert {i: r["size"] for i, r in got.items()} == size
    by_source = defaultdict(int)
    for r in small_docs:
        by_source[r[3]] += size[r[0]]
    want, taken = brute_targets(by_source), defaultdict(int)
    for i, r in got.items():
        assert r["source_size"] == by_source[r["source"]] and math.isclose(r["target"], want[r["source"]], rel_tol=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"] and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(0.05 * t, 4), (s, taken[s], t)
    assert by_id(mix(docs.repartition(3))) == got  # reruns agree
    assert mix(empty_docs).count() == 0
    copies = Counter(r["doc_id"] for r in mixed_documents(docs).collect())
    assert copies == Counter({i: r["copies"] for i, r in got.items() if r["copies"]})
    assert mixed_documents(clashing).columns == clashing.columns


def test_mixed_documents_without_ids(spark):
    """Rows with a null or a repeated id are counted one by one, and reruns agree."""
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, f"text {i} " + "word " * (i % 40 + 1), f"src{i % 4}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    words, taken = Counter(), Counter()
    for _, t, s in rows:
        words[s] += len(t.split())
    got = mixed_documents(docs.repartition(5)).collect()
    for _, t, s in got:
        taken[s] += len(t.split())
    for s, t in brute_targets(words).items():
        assert abs(taken[s] - t) <= 0.1 * t, (s, taken[s], t)
    copies = Counter(r["text"] for r in got if r["doc_id"] is None)
    assert len(set(copies.values())) > 1
    assert Counter(got) == Counter(mixed_documents(docs.repartition(3)).collect())


# --- 5 and 9 ---------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_word_encoder_is_the_tokenizer(tokenizer, small_docs, monkeypatch):
    from rareseries.llm import tokens

    odd = ["a  b", " a", "a ", "\n\n", "a\nb \nc", "x y z", "don't we'll x", "é è\tç", "日本 語 z", "<|endoftext|> a<|endoftext|>", "a\u0085 b", "ÿ ÿ\nÿ", "1 2 3\n4", "", None, " \n ", "a 　b", "Ã x"]
    texts = odd + [r[1] for r in small_docs if r[0] != 9010]
    encode = WordEncoder(tokenizer_path())
    for limit in (3_000_000, 50):
        monkeypatch.setattr(tokens, "CACHE_WORDS", limit)
        for part in (texts, texts[::-1]):
            ids, offsets = encode(pa.array(part, pa.string()))
            for t, a, b in zip(part, offsets[:-1], offsets[1:], strict=True):
                assert ids[a:b].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids, t


def test_pieces_where_classes_change(tokenizer):
    """Random strings of the characters at which texts are cut, and of those that forbid it, among others special tokens."""
    rng = np.random.default_rng(6)
    letters = [*"abZsdt09'.,_é×÷ñß日\u0301\u00aa\u0085\t", "'s", "'ll", "<|endoftext|>", "\u00a0", "²", "Ⅷ", "\r\n", "\x00", "\x1c", *" \n" * 6]
    texts = ["".join(rng.choice(letters, rng.integers(0, 30))) for _ in range(6000)]
    ids, offsets = WordEncoder(tokenizer_path())(pa.array(texts, pa.string()))
    for t, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True):
        assert ids[a:b].tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t
    with pytest.raises(ValueError, match="byte-level"):
        WordEncoder(tokenizer_path("word_bpe_49k.json"))


def test_frames():
    payload = token_files.serialize(7, np.array([1, 2, 50_000]), 2)
    record = token_files.frame(payload)
    got, stop = token_files.unframe(record)
    assert stop == len(record) and token_files.deserialize(got)[0] == 7 and token_files.deserialize(got)[1].tolist() == [1, 2, 50_000]
    assert token_files.deserialize(token_files.serialize(None, np.array([]), 4))[0] is None
    for at in range(len(record)):
        with pytest.raises(ValueError):
            token_files.unframe(record[:at] + bytes([record[at] ^ 1]) + record[at + 1 :])
    with pytest.raises(ValueError):
        token_files.unframe(record[:-1])


def test_token_files(spark, docs, small_docs, tokenizer, tmp_path, empty_docs, clashing, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 100_000)
    root = f"file://{tmp_path}/a"
    manifest = token_files.write_records(docs, root)
    assert manifest.count() > 1
    got, at = by_id(token_files.read_records(manifest, root)), 0
    for r in sorted(small_docs):
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]
        assert got[r[0]]["start"] == at and np.frombuffer(got[r[0]]["ids"], dtype="<u4").tolist() == ids
        at += len(ids)
    assert len(got) == len(small_docs)
    assert token_files.read_records(token_files.write_records(empty_docs, f"file://{tmp_path}/b"), f"file://{tmp_path}/b").count() == 0
    names = [r["doc_id"] for r in token_files.read_records(token_files.write_records(clashing, f"file://{tmp_path}/c"), f"file://{tmp_path}/c").orderBy("start").collect()]
    assert names[:2] == [None, None] and len(names) == clashing.count()


def check_pieces(rows, want, capacity):
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r["ids"], dtype="<u4").tolist()
        assert len(ids) == r["length"] and r["doc_tokens"] == len(want[r["doc_id"]])
        docs[r["doc_id"]].append((r["start"], ids))
        sequences[r["sequence_id"]].append((r["offset"], len(ids)))
    assert {i: [x for _, ids in sorted(p) for x in ids] for i, p in docs.items()} == want
    for p in sequences.values():
        at = 0
        for offset, n in sorted(p):
            assert offset == at and n > 0
            at += n
        assert at == capacity or at < capacity and at & (at - 1) == 0


def test_pack(docs, small_docs, tokenizer, empty_docs, clashing, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_DOCS", 60)
    want = {r[0]: [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0] for r in small_docs}
    rows = packing.pack(docs).collect()
    check_pieces(rows, want, 1024)
    assert len({r["sequence_id"] >> 32 for r in rows}) > 1
    assert packing.pack(empty_docs).count() == 0
    assert packing.pack(clashing).where("doc_id is null").count() >= 2


def test_first_fit_decreasing():
    rng = np.random.default_rng(1)
    for _ in range(30):
        sizes = rng.integers(1, 100, int(rng.integers(1, 60))).tolist()
        free, want = [], {}
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            b = next((b for b, f in enumerate(free) if f >= sizes[i]), None)
            if b is None:
                b = len(free)
                free.append(100)
            free[b] -= sizes[i]
            want[i] = b
        assert packing.first_fit_decreasing(sizes, 100) == [want[i] for i in range(len(sizes))]


# --- 7 ---------------------------------------------------------------------------------------------------------------


def test_decode_restores_words(spark, docs):
    model = toxicity.language_model(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text"))
    for word, noisy in {"stupid": ["stup1d", "$tupid", "s.t.u.p.i.d", "stuuuupid", "s t u p i d"], "trash": ["tr4sh", "tr@sh", "trrrash", "t-r-a-s-h"], "worthless": ["w0rthless"], "pathetic": ["p4thetic"], "idiot": ["idi0t", "1diot"]}.items():
        for x in noisy:
            assert toxicity.decode(x, model) == word, x


def test_disguised_words_are_found():
    data, offsets = K.text_buffers(pa.array(["plain words, here. tr4sh $tupid cl0wn stuuupid s.t.u.p.i.d e.g. 2024 mail@x end"]))
    s, e, _ = K.word_spans(data, offsets)
    words = [bytes(data[a:b]).decode() for a, b in zip(s, e, strict=True)]
    got = {w for w, f in zip(words, toxicity._disguised(data, s, e), strict=True) if f}
    assert {"tr4sh", "$tupid", "cl0wn", "stuuupid", "s.t.u.p.i.d"} <= got and not got & {"plain", "words,", "here.", "2024", "end"}


def restored(text, model, spoken=("", {})):
    data, offsets = K.text_buffers(pa.array([text]))
    data = K.LOWER[data]
    return b" ".join(toxicity._restored(data, *K.word_spans(data, offsets), model, spoken)[0]).decode().split()


@pytest.fixture(scope="module")
def language(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    return toxicity.language_model(rows), toxicity.words_of(rows)


def test_toxicity_spaced_words(language):
    """Word boundaries come out of runs of single characters, however long the runs are."""
    model, spoken = language
    assert toxicity.decode("a m o r o n", model) == "a moron" and toxicity.decode("y o u m o r o n", model) == "you moron"
    for text in ("such a m o r o n, always", "I s t u p i d", "y o u a r e a s t u p i d m o r o n", "x y " * 2000 + "a m 0 r o n"):
        assert {"stupid", "moron"} & set(restored(text, model, spoken)), text
    assert "moron" in restored("such a m o r o n", model)


def test_toxicity_disguises(language):
    """Long words, one parting character, a doubled letter, and symbols at the end."""
    model, spoken = language
    for word, noisy in {"idiot": ["i" * 60 + "diot", "id-iot", "iidiot", "idio7", "(1diot!", "id..iot"], "moron": ["mor.on", "m_o_r_o_n" + "_" * 60 + "x"], "ass": ["a$$", "as5,"], "stupid": ["_".join("stupid" * 20)]}.items():
        for x in noisy:
            assert word in restored(f"such {x} here", model, spoken), x
    for x in ("worthless", "stupid"):
        assert restored(x, model, spoken) in ([], [x]), x


def test_toxicity_models_do_not_share_words(language):
    """A worker that has restored words under one model restores them anew under another."""
    model, spoken = language
    assert restored("1diot", model) == ["idiot"]
    other = np.full_like(model, -1.0)
    other[:, :, 9] = -9.0  # no i
    assert restored("1diot", other)[0].startswith("l") and restored("1diot", model) == ["idiot"]


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    noisy = spark.createDataFrame([(10**7, "the of and you are a tr4sh and a w0rthless l0ser"), (10**7 + 1, None), (10**7 + 2, "")], "doc_id long, text string")
    got = by_id(toxicity.score_toxicity(docs.select("doc_id", "text").union(noisy), labels))
    true = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [(true[i], r["predicted"]) for i, r in got.items() if r["held_out"] and i in true]
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    hits = sum(t and p for t, p in held)
    assert hits >= 0.9 * sum(t for t, _ in held) and hits >= 0.95 * sum(p for _, p in held)
    assert got[10**7]["predicted"] == 1 and got[10**7 + 1]["score"] == got[10**7 + 2]["score"] < 0.5


def test_toxicity_trains_on_every_labelled_row(spark):
    """The word that marks toxic rows stands only in those that come last by the hash of their ids, after 30,000 others."""
    train = spark.range(46_000).where(~toxicity.held_out(F.col("id")))
    last = train.count() - 30_000
    assert 400 < last < 1000
    names = {r["id"] for r in train.orderBy(F.xxhash64("id").desc()).limit(last).collect()}
    docs = spark.createDataFrame([(i, "a zorkish day" if i in names else "a plain day") for i in range(46_000)] + [(10**7, "what a zorkish thing"), (10**7 + 1, "what a plain thing")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in names)) for i in range(46_000)], "doc_id long, toxic int")
    got = by_id(toxicity.score_toxicity(docs, labels).where("doc_id >= 10000000"))
    assert got[10**7]["predicted"] == 1 and got[10**7 + 1]["predicted"] == 0


def test_toxicity_fit_moves_little(spark, monkeypatch):
    """The solver's short jobs run over few tasks and the features that are pulled up, whatever the partitions and features of the rows."""
    rng, rows = np.random.default_rng(7), []
    for i in range(3000):
        marks = [i // 10 % 3] if i % 10 == 0 else []
        rows.append((int(i % 10 == 0), marks + np.unique(rng.integers(3, 900, 5)).tolist(), 1))
    design, sizes, plain = cut(spark.createDataFrame(rows, "y int, places array<int>, n long").repartition(40)), [], toxicity.LogisticRegression.fit

    def spied(self, df):
        sizes.append(df.rdd.getNumPartitions() * df.first()["features"].size)
        return plain(self, df)

    monkeypatch.setattr(toxicity.LogisticRegression, "fit", spied)
    weights, bias = toxicity.fit(design, 900)
    assert sizes and max(sizes) <= 128
    assert (weights >= 0).all() and (weights[:3] > 5).all() and bias < -2
    monkeypatch.setattr(toxicity, "TAKEN_IN", 2)  # the working set grows round by round
    again, _ = toxicity.fit(design, 900)
    assert np.allclose(again[:3], weights[:3], rtol=0.05)


def test_toxicity_labels_join_alike_at_every_size(spark, monkeypatch):
    plans, plain = [], toxicity.written
    monkeypatch.setattr(toxicity, "written", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or plain(df))
    docs = spark.createDataFrame([(i, f"some words of row {i}") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0) for i in range(20)], "doc_id long, toxic int")
    assert toxicity.score_toxicity(docs, labels).count() == 20
    assert "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]


def test_toxicity_edges(spark, clashing, empty_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.score_toxicity(empty_docs, labels).count() == 0
    assert toxicity.score_toxicity(clashing, labels.limit(0)).count() == clashing.count()


# --- 8 ---------------------------------------------------------------------------------------------------------------


def test_ordinal_gradient_and_order():
    """Grades from a known linear score: thresholds come out in order, expected grades follow the score."""
    rng = np.random.default_rng(2)
    n, d = 3000, 20
    w = rng.normal(size=d)
    x = rng.normal(size=(n, d))
    z = x @ w + rng.logistic(size=n)
    grade = np.digitize(z, [-2.0, 0.5, 3.0])
    row, col = np.repeat(np.arange(n), d), np.tile(np.arange(d), n)
    got, theta = quality.fit_ordinal(row, col, x.ravel(), grade, 4, rounds=400)
    assert (np.diff(theta) > 0).all() and np.abs(theta - [-2.0, 0.5, 3.0]).max() < 0.5
    assert np.corrcoef(got[:d], w)[0, 1] > 0.99


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = by_id(quality.rate(docs, labels.where("doc_id % 2 = 0")))
    pairs = [(r["quality"], got[r["doc_id"]]["tail_probability"] >= 0.5) for r in labels.where("doc_id % 2 = 1").collect()]
    good, bad = [k for q, k in pairs if q], [k for q, k in pairs if not q]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)
    assert all(math.isclose(r["expected_grade"], r["tail_probability"], rel_tol=1e-9) for r in got.values())  # grades 0 and 1


def test_quality_edges(spark, clashing, empty_docs):
    ratings = spark.createDataFrame([(1, 0), (2, 1), (3, 4), (4, None), (None, 1)], "doc_id long, quality int")
    assert quality.keep_good(empty_docs, ratings).count() == 0
    rated = quality.rate(clashing, ratings)
    assert rated.columns == [*clashing.columns, "expected_grade", "tail_probability"] and rated.count() == clashing.count()
    for r in rated.collect():
        assert 0 <= r["expected_grade"] <= 4 and 0 <= r["tail_probability"] <= 1
    one = quality.rate(clashing, ratings.where("quality = 1")).first()
    assert one["expected_grade"] == 1 and one["tail_probability"] == 1


# --- 10 --------------------------------------------------------------------------------------------------------------


def vectors(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(150, 8))
    x = np.concatenate([x, x[:60] + 0.05 * rng.normal(size=(60, 8)), x[:30] * 3, np.tile(x[5], (20, 1)) + 1e-4 * rng.normal(size=(20, 8)), -x[:5]])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [None, [], [0.0] * 8, [1.0, None, *[0.0] * 6], [math.nan] * 8, [math.inf] + [0.0] * 7, [1e308] * 8, [1e-308] * 8, [1.0, 2.0], [1.0, 2.0]]
    return x, rows + [(1000 + i, v) for i, v in enumerate(odd)] + [(None, [1.0] * 8)]


@pytest.mark.parametrize("block", [2048, 25])
def test_vector_groups(spark, monkeypatch, block):
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    _, rows = vectors(spark)
    ok = {i: np.array(v) / np.abs(v).max() for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    ok = {i: v / np.linalg.norm(v) for i, v in ok.items()}
    links = [(i, j) for i in ok for j in ok if i < j and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= 0.9]
    degree = Counter(x for e in links for x in e)
    want = roots([i for i, _ in rows if i is not None], links)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("id", "vec", "unit", "cell", "block")})
    got = vector_dedup.vector_groups(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["vec_id"] is None:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, None, False)
        else:
            assert (r["n_links"], r["component_id"], r["kept"]) == (degree[r["vec_id"]], want[r["vec_id"]], want[r["vec_id"]] == r["vec_id"])


def test_vector_groups_empty(spark):
    assert vector_dedup.vector_groups(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_nested_levels():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(80, 3))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    levels = vector_dedup.nested_levels(x)
    for a, b in zip(levels.T[:-1], levels.T[1:], strict=True):
        for node in np.unique(b):
            assert len(np.unique(a[b == node])) == 1  # a node hangs below one node
        assert set(np.unique(a)) <= set(np.unique(b))  # levels are nested
