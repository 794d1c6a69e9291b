"""Operator 7: toxicity with noisy-channel deobfuscation.

1. Character trigrams of all texts are counted (a table of fixed size) and give a character language model.
2. A disguised word (symbols or digits for letters, spaced-out or dotted letters, repeated letters) is a lattice: each
   position has the letters it may stand for, at a cost; Viterbi decoding under the language model restores the word, or
   the words: what parts letters may be left out or be a word boundary. Parted letters are also read as the likeliest
   sequence of words that training texts hold.
3. The restored text is scored by a logistic model on words, word beginnings, and beginnings that two or three different
   words share, trained on labelled rows: features are chosen by their likelihood ratio and an L1 penalty, then fitted without it.

Only disguised-looking words are decoded; all others stand as they are. Scores use the text alone.
"""

from __future__ import annotations

import hashlib
import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Matrices, Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rareseries.llm import textkernel as K
from rareseries.llm.common import cut, slices, written

# What a symbol or digit may stand for (common substitutions).
STANDS_FOR = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "*": "aeiou", "(": "c"}
#: Characters that may part the letters of one word.
PARTS = ".-_*~ "
#: Symbols that may also be the punctuation they look like.
MARKS = "!|+("
#: Log probabilities of the channel: a symbol for a letter, a parting character left out, a repeated letter left out (in a
#: run of three or more; of two), a parting character that is a word boundary, a mark that is one.
SYMBOL, PART, REPEAT, DOUBLE, BREAK, MARK = (math.log(p) for p in (0.1, 0.2, 0.3, 0.001, 0.05, 0.5))
#: Longer words and runs are decoded each time they occur; shorter ones are remembered by the worker.
LONGEST = 48
#: Features that are counted and that are fitted, at most: the driver holds a number for each of them.
MAX_COUNTED, MAX_FITTED = 1 << 17, 4096
#: So many features or fewer are fitted at once; of more, so many join the working set of the fit at a time, and how far above the penalty (as a share of it) they must be pulled.
TAKEN_WHOLE, TAKEN_IN, SLACK = 512, 128, 0.01
#: Places of features in the training rows of one task of the fit.
TASK_PLACES = 1 << 20
#: Words that parted letters are read as: so many at most, each in three training rows or more, of so many letters.
MAX_WORDS, WORD_LETTERS = 1 << 16, 24
#: Log probabilities of an unknown word, and of each letter in it.
UNKNOWN, LETTER = math.log(1e-5), math.log(0.02)
#: Lengths in bytes of the word beginnings that count as features.
BEGINNINGS = (4, 5, 6, 7)
#: What is added (by exclusive or) to the hash of a beginning that so many different words of a text share.
SHARED = {2: np.uint64(0x5851F42D4C957F2D), 3: np.uint64(0x14057B7EF767814F)}

_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[ord("a") : ord("z") + 1] = np.arange(1, 27)
_CLASS[0x80:] = 27
_N = 28
_LETTER = _CLASS > 0
_ASCII = (_CLASS > 0) & (_CLASS < 27)
_NOISE = np.zeros(256, dtype=bool)
_NOISE[[ord(c) for c in STANDS_FOR]] = True
_DOT = np.zeros(256, dtype=bool)
_DOT[[ord(c) for c in PARTS.strip()]] = True

_CLOSES = np.zeros(256, dtype=bool)
_CLOSES[[ord(c) for c in ".,;:?!\"')"]] = True


def _trigrams(batches):
    total = np.zeros(_N**3, dtype=np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = K.text_buffers(part.column("text"))
            c = np.zeros(len(data) + 2 * len(part) + 2, dtype=np.int64)  # two boundaries between texts
            text = np.repeat(np.arange(len(part)), np.diff(offsets))
            c[np.arange(len(data)) + 2 * text + 2] = _CLASS[K.LOWER[data]]
            total += np.bincount(c[:-2] * _N * _N + c[1:-1] * _N + c[2:], minlength=_N**3)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["gram", "n"])


def language_model(rows: DataFrame) -> np.ndarray:
    """Log probability of each symbol after two others, from all texts (28^3 numbers)."""
    counts = np.zeros(_N**3)
    for r in rows.select("text").mapInArrow(_trigrams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[r["gram"]] = r["n"]
    counts = counts.reshape(_N, _N, _N)
    two = counts.sum(axis=0) + 0.5
    back = two / two.sum(axis=1, keepdims=True)
    return np.log((counts + 10 * back[None, :, :]) / (counts.sum(axis=2, keepdims=True) + 10))


def decode(word: str, model: np.ndarray) -> str:
    """The likeliest word behind a lower-case string, by Viterbi over the lattice of its characters.

    States are the last two symbols, each with its likeliest past as a linked list, so work grows with the length only.
    Of equal characters in a row (two or more letters, three or more symbols) those after the first may be left out; a parting
    character adds nothing or is a word boundary. Characters that stand for nothing known keep their place as a boundary.
    """
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    before = ""
    for at, ch in enumerate(word):
        spun = ch == before and ch * 3 in word[max(0, at - 2) : at + 3]  # inside a run of three or more
        options: list[tuple[str, float]] = []
        if ch.isalpha():
            options.append((ch, 0.0))
            if ch == before:
                options.append(("", REPEAT if spun else DOUBLE))
        if ch in STANDS_FOR:
            options += [(x, SYMBOL - math.log(len(STANDS_FOR[ch]))) for x in STANDS_FOR[ch]]
            if spun:
                options.append(("", REPEAT))
        if ch in PARTS:
            options += [("", PART), (" ", BREAK)]
        if ch in MARKS:
            options.append((" ", MARK))
        if not options:
            options.append((" ", 0.0))
        nxt: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (score, out) in states.items():
            for add, cost in options:
                if not add:
                    key, new = (a, b), (score + cost, out)
                else:
                    c = 0 if add == " " else (ord(add) - 96 if "a" <= add <= "z" else 27)
                    key, new = (b, c), (score + cost + float(model[a, b, c]), (out, add))
                if key not in nxt or new[0] > nxt[key][0]:
                    nxt[key] = new
        states, before = nxt, ch
    out, letters = max(((s + float(model[a, b, 0]), out) for (a, b), (s, out) in states.items()), key=lambda x: x[0])[1], []
    while out is not None:
        out, add = out
        letters.append(add)
    return "".join(reversed(letters))


def words_of(rows: DataFrame) -> tuple[str, dict[str, float]]:
    """Log probabilities of the words of texts, and a name that tells them from others."""
    found = rows.select(F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    got = found.where(f"n >= 3 and length(word) between 1 and {WORD_LETTERS}").orderBy(F.desc("n"), "word").limit(MAX_WORDS).collect()
    total = sum(r["n"] for r in got)
    return hashlib.blake2b(repr(got).encode(), digest_size=16).hexdigest(), {r["word"]: math.log(r["n"] / total) for r in got}


def segment(letters: str, words: dict[str, float]) -> str:
    """``letters`` as the likeliest sequence of words; unknown ones count by their length."""
    best, back = [0.0], [0]
    for j in range(1, len(letters) + 1):
        top, at = -math.inf, 0
        for i in range(max(0, j - WORD_LETTERS), j):
            p = words.get(letters[i:j])
            score = best[i] + (UNKNOWN + LETTER * (j - i) if p is None else p)
            if score > top:
                top, at = score, i
        best.append(top)
        back.append(at)
    out, j = [], len(letters)
    while j:
        out.append(letters[back[j] : j])
        j = back[j]
    return " ".join(reversed(out))


def _disguised(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which words hold a symbol beside a letter, a letter twice running, or letters that are parted."""
    n = len(data)
    if not n or not len(starts):
        return np.zeros(len(starts), dtype=bool)
    ascii_, noise, dot = _ASCII[data], _NOISE[data], _DOT[data]
    flag = np.zeros(n, dtype=bool)
    first = np.zeros(n, dtype=bool)
    first[starts] = True
    flag[1:-1] |= noise[1:-1] & (ascii_[:-2] | noise[:-2] | first[1:-1]) & (ascii_[2:] | (noise[2:] & ascii_[:-2]))
    flag[0] = noise[0] & (n > 1) & ascii_[min(1, n - 1)]
    flag[1:] |= noise[1:] & ascii_[:-1] & ~first[1:]
    flag[1:] |= ascii_[1:] & (data[1:] == data[:-1]) & ~first[1:]
    parted = np.flatnonzero(np.diff(np.concatenate([[0], dot.astype(np.int8), [0]])))
    a, b = parted[::2], parted[1::2]
    a, b = (x[(a > 0) & (b < n)] for x in (a, b))
    flag[a] |= (ascii_[a - 1] & (ascii_[b] | noise[b])) | (noise[a - 1] & ascii_[b])
    hit = np.concatenate([[0], np.cumsum(flag)])
    return hit[ends] > hit[starts]


def _restored(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray, model: np.ndarray, spoken: tuple[str, dict[str, float]] = ("", {})) -> tuple[list[bytes], list[int]]:
    """Restored forms of the disguised words, and of runs of three or more single characters, with their texts."""
    caches, of_model = K.worker_cache("decoded"), (hashlib.blake2b(model.tobytes(), digest_size=16).digest(), spoken[0])
    if of_model not in caches or len(caches[of_model]) > 500_000:
        caches.clear()
    cache = caches.setdefault(of_model, {})
    raw, words, owner = data.tobytes(), [], []
    odd = np.flatnonzero(_disguised(data, starts, ends))
    spans = [(raw[starts[i] : ends[i]], text[i]) for i in odd]
    alone = (ends - starts == 1) | ((ends - starts == 2) & _CLOSES[data[ends - 1]])
    single = alone & (_ASCII[data[starts]] | _NOISE[data[starts]]) if len(starts) else np.zeros(0, dtype=bool)
    turn = np.flatnonzero(np.diff(np.concatenate([[0], single.astype(np.int8), [0]])))
    for i, j in zip(turn[::2], turn[1::2], strict=True):
        for k in np.split(np.arange(i, j), np.flatnonzero(np.diff(text[i:j])) + 1):
            if len(k) >= 3:
                spans.append((b" ".join(raw[starts[x] : ends[x]] for x in k), text[i if len(k) == j - i else k[0]]))
    for s, t in spans:
        word = cache.get(s)
        if word is None:
            noisy = s.decode("utf-8", "replace").rstrip(".,;:?\"')%&#~")
            word = decode(noisy, model)
            if spoken[1] and any(x in PARTS for x in noisy):
                word += " " + segment(word.replace(" ", ""), spoken[1])
            word = word.encode()
            if len(s) <= LONGEST:
                cache[s] = word
        words.append(word)
        owner.append(int(t))
    return words, owner


def _features(column: pa.Array, model: np.ndarray, spoken) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, word's hash, text number) of words and word beginnings of restored texts; repeated ones included."""
    data, offsets = K.text_buffers(column)
    data = K.LOWER[data]
    words, owner = _restored(data, *K.word_spans(data, offsets), model, spoken)
    joined = np.frombuffer(b" ".join(words) + b" ", dtype=np.uint8) if words else np.zeros(0, dtype=np.uint8)
    at = np.cumsum([0, *(len(w) + 1 for w in words)])
    out_h, out_w, out_t = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    for d, o, names in ((data, offsets, None), (joined, at, np.array(owner, dtype=np.int64))):
        if not len(d):
            continue
        s, e, t = K.word_spans(d, o, _LETTER)
        t, word = t if names is None else names[t], K.hash_spans(d, s, e)
        out_h.append(word)
        out_w.append(word)
        out_t.append(t)
        for n in BEGINNINGS:
            long = e - s > n
            out_h.append(K.mix(K.hash_spans(d, s[long], s[long] + n) + np.uint64(n)))
            out_w.append(word[long])
            out_t.append(t[long])
    return np.concatenate(out_h), np.concatenate(out_w), np.concatenate(out_t)


def _distinct(h: np.ndarray, w: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of the features of each text, once each; beginnings that two, or three, of its words share count anew."""
    order = np.lexsort((w, h, t))
    h, w, t = h[order], w[order], t[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    other = new.copy()
    other[1:] |= w[1:] != w[:-1]
    start = np.flatnonzero(new)
    n = np.add.reduceat(other, start) if len(start) else np.zeros(0, dtype=np.int64)
    h, t = h[start], t[start]
    more = [(h[n >= k] ^ mark, t[n >= k]) for k, mark in SHARED.items()]
    return np.concatenate([h, *(x for x, _ in more)]), np.concatenate([t, *(x for _, x in more)])


def _present(column: pa.Array, model: np.ndarray, known: np.ndarray, spoken) -> tuple[np.ndarray, np.ndarray]:
    """(text number, place in ``known``) of the known features of each text, once each, by text and place."""
    h, w, t = _features(column, model, spoken)
    table, low = np.zeros(1 << 20, dtype=bool), np.uint64((1 << 20) - 1)
    for mark in (np.uint64(0), *SHARED.values()):
        table[((known ^ mark) & low).astype(np.int64)] = True
    maybe = table[(h & low).astype(np.int64)]
    h, t = _distinct(h[maybe], w[maybe], t[maybe])
    place = np.minimum(np.searchsorted(known, h), max(0, len(known) - 1))
    hit = known[place] == h if len(known) else np.zeros(len(h), dtype=bool)
    t, place = t[hit], place[hit]
    order = np.lexsort((place, t))
    return t[order], place[order]


def _positive(batches, model, spoken):
    """Distinct features of the positive rows, with how many rows of the task have them."""
    for batch in batches:
        hashes = []
        for part in slices(batch, "text"):
            hashes.append(_distinct(*_features(part.column("text"), model.value, spoken.value))[0])
        names, n = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *hashes]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(n)], ["f", "n"])


def _counted(batches, n_features: int):
    total = np.zeros(n_features, dtype=np.int64)
    for batch in batches:
        total += np.bincount(batch.column("places").flatten().to_numpy(zero_copy_only=False), minlength=n_features)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["place", "n"])


def _renamed(batches, place):
    """Rows with the places that ``place`` gives; those below 0 are left out. Other columns stay."""
    for batch in batches:
        lists = batch.column("places")
        flat = place.value[lists.flatten().to_numpy(zero_copy_only=False)]
        ends = np.concatenate([[0], np.cumsum(flat >= 0)])[np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])]
        named = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat[flat >= 0], pa.int32()))
        yield pa.RecordBatch.from_arrays([named if x == "places" else batch.column(x) for x in batch.schema.names], batch.schema.names)


def _design(batches, model, known, spoken):
    for batch in batches:
        for part in slices(batch, "text"):
            t, place = _present(part.column("text"), model.value, known.value, spoken.value)
            lists = [x.tolist() for x in np.split(place, np.searchsorted(t, np.arange(1, len(part))))]
            yield pa.RecordBatch.from_arrays([part.column("y"), pa.array(lists, pa.list_(pa.int32()))], ["y", "places"])


def _pulled(batches, weights, bias: float):
    """Minus the gradient of the summed loss for each feature, over the rows (y, places, n) of a task."""
    total = np.zeros(len(weights.value))
    for batch in batches:
        flat, count = batch.column("places").flatten().to_numpy(zero_copy_only=False), batch.column("places").value_lengths().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(batch)), count)
        z = bias + np.bincount(row, weights=weights.value[flat], minlength=len(batch))
        left = batch.column("n").to_numpy(zero_copy_only=False) * (batch.column("y").to_numpy(zero_copy_only=False) - 1 / (1 + np.exp(-z)))
        total += np.bincount(flat, weights=left[row], minlength=len(total))
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["place", "pull"])


def _dealt(design: DataFrame) -> DataFrame:
    """``design`` in as many tasks as its places ask for: what a pass sends grows with the rows, not with the shuffle's partitions."""
    n = design.agg(F.sum(F.size("places") + 1)).first()[0] or 0
    return design.coalesce(max(1, -(-n // TASK_PLACES)))


def fit(design: DataFrame, n_features: int, l1: float = 0.3, ridge: float = 0.03) -> tuple[np.ndarray, float]:
    """Weights (0 or above) and bias of 0/1 features from rows (y, places, n): n training rows each. Penalties are those of the sum over all rows.

    Every pass over the rows is a Spark job; the driver holds a number per feature. An L1 penalty chooses the features; their weights
    are fitted again without it, but for a slight ridge. The choice is made on a working set, which takes in the features that the
    loss pulls up by more than the penalty until none is left outside: the short jobs of the solver run over the rows as that set tells them apart.
    """
    spark, design = design.sparkSession, _dealt(design)
    total, positive = design.agg(F.sum("n"), F.sum(F.col("y") * F.col("n"))).first()

    def within(names: np.ndarray) -> DataFrame:
        place = np.full(n_features, -1, dtype=np.int32)
        place[names] = names
        rows = design.mapInArrow(partial(_renamed, place=spark.sparkContext.broadcast(place)), "y int, places array<int>, n long")
        return _dealt(cut(rows.groupBy("y", "places").agg(F.sum("n").alias("n"))))

    def vectors(rows: DataFrame, names: np.ndarray) -> DataFrame:
        place = {int(x): i for i, x in enumerate(names)}

        def vector(places):
            at = [place[x] for x in places if x in place]
            return Vectors.sparse(len(names), at, [1.0] * len(at))

        return rows.select(F.col("y").cast("double").alias("label"), F.udf(vector, VectorUDT())("places").alias("features"), F.col("n").cast("double").alias("weight"))

    logistic = LogisticRegression(weightCol="weight", standardization=False, maxIter=200, tol=1e-7)
    base = math.log((positive / total + 1e-6) / (1 - positive / total + 1e-6))
    weights, bias = np.zeros(n_features), base

    def choose(rows: DataFrame, names: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        while len(names):  # a feature whose weight is negative is left out and the rest chosen from anew
            found = logistic.setParams(regParam=l1 / total, elasticNetParam=1.0).fit(vectors(rows, names))
            w = found.coefficients.toArray()
            if (w >= 0).all():
                weights = np.zeros(n_features)
                weights[names] = w
                return weights, float(found.intercept), names
            names = names[w >= 0]
        return np.zeros(n_features), base, names

    names, outside = np.zeros(0, dtype=np.int64), np.ones(n_features, dtype=bool)
    rows = design
    if n_features <= TAKEN_WHOLE:
        weights, bias, names = choose(rows, np.arange(n_features))
        outside[:] = False
    while outside.any():
        pull = np.zeros(n_features)
        for r in design.mapInArrow(partial(_pulled, weights=spark.sparkContext.broadcast(weights), bias=bias), "place long, pull double").groupBy("place").agg(F.sum("pull").alias("pull")).collect():
            pull[r["place"]] = r["pull"]
        new = np.flatnonzero(outside & (pull > l1 * (1 + SLACK)))
        if not len(new):
            break
        new = new[np.argsort(-pull[new], kind="stable")[:TAKEN_IN]]
        outside[new] = False
        names = np.sort(np.concatenate([names, new]))
        rows = within(names)
        weights, bias, names = choose(rows, names)
    chosen = np.flatnonzero(weights)
    if not len(chosen):
        return weights, bias
    bounds = Matrices.dense(1, len(chosen), [0.0] * len(chosen))
    found = logistic.setParams(regParam=ridge / total, elasticNetParam=0.0, lowerBoundsOnCoefficients=bounds).fit(vectors(rows, chosen))
    weights = np.zeros(n_features)
    weights[chosen] = found.coefficients.toArray()
    return weights, float(found.intercept)


def likelihood_ratio(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    """Signed G statistic of presence against the label (positive: commoner in positive rows)."""
    p = n_pos / (n_pos + n_neg)
    n = pos + neg
    with np.errstate(divide="ignore", invalid="ignore"):
        g = np.where(pos > 0, pos * np.log(pos / (n * p)), 0) + np.where(neg > 0, neg * np.log(neg / (n * (1 - p))), 0)
    return np.where(pos > n * p, 2 * g, -2 * g)


def _score(batches, model, known, weights, bias: float, spoken):
    for batch in batches:
        for part in slices(batch, "text"):
            t, place = _present(part.column("text"), model.value, known.value, spoken.value)
            z = bias + np.bincount(t, weights=weights.value[place], minlength=len(part))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(1 / (1 + np.exp(-z)))], ["id", "score"])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = 0.7) -> DataFrame:
    """One row per document: id_col, held_out, score (0 to 1), predicted (1 if score >= threshold).

    Trains on all labelled rows that are not held out (crc32 of the id as text modulo 3 is not 1). Rows without a
    label value are left out of training, as are null ids. Null and empty texts get the score of a text without any feature.
    Rows that repeat an id are scored one by one. Without labels of both kinds all scores are the base rate.
    Other columns of either table are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    model = spark.sparkContext.broadcast(language_model(rows))
    some = labels.select(F.col(id_col).cast("long").alias("lid"), F.col(label_col).cast("int").alias("y")).where("lid is not null and y is not null")
    some = some.where(~held_out(F.col("lid"))).groupBy("lid").agg(F.max("y").alias("y"))
    # merged at every size: labels grow with the documents, and no broadcast does
    train = written(rows.where(~held_out(F.col("id"))).join(some.hint("merge"), F.col("id") == F.col("lid")).select("y", "text"))
    spoken = spark.sparkContext.broadcast(words_of(train))
    sizes = {r["y"]: r["count"] for r in train.groupBy("y").count().collect()}
    n_pos, n_neg = sizes.get(1, 0), sizes.get(0, 0)
    known, weights, bias = np.zeros(0, dtype=np.uint64), np.zeros(0), math.log((n_pos + 1) / (n_neg + 9))
    if n_pos and n_neg:
        pos = train.where("y = 1").select("text").mapInArrow(partial(_positive, model=model, spoken=spoken), "f long, n long")
        pos = pos.groupBy("f").agg(F.sum("n").alias("n")).where(f"n >= {max(3, n_pos // 2000)}")
        got = pos.orderBy(F.desc("n"), "f").limit(MAX_COUNTED).toArrow()
        f, p = got.column("f").to_numpy().view(np.uint64), got.column("n").to_numpy()
        order = np.argsort(f)
        f, p = f[order], p[order]
        counted = spark.sparkContext.broadcast(f)
        n = np.zeros(len(f), dtype=np.int64)
        listed = written(train.mapInArrow(partial(_design, model=model, known=counted, spoken=spoken), "y int, places array<int>"))
        for r in listed.where("y = 0").select("places").mapInArrow(partial(_counted, n_features=len(f)), "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toLocalIterator():
            n[r["place"]] = r["n"]
        g = likelihood_ratio(p, n, n_pos, n_neg)
        best = np.sort(np.argsort(-g)[:MAX_FITTED])
        best = best[g[best] >= 10]
        known = f[best]
        if len(known):
            place = np.full(len(f), -1, dtype=np.int32)
            place[best] = np.arange(len(best))
            design = listed.mapInArrow(partial(_renamed, place=spark.sparkContext.broadcast(place)), "y int, places array<int>")
            weights, bias = fit(cut(design.groupBy("y", "places").agg(F.count("*").alias("n"))), len(known))
            known, weights = known[weights > 0], weights[weights > 0]
    scored = rows.mapInArrow(partial(_score, model=model, known=spark.sparkContext.broadcast(known), weights=spark.sparkContext.broadcast(weights), bias=float(bias), spoken=spoken), "id long, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
