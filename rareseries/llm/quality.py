"""Operator 8: document quality by ordinal cumulative-link regression on graded ratings.

Hashed features of the text (words, the shapes of words, and a few proportions) share one weight each; ordered thresholds
turn the linear score s into grades: P(grade <= j) = sigmoid(threshold_j - s). The expected grade and the tail probability
P(grade >= keep grade) follow.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareseries.llm import textkernel as K
from rareseries.llm.common import cut, slices

#: Hash buckets of features; 40 of them would already tell the shapes apart.
DIMS = 1 << 15
#: Rated rows that training takes at most (those with the smallest hashes of their ids).
MAX_TRAIN = 8_000
ROUNDS = 150

# upper-case, lower-case (and all other letters), digit; any other character is its own class
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("A") : ord("Z") + 1] = ord("A")
_SHAPE[ord("a") : ord("z") + 1] = ord("a")
_SHAPE[0x80:] = ord("a")
_SHAPE[ord("0") : ord("9") + 1] = ord("0")
_UPPER, _PLAIN = np.arange(256) == ord("A"), np.isin(np.arange(256), [ord("a"), ord("A"), 0x20, 0x0A])


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket, value): root of the share of words with each feature, and proportions in steps."""
    data, offsets = K.text_buffers(column)
    n_texts = len(column)
    starts, ends, text = K.word_spans(data, offsets)
    count = np.bincount(text, minlength=n_texts)
    words = K.hash_spans(K.LOWER[data], starts, ends)
    shape = _SHAPE[data]
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[starts] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    shapes = K.hash_spans(shape[keep], at[starts], at[ends])
    mask = np.uint64(DIMS // 2 - 1)
    # words fill the lower half of the buckets, shapes the upper one
    bucket = np.concatenate([(words & mask).astype(np.int64), (shapes & mask).astype(np.int64) + DIMS // 2])
    owner = np.concatenate([text, text])
    key, n = np.unique(owner * DIMS + bucket, return_counts=True)
    row, col = key // DIMS, key % DIMS
    value = np.sqrt(n / np.maximum(count[row], 1))
    size = np.maximum(np.diff(offsets), 1)
    share = lambda flags: np.concatenate([[0], np.cumsum(flags)])[offsets[1:]] - np.concatenate([[0], np.cumsum(flags)])[offsets[:-1]]
    distinct = np.bincount(np.unique(np.stack([text, words.view(np.int64)]), axis=1)[0].astype(np.int64), minlength=n_texts) if len(text) else np.zeros(n_texts)
    steps = [
        np.minimum(9, 10 * share(_UPPER[shape]) // size), np.minimum(9, 20 * share(~_PLAIN[shape]) // size),
        np.minimum(9, 10 * distinct // np.maximum(count, 1)), np.minimum(9, np.diff(offsets) // np.maximum(count, 1)), np.minimum(9, np.log2(1 + count)),
    ]
    extra = [K.mix(np.full(n_texts, 1000 * i + 1, dtype=np.uint64) + s.astype(np.uint64)) & mask for i, s in enumerate(steps)]
    row = np.concatenate([row, np.tile(np.arange(n_texts), len(steps))])
    col = np.concatenate([col, np.concatenate(extra).astype(np.int64) + DIMS // 2])
    return row, col, np.concatenate([value, np.full(n_texts * len(steps), 0.5)])


def fit_ordinal(row: np.ndarray, col: np.ndarray, value: np.ndarray, grade: np.ndarray, n_grades: int, l2: float = 1e-5, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds of the cumulative logit model, by Adam on the whole likelihood.

    Thresholds are a first one plus positive steps, so they stay in order.
    """
    n = len(grade)
    w = np.zeros(DIMS)
    cum = np.cumsum(np.bincount(grade, minlength=n_grades))[:-1] / n
    cum = np.clip(cum, 1e-3, 1 - 1e-3)
    theta = np.log(cum / (1 - cum))
    param = np.concatenate([w, [theta[0]], np.log(np.maximum(np.diff(theta), 1e-3))])
    m, s = np.zeros(len(param)), np.zeros(len(param))
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for i in range(1, rounds + 1):
        w, first, gaps = param[:DIMS], param[DIMS], np.exp(param[DIMS + 1 :])
        theta = first + np.concatenate([[0.0], np.cumsum(gaps)])
        z = np.bincount(row, weights=w[col] * value, minlength=n)
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        hi, lo = edge[grade + 1] - z, edge[grade] - z
        p_hi, p_lo = np.where(np.isinf(hi), 1.0, sig(hi)), np.where(np.isinf(lo), 0.0, sig(lo))
        p = np.maximum(p_hi - p_lo, 1e-12)
        d_hi, d_lo = p_hi * (1 - p_hi) / p, p_lo * (1 - p_lo) / p
        dz = (d_hi - d_lo) / n  # of the negative log likelihood by z
        dt = np.bincount(grade, weights=-d_hi, minlength=n_grades)[: n_grades - 1] / n + np.bincount(grade, weights=d_lo, minlength=n_grades)[1:] / n
        tail = np.cumsum(dt[::-1])[::-1]
        grad = np.concatenate([np.bincount(col, weights=value * dz[row], minlength=DIMS) + l2 * w, [tail[0]], tail[1:] * gaps])
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad * grad
        param = param - 0.1 * (m / (1 - 0.9**i)) / (np.sqrt(s / (1 - 0.99**i)) + 1e-8)
    return param[:DIMS].copy(), param[DIMS] + np.concatenate([[0.0], np.cumsum(np.exp(param[DIMS + 1 :]))])


#: The name of the text column on its way through the tasks; no table has it.
TEXT = "__rated_text"


def _design(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            row, col, value = features(part.column("text"))
            order = np.argsort(row, kind="stable")
            cuts = np.searchsorted(row[order], np.arange(1, len(part)))
            yield pa.RecordBatch.from_arrays([
                part.column("y"),
                pa.array([x.tolist() for x in np.split(col[order], cuts)], pa.list_(pa.int32())),
                pa.array([x.tolist() for x in np.split(value[order], cuts)], pa.list_(pa.float32())),
            ], ["y", "cols", "vals"])


def _rate(batches, weights, thresholds, grades, keep_from: int):
    for batch in batches:
        for part in slices(batch, TEXT):
            row, col, value = features(part.column(TEXT))
            z = np.bincount(row, weights=weights.value[col] * value, minlength=len(part))
            above = 1 / (1 + np.exp(np.clip(np.asarray(thresholds)[None, :] - z[:, None], -30, 30)))  # P(grade > j)
            expected = grades[0] + above @ np.diff(np.asarray(grades, dtype=float))
            tail = above[:, keep_from - 1] if 0 < keep_from <= above.shape[1] else np.full(len(z), 1.0 if keep_from <= 0 else 0.0)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in part.schema.names), pa.array(expected), pa.array(tail)], [*part.schema.names, "expected_grade", "tail_probability"])


def train(docs: DataFrame, ratings: DataFrame, id_col: str, text_col: str, rating_col: str) -> tuple[np.ndarray, np.ndarray, list[int]] | None:
    """Weights, thresholds and grades from MAX_TRAIN rated documents at most; None if they hold fewer than two grades."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    some = ratings.select(F.col(id_col).cast("long").alias("lid"), F.col(rating_col).cast("int").alias("y")).where("lid is not null and y is not null")
    some = cut(some.groupBy("lid").agg(F.min("y").alias("y")).orderBy(F.xxhash64("lid"), "lid").limit(MAX_TRAIN))
    # at most MAX_TRAIN pairs of numbers
    design = rows.join(F.broadcast(some), F.col("id") == F.col("lid")).select("y", "text").mapInArrow(_design, "y int, cols array<int>, vals array<float>").toArrow()
    y = design.column("y").to_numpy()
    grades, grade = np.unique(y, return_inverse=True)
    if len(grades) < 2:
        return None
    cols, vals = design.column("cols").combine_chunks(), design.column("vals").combine_chunks()
    row = np.repeat(np.arange(len(y)), np.diff(cols.offsets.to_numpy()))
    weights, thresholds = fit_ordinal(row, cols.flatten().to_numpy().astype(np.int64), vals.flatten().to_numpy().astype(float), grade, len(grades))
    return weights, thresholds, [int(g) for g in grades]


def rate(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", rating_col: str = "quality", keep_grade: int = 1) -> DataFrame:
    """``docs`` with expected_grade and tail_probability (of ``keep_grade`` or more) in two more columns.

    All columns of docs stay (columns of those two names are replaced). Null and empty texts are rated by the
    features of an empty text. Ratings that are null, or of null ids, are left out; an id rated twice takes the lower grade.
    With fewer than two grades among the ratings every document gets that grade (null without any) and tail 1.
    """
    spark = docs.sparkSession
    docs = docs.drop("expected_grade", "tail_probability")
    model = train(docs, ratings, id_col, text_col, rating_col)
    if model is None:
        only = ratings.agg(F.min(rating_col).cast("double")).first()[0]
        return docs.withColumns({"expected_grade": F.lit(only).cast("double"), "tail_probability": F.lit(1.0)})
    weights, thresholds, grades = model
    keep_from = sum(g < keep_grade for g in grades)
    renamed = docs.withColumnRenamed(text_col, TEXT)
    run = partial(_rate, weights=spark.sparkContext.broadcast(weights), thresholds=thresholds.tolist(), grades=grades, keep_from=keep_from)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in renamed.schema.fields) + ", expected_grade double, tail_probability double"
    return renamed.mapInArrow(run, schema).withColumnRenamed(TEXT, text_col)


def keep_good(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", rating_col: str = "quality", keep_grade: int = 1, least: float = 0.5) -> DataFrame:
    """The documents whose probability of ``keep_grade`` or more is at least ``least``; columns as in ``docs``."""
    return rate(docs, ratings, id_col, text_col, rating_col, keep_grade).where(F.col("tail_probability") >= least).select(*docs.columns)
