"""Operator 13: how far the word use of sources differs within a language.

A table of 256 bytes lowers A-Z and blanks every separator, so that ``bytes.translate`` and ``bytes.split`` cut a text
into terms; a ``Counter`` of each document gives its terms and their frequencies. Tasks add them up by (lang, source,
term) in tables of bounded size, and Spark adds up what the tasks emit. From then on all is a sparse aggregation: a term
that neither of two sources has differs by a constant, so only terms that occur are read, in blocks of terms and sources.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rareseries.llm.common import written

#: Separators (all ASCII but letters) become spaces, A-Z become a-z, all other bytes stand.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Entries and bytes of terms that a task holds before it hands its sums on.
HELD_TERMS, HELD_BYTES = 200_000, 32 << 20
#: Bytes of a text that are split at a time.
RUN_BYTES = 1 << 20
#: Rows of a shard of terms and sources of a block, on average.
SHARD_ROWS, BLOCK_SOURCES = 100_000, 64
#: Terms whose scores are a dense matrix at a time.
DENSE_TERMS = 2048

_COUNTS = "lang string, source string, term string, docs long, count long"


def terms(text: bytes) -> Iterator[list[bytes]]:
    """Runs of a text's terms; no run holds more than ``RUN_BYTES`` and one term."""
    plain, at = text.translate(TABLE), 0
    while at < len(plain):
        to = plain.find(b" ", at + RUN_BYTES) if at + RUN_BYTES < len(plain) else -1
        to = len(plain) if to < 0 else to
        yield plain[at:to].split()
        at = to


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs: dict[tuple, Counter] = {}
    count: dict[tuple, Counter] = {}
    held = size = 0

    def flush():
        names = [(lang, source, term, n, count[lang, source][term]) for (lang, source), of in docs.items() for term, n in of.items()]
        for i in range(0, len(names), 50_000):
            lang, source, term, n, c = zip(*names[i : i + 50_000], strict=True)
            columns = [pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(c, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "docs", "count"])

    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        texts = batch.column("text").cast(pa.binary())
        for i, key in enumerate(zip(langs, sources, strict=True)):
            of = Counter()
            for run in terms(texts[i].as_py()):
                of.update(run)
            if not of:
                continue
            if key not in docs:
                docs[key], count[key] = Counter(), Counter()
            d, c = docs[key], count[key]
            before = len(d)
            d.update(of.keys())
            for term, n in of.items():
                c[term] += n
            if len(d) > before:
                held += len(d) - before
                size += sum(map(len, of))  # an upper bound of what is new
            if held > HELD_TERMS or size > HELD_BYTES:
                yield from flush()
                docs, count, held, size = {}, {}, 0, 0
    yield from flush()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, term, docs (documents that hold the term), count (its occurrences); a null column reads as ''."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    return rows.mapInArrow(_count, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("count"))


def _score(count: str, total: str) -> str:
    """1 + floor(10^9 (count + 5) / (N + 5 V)), in decimals of 38 digits."""
    return f"1 + (cast(1000000000 as decimal(10, 0)) * ({count} + 5)) div ({total} + 5 * v)"


_DISTANCES = "lang string, source string, other string, excess long"


def _distances(key, group):
    """For two blocks of sources of a language and one shard of its terms: by pair of sources, how much the sum of |p - q| over
    the shard's terms differs from what it were if no source had any of them."""
    lang, low, high = (key[i].as_py() for i in range(3))
    source, block, term, p = (group.column(c) for c in ("source", "block", "term", "p"))
    names = source.combine_chunks().dictionary_encode()
    which = names.indices.to_numpy(zero_copy_only=False)
    n = len(names.dictionary)
    blocks, base = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    blocks[which] = block.to_numpy()
    scores = p.to_numpy()
    bare = pc.is_null(term).to_numpy(zero_copy_only=False)  # one row a source: its score of a term it has not
    base[which[bare]] = scores[bare]
    which, scores = which[~bare], scores[~bare]
    at = term.combine_chunks().filter(pa.array(~bare)).dictionary_encode()
    of, n_terms = at.indices.to_numpy(zero_copy_only=False), len(at.dictionary)
    order = np.argsort(of, kind="stable")
    of, which, scores = of[order], which[order], scores[order]
    left, right = np.flatnonzero(blocks == low), np.flatnonzero(blocks == high)
    total = np.zeros((len(left), len(right)), dtype=np.int64)
    for first in range(0, n_terms, DENSE_TERMS):
        a, b = np.searchsorted(of, [first, first + DENSE_TERMS])
        dense = np.repeat(base[None, :], min(DENSE_TERMS, n_terms - first), axis=0)
        dense[of[a:b] - first, which[a:b]] = scores[a:b]
        columns = np.ascontiguousarray(dense[:, right])
        for i, s in enumerate(left):
            total[i] += np.abs(columns - dense[:, [s]]).sum(axis=0)
    total -= n_terms * np.abs(base[left][:, None] - base[right][None, :])
    if low != high:
        pairs = [(i, j, x) for i, r in enumerate(total) for j, x in enumerate(r.tolist())]
        pairs = [(left[i], right[j], x) for i, j, x in pairs] + [(right[j], left[i], x) for i, j, x in pairs]
    else:
        pairs = [(left[i], right[j], x) for i, r in enumerate(total) for j, x in enumerate(r.tolist()) if i != j]
    words = names.dictionary.to_pylist()
    return pa.table({
        "lang": pa.array([lang] * len(pairs), pa.string()), "source": pa.array([words[i] for i, _, _ in pairs], pa.string()),
        "other": pa.array([words[j] for _, j, _ in pairs], pa.string()), "excess": pa.array([x for _, _, x in pairs], pa.int64()),
    })


def source_divergence(docs: DataFrame, min_docs: int = 30, top: int = 50, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value (long), rank (int): by group (lang, source), every other source of the language with
    the sum of |p - q| over the language's kept terms (part ``pair``), and the ``top`` terms that the group uses more than its
    language does (part ``term``).

    Null text, lang and source read as ''. A term is kept in a language where at least ``min_docs`` documents hold it. Groups
    without any term take part; without kept terms every distance is 0. Repeated rows and ids count as documents each.
    Ties go by the item's UTF-8 bytes. An empty table gives no rows. Other columns are not read.
    """
    counts = written(term_counts(docs, text_col, lang_col, source_col))
    groups = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source")).distinct()
    terms_kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("lang_count")).where(F.col("docs") >= min_docs).drop("docs")
    kept = written(counts.drop("docs").join(terms_kept, ["lang", "term"]))
    langs = kept.groupBy("lang").agg(F.count("*").alias("rows"), F.sum("count").alias("lang_total"), F.countDistinct("term").alias("v"))
    totals = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    sizes = groups.groupBy("lang").agg(F.count("*").alias("n_sources"))
    groups = groups.join(sizes, "lang").join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = groups.fillna(0, ["rows", "lang_total", "v", "total"]).withColumns({
        "base": F.when(F.col("v") > 0, F.expr(_score("0L", "total"))).otherwise(F.lit(0)).cast("long"),
        "blocks": F.ceil(F.col("n_sources") / BLOCK_SOURCES).cast("int"),
        "shards": F.greatest(F.ceil(F.col("rows") / SHARD_ROWS), F.lit(1)).cast("int"),
    }).withColumn("block", F.pmod(F.xxhash64("source"), "blocks").cast("int"))
    groups = written(groups)

    scored = kept.join(groups, ["lang", "source"]).withColumn("p", F.expr(_score("count", "total")).cast("long")).withColumn("q", F.expr(_score("lang_count", "lang_total")).cast("long"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    term_rows = scored.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    term_rows = term_rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    # each source's scores go to every pair of blocks that its block is part of; a row without a term carries its base
    there = scored.select("lang", "source", "block", "blocks", F.pmod(F.xxhash64("term"), "shards").cast("int").alias("shard"), "term", "p")
    bases = groups.select("lang", "source", "block", "blocks", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.lit(None).cast("string").alias("term"), F.col("base").alias("p"))
    faced = there.unionByName(bases).withColumn("facing", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    faced = faced.select("lang", F.least("block", "facing").alias("low"), F.greatest("block", "facing").alias("high"), "shard", "source", "block", "term", "p")
    excess = faced.groupBy("lang", "low", "high", "shard").applyInArrow(_distances, _DISTANCES).groupBy("lang", "source", "other").agg(F.sum("excess").alias("excess"))

    mine = groups.select("lang", "source", "base", "v")
    pairs = excess.join(mine, ["lang", "source"]).join(mine.select("lang", F.col("source").alias("other"), F.col("base").alias("other_base")), ["lang", "other"])
    value = F.col("excess") + F.col("v") * F.abs(F.col("base") - F.col("other_base"))
    pair_rows = pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), value.cast("long").alias("value")).withColumn("rank", F.row_number().over(best))
    return term_rows.unionByName(pair_rows)
