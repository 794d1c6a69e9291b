"""Operator 6: line deduplication by a segment-partition edit join (DataFrame functions only).

Two lines are near copies if one edit (insert, delete, replace a character) at most parts them. A line of l characters is
split into two segments, so one of them is untouched by an edit: its beginning (l div 2 characters) or its end. Every
distinct line is indexed under (length, segment) and probes the indexes of its own length and of the length below.

A segment that more than ``HOT`` different lines share is not paired. The edit then lies in the other segment, the hole,
which is split in two again: its lines move to the keys (segment, first half of the hole) and (segment, second half). This
goes on until a key is rare or its hole is one character; the lines of one length under such a key are all near
copies, so pairing each with the earliest of them tells the same as all pairs. Pairs found are verified by Spark's
levenshtein with a threshold, which works in a band of the matrix.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareseries.llm.common import bucketed, cut, written

#: Shorter lines (headings, list marks) have no near copies; whether their exact copies go is up to the caller.
MIN_CHARS = 20
#: Lines of a length under one key, beyond which the key is split instead of paired.
HOT = 8
#: A line that makes up more than one in so many lines is common: its places are dealt to ``SLOTS`` tasks.
COMMON = 1024
SLOTS = 64


def _keyed(holes: DataFrame) -> DataFrame:
    """Add the key of each (text, shorter, lo, hi): what a line of ``shorter`` characters less has outside its hole [lo, hi).

    The line itself has ``shorter`` characters more inside the hole.
    """
    n = F.char_length("text") - F.col("shorter")
    return holes.withColumn("key", F.xxhash64(n, "lo", "hi", F.left("text", F.col("lo")), F.right("text", n - F.col("hi"))))


def _hole(shorter, lo, hi):
    return F.struct(shorter.cast("int").alias("shorter"), lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))


def _near_pairs(first: DataFrame, hot: int) -> DataFrame:
    """(a, b): candidates among distinct lines (line, first, text), at most ``hot`` for each line, length and key.

    Of lines that have an earlier line one edit away, each is paired with one such line at least.
    """
    n, zero, one = F.char_length("text"), F.lit(0), F.lit(1)
    holes = [_hole(s, lo, hi) for s in (zero, one) for half in [F.floor((n - s) / 2)] for lo, hi in ((half, n - s), (zero, half))]
    texts, found = first, []
    level = _keyed(first.select("line", "text", F.explode(F.array(*holes)).alias("hole")).select("line", "text", "hole.*"))
    while True:
        crowd = level.groupBy("key").agg(F.count_if(F.col("shorter") == 0).alias("lines"), F.count("*").alias("entries"))
        crowd = cut(crowd.where("lines > 0 and entries > 1").select("key", (F.col("lines") > hot).alias("hot")))
        shared = written(level.select("line", "shorter", "lo", "hi", "key").join(crowd, "key"))
        rare, many = shared.where("not hot"), shared.where("hot")
        index = rare.where("shorter = 0").select(F.col("line").alias("b"), "key")
        found.append(rare.select(F.col("line").alias("a"), "key").join(index, "key").where("a <> b").select("a", "b").distinct())
        if many.isEmpty():
            return reduce(DataFrame.union, found).distinct()
        texts = written(texts.join(many.select("line").distinct(), "line", "left_semi"))
        tight = many.where("hi - lo = 1 and shorter = 0").select("line", "key").join(texts.select("line", "first"), "line")
        head = tight.groupBy("key").agg(F.min_by("line", "first").alias("b"))
        found.append(tight.select(F.col("line").alias("a"), "key").join(head, "key").where("a <> b").select("a", "b"))
        # a hole of one character leaves room for an insertion before it or after it
        wide, mid = F.col("hi") - F.col("lo") > 1, F.floor((F.col("lo") + F.col("hi")) / 2)
        lower = _hole(F.col("shorter"), F.col("lo"), F.when(wide, mid).otherwise(F.col("lo")))
        upper = _hole(F.col("shorter"), F.when(wide, mid).otherwise(F.col("hi")), F.col("hi"))
        parts = many.where("hi > lo").select("line", F.explode(F.array(lower, upper)).alias("hole")).select("line", "hole.*")
        level = written(_keyed(parts.join(texts.select("line", "text"), "line")).drop("text"))


def line_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, hot: int = HOT, short: bool = False) -> DataFrame:
    """One row per document: id_col, n_lines, n_removed, kept_text.

    Lines end at newlines. A line of ``min_chars`` (2 at least) or more goes if an equal line occurs earlier (by id, then
    line number), or if a line one edit away first occurs earlier; this is judged on the input. Null texts have no lines and
    a null kept_text; an empty text is one empty line. A null id comes last. Rows that repeat an id, or have none, are
    documents of their own, in the order in which they are read. With ``short``, exact copies of shorter lines go as well, but
    for blank ones. Other columns are ignored. Lines and segments
    are told apart by 64-bit hashes. ``hot`` changes the work, never the result.
    """
    # rows have a key of their own, written once so that all later reads agree on it; ids give the order only
    rows = written(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    rows = rows.select("row", "id", F.split("text", "\n").alias("lines"))
    nth = F.struct(F.col("id").isNull().alias("last"), "id", "row")
    split = rows.select("row", nth.alias("nth"), F.posexplode("lines").alias("at", "text"))
    long = F.char_length("text") >= max(2, min_chars)
    split = split.where(long | F.col("text").rlike(r"\S") if short else long)
    split = split.withColumn("line", F.xxhash64("text"))
    first = bucketed(split.groupBy("line").agg(F.min(F.struct("nth", "at")).alias("first"), F.min("text").alias("text"), F.count("*").alias("copies")), "line")
    bound = (first.agg(F.sum("copies")).first()[0] or 0) // COMMON
    common = first.where(F.col("copies") > bound).select(F.col("line").alias("common_line"))  # fewer than COMMON lines
    pairs = written(_near_pairs(first.where(long), hot))
    ends = pairs.select(F.col("a").alias("line")).union(pairs.select(F.col("b").alias("line"))).distinct()
    ends = written(first.join(ends, "line", "left_semi"))
    a = ends.select(F.col("line").alias("a"), F.col("first").alias("fa"), F.col("text").alias("ta"))
    b = ends.select(F.col("line").alias("b"), F.col("first").alias("fb"), F.col("text").alias("tb"))
    near = pairs.join(a, "a").join(b, "b").where(F.levenshtein("ta", "tb", 1) >= 0)
    late = cut(near.select(F.when(F.col("fa") > F.col("fb"), F.col("a")).otherwise(F.col("b")).alias("gone_line")).distinct())
    # the line itself goes wherever it stands, a line that stays goes everywhere but at its first place
    verdict = first.where("copies > 1").select("line", "first").join(late, F.col("line") == F.col("gone_line"), "full")
    verdict = verdict.select(F.coalesce("line", "gone_line").alias("vline"), "first", "gone_line").join(F.broadcast(common), F.col("vline") == F.col("common_line"), "left")
    slots = F.when(F.col("common_line").isNotNull(), F.sequence(F.lit(0), F.lit(SLOTS - 1))).otherwise(F.array(F.lit(0)))
    verdict = verdict.select("vline", "first", "gone_line", F.explode(slots).alias("vslot"))
    slot = F.when(F.col("common_line").isNotNull(), F.pmod(F.xxhash64("row", "at"), F.lit(SLOTS)).cast("int")).otherwise(0)
    places = split.join(F.broadcast(common), F.col("line") == F.col("common_line"), "left").select("line", "row", "at", slot.alias("slot"))
    places = places.join(verdict, (F.col("line") == F.col("vline")) & (F.col("slot") == F.col("vslot")))
    places = places.where(F.col("gone_line").isNotNull() | (F.col("row") != F.col("first.nth.row")) | (F.col("at") != F.col("first.at")))
    gone = places.groupBy("row").agg(F.collect_set("at").alias("gone"))
    out = rows.join(gone, "row", "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    out = out.select(F.col("id").alias(id_col), "lines", F.when(F.col("lines").isNotNull(), stay).alias("stay"))
    kept = F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n")
    n = F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines"))
    return out.select(id_col, n.cast("long").alias("n_lines"), F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines") - F.size("stay")).cast("long").alias("n_removed"), kept.alias("kept_text"))
