"""Operator 4: mixing sources to target weights on a low-discrepancy schedule of equal-token blocks.

Each source's documents, shuffled, lie on one line of words that is cut into blocks of equal length. Slots of the mix
take their source from golden-ratio points mapped through the cumulative slot shares; a source's slots, ranked, take its
blocks in turn, epoch after epoch. Sums along a line or a schedule go in two levels (segments, then rows inside a
segment), so no task holds a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rareseries.llm.common import cut, written

#: Weights by rank of the source (code point order, null last), repeating.
WEIGHTS = (5, 2, 1)
#: Words in a block at most; slots that a source gets at least (about), which bounds its relative error.
BLOCK_WORDS = 2048
LEAST_SLOTS = 1024
#: A source gives at most so many times its size.
MAX_EPOCHS = 3
#: Rows of a segment, on average, in the two-level sums.
SEGMENT = 2_000
_CELLS = 1024


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, n, source_size, target) from (source, n, source_size), one row per source.

    Targets are min(3 size, lambda weight) with the one lambda that makes them sum to the sizes: a source is full if, with
    all sources of a smaller size/weight full, its share of the rest is more than it can give.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    s = sizes.withColumn("w", weight.cast("double")).withColumn("cap", F.col("source_size") * MAX_EPOCHS)
    every = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "left": F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "w_left": F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)),
    })
    s = s.withColumn("full", F.col("cap") * F.col("w_left") <= F.col("left") * F.col("w"))
    rest = (F.sum("source_size").over(every) - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(every)).cast("double")
    w_rest = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(every)
    s = s.withColumns({"rest": rest, "w_rest": w_rest})
    return s.select("source", "n", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("rest") * F.col("w") / F.col("w_rest")).alias("target"))


def plan(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sized documents, sources): docs needs id, source, size. Sources carry block length, blocks and wanted slots."""
    sizes = docs.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    s = targets(sizes)
    s = s.withColumn("block", F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(F.col("target") / LEAST_SLOTS))).cast("long"))
    s = s.withColumn("blocks", F.ceil(F.col("source_size") / F.col("block")).cast("long"))
    s = s.withColumn("slots", F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0.0))
    return docs, cut(s)


def schedule(sources: DataFrame) -> DataFrame:
    """(slot, source, epoch, block): slots of the mix in order.

    Slot k's point is frac(k golden ratio), kept exact to some 2^-30 by splitting k. A source's slot of rank r takes
    block r mod blocks in epoch r div blocks; ranks past MAX_EPOCHS epochs (rounding, a few slots) stay empty.
    """
    spark = sources.sparkSession
    total = int(round(sources.agg(F.sum("slots")).first()[0] or 0))
    share = Window.orderBy(F.col("source").isNull(), "source")
    edge = sources.where("slots > 0").withColumn("hi", F.sum("slots").over(share.rowsBetween(Window.unboundedPreceding, 0)) / F.sum("slots").over(Window.partitionBy()))
    edge = edge.withColumns({"lo": F.lag("hi", 1, 0.0).over(share), "last": F.lead("hi").over(share).isNull()})
    edge = edge.withColumn("hi", F.when(F.col("last"), F.lit(1.0)).otherwise(F.col("hi")))
    cell = F.explode(F.sequence(F.floor(F.col("lo") * _CELLS).cast("long"), F.least(F.floor(F.col("hi") * _CELLS), F.lit(_CELLS - 1)).cast("long")))
    edge = edge.select("source", "lo", "hi", "blocks", cell.alias("cell"))
    golden, big = 0.6180339887498949, 1 << 24
    step = (0x9E3779B97F4A7C15 * big % (1 << 64)) / 2.0**64  # frac(2^24 golden ratio), from 64 bits of it
    slots = spark.range(total).withColumn("x", F.floor(F.col("id") / big) * F.lit(step) + F.pmod(F.col("id"), F.lit(big)) * F.lit(golden))
    slots = slots.select(F.col("id").alias("slot"), (F.col("x") - F.floor("x")).alias("u"))
    slots = slots.withColumn("cell", F.floor(F.col("u") * _CELLS).cast("long"))
    taken = slots.join(edge, "cell").where("u >= lo and u < hi").select("slot", "source", "blocks", F.floor(F.col("slot") / SEGMENT).alias("seg"))
    seg = taken.groupBy("source", "seg").agg(F.count("*").alias("c"))
    run = Window.partitionBy("source").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.select(F.col("source").alias("s2"), F.col("seg").alias("seg2"), F.coalesce(F.sum("c").over(run), F.lit(0)).alias("before"))
    inner = F.row_number().over(Window.partitionBy("source", "seg").orderBy("slot")) - 1
    ranked = taken.withColumn("inner", inner).join(seg, F.col("source").eqNullSafe(F.col("s2")) & (F.col("seg") == F.col("seg2")))
    ranked = ranked.withColumn("rank", F.col("inner") + F.col("before"))
    out = ranked.select("slot", "source", F.floor(F.col("rank") / F.col("blocks")).alias("epoch"), (F.col("rank") % F.col("blocks")).alias("block"))
    return out.where(F.col("epoch") < MAX_EPOCHS)


def lines(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with their place on their source's line of words: id, source, size, start, and the source's columns.

    The shuffle is the order of a hash of the id and the text, so rows that repeat an id, or have none, lie apart; rows that
    repeat both follow one another.
    """
    s = sources.select(F.col("source").alias("s1"), "n", "source_size", "target", F.col("block").alias("block_words"))
    d = docs.join(s, F.col("source").eqNullSafe(F.col("s1"))).drop("s1")
    d = d.withColumn("h", F.xxhash64("id", F.lit(4), "text_hash"))
    # the high part of the hash is the segment, so segments follow the order of the hash
    d = d.withColumn("seg", F.floor((F.col("h") / F.lit(2.0**64) + 0.5) * F.ceil(F.col("n") / SEGMENT)))
    seg = d.groupBy("source", "seg").agg(F.sum("size").alias("c"))
    run = Window.partitionBy("source").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.select(F.col("source").alias("s2"), F.col("seg").alias("seg2"), F.coalesce(F.sum("c").over(run), F.lit(0)).alias("before"))
    inner = F.sum("size").over(Window.partitionBy("source", "seg").orderBy("h", "id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    d = d.withColumn("inner", inner).join(seg, F.col("source").eqNullSafe(F.col("s2")) & (F.col("seg") == F.col("seg2")))
    return d.withColumn("start", F.col("inner") + F.col("before")).drop("h", "seg", "s2", "seg2", "before", "inner")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carried: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, source, size, source_size, target, start, first_block, last_block, copies, taken.

    taken counts the words that the mix takes from the document, repeats included; copies says how often the block with
    its first word is taken. A null source is a source of its own, last in order; texts without words take no part
    (taken and copies 0). Rows that repeat an id are documents of their own. Other columns are ignored,
    but for those in ``carried``, which come last.
    """
    sized = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), F.xxhash64(F.col(text_col)).alias("text_hash"), *carried))
    sized, sources = plan(sized)
    used = cut(schedule(sources).groupBy("source", "block").agg(F.count("*").alias("uses")).withColumnRenamed("source", "s3"))
    placed = lines(sized, sources)
    placed = placed.withColumn("first_block", F.floor(F.col("start") / F.col("block_words")))
    placed = placed.withColumn("last_block", F.when(F.col("size") > 0, F.floor((F.col("start") + F.col("size") - 1) / F.col("block_words"))).otherwise(F.col("first_block")))
    placed = cut(placed.withColumn("row", F.monotonically_increasing_id()))
    piece = placed.where("size > 0").select("row", "source", "start", "size", "block_words", F.explode(F.sequence("first_block", "last_block")).alias("at"), "first_block")
    over = F.least(F.col("start") + F.col("size"), (F.col("at") + 1) * F.col("block_words")) - F.greatest(F.col("start"), F.col("at") * F.col("block_words"))
    met = piece.join(used, (F.col("source").eqNullSafe(F.col("s3"))) & (F.col("at") == F.col("block")))
    met = met.groupBy("row").agg(F.sum(over * F.col("uses")).alias("taken"), F.sum(F.when(F.col("at") == F.col("first_block"), F.col("uses"))).alias("copies"))
    out = placed.join(met, "row", "left").withColumns({"taken": F.coalesce("taken", F.lit(0)).cast("long"), "copies": F.coalesce("copies", F.lit(0)).cast("int")})
    return out.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", "start", "first_block", "last_block", "copies", "taken", *carried)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents of the mix, whole: each row as often as the block with its first word is taken (0 to 3 times)."""
    # ids may be null or repeated, so rows are told apart by a key that is written once
    rows = written(docs.withColumn("__row", F.monotonically_increasing_id()))
    counts = mix(rows, id_col, text_col, source_col, carried=("__row",)).where("copies > 0").select(F.col("__row").alias("__mix_row"), F.col("copies").alias("__copies"))
    rows = rows.join(counts, F.col("__row") == F.col("__mix_row"))
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).drop("__copy", "__copies", "__mix_row", "__row")
