"""Operator 1: exact deduplication on 128-bit content hashes, with the bytes compared inside each hash group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rareseries.llm.common import cut

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty. (``lower`` does just that on text without other letters.)"""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per document: id_col, keep_id, group_size, kept, text_sha256.

    Rows are grouped by the 128-bit hash and the normalised bytes themselves, so a hash collision never merges
    two texts; copies combine before the shuffle, so a hot group costs a row per task. Only (id, hashes) are joined
    with the table of groups of two or more, which is written first: the skew join can then split a hot group.

    Null or empty texts form one group. A null id is never chosen while the group has another id; a group of
    null ids only has a null keep_id and none is kept. Rows that repeat id and text are all reported (and kept)
    alike (``drop_copies`` leaves one of them). Two different texts that agree in both MD5 and SHA-256 raise an error. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), ascii_lower(F.col(text_col)).alias("norm"))
    rows = rows.select("id", F.unhex(F.md5("norm")).alias("h"), "norm")
    chosen = (F.min if keep == "smallest" else F.max)("id")
    texts = rows.groupBy("h", "norm").agg(chosen.alias("keep_id"), F.count("*").alias("group_size"))
    groups = texts.where("group_size > 1").select("h", F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size")
    groups = cut(groups)
    clash = groups.groupBy("h", "sha").count().where("count > 1").limit(1).collect()
    if clash:
        raise ValueError("two different texts agree in MD5 and SHA-256")
    return (
        rows.select("id", "h", F.unhex(F.sha2("norm", 256)).alias("sha")).join(groups, ["h", "sha"], "left")
        .select(
            F.col("id").alias(id_col),
            F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            F.lower(F.hex("sha")).alias("text_sha256"),
        )
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("keep_id"), F.lit(False)))
        .select(id_col, "keep_id", "group_size", "kept", "text_sha256")
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """``docs`` with one row of each group of equal texts (all columns stay).

    Losers are removed by an anti-join on the id, so texts move only if the losers are too many to broadcast. Where the
    id that stays stands on several rows, or a group has no id, the smallest of these rows by all columns stays.
    """
    groups = cut(exact_groups(docs, id_col, text_col, keep).where("group_size > 1").select(F.col(id_col).alias("__lost_id"), F.unhex("text_sha256").alias("__lost_sha"), "keep_id"))
    stays = F.col("__lost_id").eqNullSafe(F.col("keep_id"))
    losers = groups.where(~stays).select("__lost_id", "__lost_sha").distinct()
    again = cut(groups.where(stays).groupBy("__lost_id", "__lost_sha").count().where("count > 1").drop("count"))
    same = docs[id_col].eqNullSafe(F.col("__lost_id")) & (F.unhex(F.sha2(ascii_lower(docs[text_col]), 256)) == F.col("__lost_sha"))
    single = docs.join(losers.union(again), same, "left_anti")
    row = F.struct(*[docs[c] for c in docs.columns])
    smallest = F.first if any("map<" in kind for _, kind in docs.dtypes) else F.min  # maps have no order
    one = docs.join(again, same).groupBy("__lost_id", "__lost_sha").agg(smallest(row).alias("__row")).select("__row.*")
    return single.unionByName(one)
