"""Series read from files: folders of wide CSV files (S4, S6) and of JSON-lines entries.

Thousands of files are one plan. A line is known by its file, the first byte of its split
(``_metadata.file_block_start``) and a number that grows inside the split, which together give file order without
reading any file in one piece. Wide files differ in their headers: each header is one row of a small table, cells carry their
column's position, and the two are joined. Entry files are parsed once into a written table; the entries' positions are
prefix sums over its splits, counted before malformed lines are put aside.
"""
from __future__ import annotations

import re
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.calendar import parse_dates
from ..functions.ids import make_id
from ..params import DEFAULT, WIDE_FOLDERS
from ..plans.sequence import number_rows
from ..schemas import HEADER_FIELDS
from .wide import infer_granularity, select_collections

# Spellings of a missing cell in a CSV file (besides an empty one).
MISSING = ("#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
           "NULL", "NaN", "None", "n/a", "nan", "null")
INTEGER = r"^ *[+-]?[0-9]{1,18} *$"
NUMBER = r"^ *[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI]nf(inity)?) *$"
# A comma outside of quotes.
COMMA = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def _meta(name: str) -> Column:
    return F.col(f"_metadata.{name}")


def _below(root: str, file: Column) -> Column:
    """The part of a file's name below ``root``, percent-decoded."""
    base = quote(re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", root).rstrip("/"), safe="/:@!$&'()*+,;=~") + "/"
    return F.url_decode(F.replace(F.substring_index(file, base, -1), F.lit("+"), F.lit("%2B")))


def list_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(file, path) of the files below ``root`` whose name fits ``pattern``, empty ones too.

    ``file`` is the name that Spark's readers report, ``path`` the part below ``root``. The names come from the reader's own
    file index, which the driver holds anyway; no content is read.
    """
    index = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root).inputFiles()
    return spark.createDataFrame([(re.sub("^file:/+", "file:/", f),) for f in index], "file string").select("file", _below(root, F.col("file")).alias("path"))


def _lines(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """Non-blank lines below ``root``: file, block, line_no (grows inside a block without gaps), line."""
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root)
    text = text.select(_meta("file_path").alias("file"), _meta("file_block_start").alias("block"), F.col("value").alias("line"))
    return text.filter(F.trim(F.regexp_replace("line", "^﻿", "")) != "").withColumn("line_no", F.monotonically_increasing_id())


# ---------------------------------------------------------------------------
# Wide CSV files
# ---------------------------------------------------------------------------

def wide_headers(spark: SparkSession, root: str, files: list[str]) -> DataFrame:
    """(file, names): the fields of the first line of each file, unquoted; empty and repeated names as data frames name them."""
    first = _lines(spark, root, "*.csv").filter(F.col("file").isin(files) & (F.col("block") == 0))
    first = first.groupBy("file").agg(F.min_by("line", "line_no").alias("line"))
    raw = F.split(F.regexp_replace("line", "^﻿|\r$", ""), COMMA, -1)
    plain = F.transform(raw, lambda x: F.replace(F.regexp_replace(x, '^"(.*)"$', "$1"), F.lit('""'), F.lit('"')))
    named = F.transform(plain, lambda x, i: F.when(x == "", F.concat(F.lit("Unnamed: "), i.cast("string"))).otherwise(x))
    first = first.select("file", named.alias("n"))
    before = F.transform("n", lambda x, i: F.size(F.filter(F.slice("n", 1, i), lambda y: y == x)))
    unique = F.transform(F.arrays_zip(F.col("n"), before.alias("b")), lambda z: F.when(z["b"] > 0, F.concat(z["n"], F.lit("."), z["b"].cast("string"))).otherwise(z["n"]))
    return first.select("file", unique.alias("names"))


def wide_rows(spark: SparkSession, root: str, files: list[str], headers: DataFrame, date_col: str) -> DataFrame:
    """(file, block, line_no, ts, cells, too_long, dated) of all data lines; cells as text, as many as the file has columns."""
    width = headers.agg(F.max(F.size("names"))).first()[0] or 0
    schema = ", ".join(f"c{i} string" for i in range(width + 1))
    csv = (spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
           .option("header", True).option("escape", '"').csv(root))
    d = csv.select(_meta("file_path").alias("file"), _meta("file_block_start").alias("block"),
                   F.array(*[f"c{i}" for i in range(width + 1)]).alias("all")).filter(F.col("file").isin(files))
    d = d.withColumn("line_no", F.monotonically_increasing_id()).join(headers, "file")
    n = F.size("names")
    at = F.array_position("names", date_col)
    return d.select(
        "file", "block", "line_no", (at > 0).alias("dated"),
        F.when(at > 0, parse_dates(F.get("all", (at - 1).cast("int")))).alias("ts"),
        F.slice("all", F.lit(1), n).alias("cells"),
        F.exists(F.slice("all", n + 1, F.lit(width + 1)), lambda x: x.isNotNull()).alias("too_long"))


def _missing(cell: Column) -> Column:
    return cell.isNull() | cell.isin(*MISSING)


def wide_columns(rows: DataFrame, headers: DataFrame, date_col: str) -> DataFrame:
    """(file, at, name, dtype) of the numeric columns: every cell that is not missing is a number.

    ``int64`` if all cells are there and are whole numbers of up to 18 digits, else ``float64``. A file without lines has
    none. One aggregate over all cells, combined before its shuffle.
    """
    c = F.col("cell")
    seen = rows.select("file", F.posexplode("cells").alias("at", "cell")).groupBy("file", "at").agg(
        F.count_if(~_missing(c) & ~c.rlike(NUMBER)).alias("bad"),
        F.count_if(_missing(c) | ~c.rlike(INTEGER)).alias("inexact"))
    named = headers.select("file", F.posexplode("names").alias("at", "name")).filter(F.col("name") != date_col)
    numeric = seen.filter("bad = 0").join(named, ["file", "at"])
    return numeric.select("file", "at", "name", F.when(F.col("inexact") == 0, "int64").otherwise("float64").alias("dtype"))


def panel_from_wide_files(spark: SparkSession, root: str, folders=WIDE_FOLDERS, wanted=None, source: str = "tslib",
                          date_col: str = "date", chunk_rows: int = DEFAULT.chunk_rows
                          ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(header, panel, failures) of the wide CSV files below ``root``: one collection a file (S6), one series a numeric column.

    Lines go by parsed date (unparseable ones last), then by file order; without a ``date`` column by file order alone. ``ord``
    of the header is the column's position in its file. ``failures`` (source, collection, note) has the files without a
    header line and those with a line of more fields than the header; they give no series. Fields may be
    quoted but hold no line ends. Only the names of the chosen files reach the driver.
    """
    listing = list_files(spark, root, "*.csv")
    chosen = select_collections(listing, folders, wanted).join(listing, "path").select("file", "collection")
    chosen = spark.createDataFrame([(r["file"], r["collection"]) for r in chosen.collect()], "file string, collection string")
    files = [r["file"] for r in chosen.collect()]
    headers = wide_headers(spark, root, files)
    rows = wide_rows(spark, root, files, headers, date_col)
    too_long = rows.filter("too_long").select("file").distinct()
    failures = (chosen.join(headers, "file", "left_anti").withColumn("note", F.lit("read failed: the file has no header line"))
                .unionByName(chosen.join(too_long, "file").withColumn("note", F.lit("read failed: a line has more fields than the header"))))
    failures = failures.select(F.lit(source).alias("source"), "collection", "note")

    good = rows.join(too_long, "file", "left_anti")
    columns = wide_columns(good, headers, date_col).join(chosen, "file")
    numbered = number_rows(good.select("file", "block", "line_no", "ts", "dated", "cells"), ["file"], ["ts", "block", "line_no"], "pos", chunk_rows)
    dated = good.filter("dated").select("file", F.col("ts").alias("ts"))
    granularity = infer_granularity(dated, ["file"], "ts", n_groups=len(files))
    header = columns.join(granularity, "file", "left").join(
        headers.select("file", F.array_contains("names", date_col).alias("dated")), "file")
    header = header.select(
        "file", "at", make_id(F.lit(source), F.col("collection"), F.col("name")).alias("id"), F.lit(source).alias("source"), "collection", "name",
        "granularity", F.when(F.col("dated"), F.lit(date_col)).alias("time_column"), "dtype", F.col("at").cast("long").alias("ord"))
    cells = numbered.select("file", "pos", "ts", F.posexplode("cells").alias("at", "cell"))
    value = F.when(~_missing(F.col("cell")), F.trim("cell").cast("double"))
    panel = cells.join(header.select("file", "at", *HEADER_FIELDS), ["file", "at"]).select(
        *HEADER_FIELDS, F.col("pos").cast("long").alias("pos"), "ts", value.alias("value"))
    return header.select(*HEADER_FIELDS, "ord"), panel, failures


# ---------------------------------------------------------------------------
# JSON-lines entries
# ---------------------------------------------------------------------------

def store_entries(spark: SparkSession, root: str, path: str) -> None:
    """Parse the entry files ``<collection>/train/*.json`` below ``root`` once and write them to ``path``.

    A row for each non-blank line: collection, file, block, line_no, item_id, target, reason (NULL for a sound entry), line (of
    the others). Files may be compressed. A folder named ``x=y`` is the collection ``y``.
    """
    d = _lines(spark, root, "*.json*").filter(_below(root, F.col("file")).rlike("^[^/]+/train/[^/]+$"))
    parsed = F.from_json("line", "item_id string, target array<string>", {"allowNonNumericNumbers": "true", "mode": "PERMISSIVE"})
    d = d.withColumn("p", parsed).withColumn("t", F.transform("p.target", lambda x: F.btrim(x, F.lit('"')).try_cast("double")))  # NaN comes quoted
    unsound = F.exists(F.arrays_zip(F.col("p.target").alias("s"), "t"), lambda z: z["t"].isNull() & z["s"].isNotNull())
    reason = (F.when(F.col("t").isNotNull(), F.when(unsound, "target is not an array of numbers"))
              .when(F.get_json_object("line", "$").isNull(), "line is not JSON")
              .when(F.get_json_object("line", "$.target").isNull(), "entry has no target array")
              .otherwise("target is not an array of numbers"))
    collection = F.regexp_replace(F.split(_below(root, F.col("file")), "/")[0], "^[^=]+=", "")
    d = d.select(collection.alias("collection"), "file", "block", "line_no", F.col("p.item_id").alias("item_id"), F.col("t").alias("target"), reason.alias("reason"), "line")
    d = d.withColumns({"target": F.when(F.col("reason").isNull(), F.col("target")), "line": F.when(F.col("reason").isNotNull(), F.col("line"))})
    d.write.option("compression", "zstd").parquet(path)


def entries_from_files(spark: SparkSession, root: str, path: str) -> tuple[DataFrame, DataFrame]:
    """(entries, quarantine) of the entry files below ``root``, parsed once into a table at ``path``.

    ``entries``: collection, freq (of ``<collection>/metadata/metadata.json``, or NULL), entry_ord, item_id, target.
    ``quarantine``: collection, file, entry_ord, reason, line. ``entry_ord`` counts all entries of a collection from 0, malformed ones
    included, in order of file and line: the count of the splits before, and the place in the own split. No entry moves for it.
    """
    store_entries(spark, root, path)
    stored = spark.read.parquet(path)
    blocks = stored.groupBy("collection", "file", "block").agg(F.count("*").alias("n"), F.min("line_no").alias("first"))
    before = Window.partitionBy("collection").orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).select("file", "block", "first", "offset")
    meta = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "metadata.json").text(root, wholetext=True)
    below = _below(root, _meta("file_path"))
    freqs = meta.select(F.regexp_replace(F.split(below, "/")[0], "^[^=]+=", "").alias("collection"), F.get_json_object("value", "$.freq").alias("freq"))
    placed = stored.join(blocks, ["file", "block"]).withColumn("entry_ord", F.col("offset") + F.col("line_no") - F.col("first"))
    entries = placed.filter("reason IS NULL").join(freqs.groupBy("collection").agg(F.min("freq").alias("freq")), "collection", "left")
    return (entries.select("collection", "freq", "entry_ord", "item_id", "target"),
            placed.filter("reason IS NOT NULL").select("collection", "file", "entry_ord", "reason", "line"))
