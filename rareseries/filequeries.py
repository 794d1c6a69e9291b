"""Queries over files: wide CSV and JSON-lines files are written from the given tables, then read like any other."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.batch import scan_batch
from .operators.increment import limit_new
from .oracle import GARBLED, KEYLESS, TARGETLESS, WORDY
from .schemas import internal
from .session import ensure_checkpoint_dir
from .sources.entries import entry_header, entry_points
from .sources.files import entries_from_files, panel_from_wide_files
from .sources.tables import read_table


def new_folder(spark: SparkSession, kind: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def write_file(lines: DataFrame, path: str) -> None:
    """Write the column ``value`` of a small table as the lines of one file, ordered by its other columns."""
    spark = lines.sparkSession
    folder = f"{path}-parts"
    order = [c for c in lines.columns if c != "value"]
    (lines.repartition(1).sortWithinPartitions(*order) if order else lines.repartition(1)).select("value").write.text(folder)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = [s.getPath() for s in fs.listStatus(hadoop.Path(folder)) if s.getPath().getName().startswith("part-")]
    if parts:
        fs.rename(parts[0], hadoop.Path(path))
    else:
        fs.create(hadoop.Path(path)).close()
    fs.delete(hadoop.Path(folder), True)


def csv_lines(df: DataFrame, order: list[str], end: list[str] = ()) -> DataFrame:
    """(part, key, value): the header, the rows by the SQL expressions ``order``, and the lines ``end``; NULL is an empty field."""
    key = F.struct(*[F.expr(x).alias(f"k{i}") for i, x in enumerate(order)])
    row = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    body = df.select(F.lit(1).alias("part"), key.alias("key"), row.alias("value"))
    rest = df.sparkSession.createDataFrame([(0, ",".join(df.columns)), *[(2, x) for x in end]], "part int, value string")
    return body.unionByName(rest, allowMissingColumns=True)


def daily(spark: SparkSession, root: str) -> DataFrame:
    """Lineitem by day: the date without padding, a text column, whole numbers, and a revenue that is missing on some days."""
    d = read_table(spark, root, "lineitem").groupBy(F.to_date("l_shipdate").alias("d")).agg(
        F.sum("l_quantity").cast("long").alias("qty"), F.count("*").alias("n_lines"), F.round(F.sum("l_extendedprice"), 2).alias("sum"))
    revenue = F.when(F.dayofmonth("d") % 7 != 3, F.col("sum"))
    return d.select(F.date_format("d", "yyyy-M-d").alias("date"), "qty", F.date_format("d", "EEE").alias("weekday"), revenue.alias("revenue"), "n_lines")


def hourly(spark: SparkSession, root: str) -> DataFrame:
    """Events by hour, largest hours first in the file."""
    e = read_table(spark, root, "events").groupBy(F.date_trunc("hour", "ts").alias("h")).agg(
        F.count("*").alias("n"), F.max("value").alias("top"), F.min("value").alias("low"))
    return e.select("n", "top", F.date_format("h", "yyyy-MM-dd HH:mm:ss").alias("date"), "low")


def by_quantity(spark: SparkSession, root: str) -> DataFrame:
    """Lineitem by quantity: a table without dates."""
    return read_table(spark, root, "lineitem").groupBy(F.col("l_quantity").cast("long").alias("quantity")).agg(
        F.max("l_extendedprice").alias("dearest"), F.count("*").alias("n")).select("dearest", "n", "quantity")


def write_wide_files(spark: SparkSession, root: str) -> str:
    """A folder of wide files as a source publishes them: differing headers, unordered dates, duplicates, broken files."""
    folder = new_folder(spark, "wide")
    days, hours = daily(spark, root), hourly(spark, root)
    undated = by_quantity(spark, root)
    files = {
        "weather/daily lines.csv": csv_lines(days, ["-n_lines", "date"]),
        "electricity/events.csv": csv_lines(hours, ["-n", "date"]),
        "exchange_rate/deep/quantities.csv": csv_lines(undated, ["-n", "quantity"]),
        "weather/events.csv": csv_lines(hours.limit(0).select("n"), ["n"], ["1", "2"]),  # a later path of the same collection
        "traffic/broken.csv": csv_lines(undated.limit(3), ["quantity"], ["1,2,3,4"]),
        "illness/empty.csv": spark.createDataFrame([], "value string"),
        "illness/heads_only.csv": csv_lines(undated.limit(0), ["quantity"]),
        "elsewhere/ignored.csv": csv_lines(undated.limit(3), ["quantity"]),
        "weather/readme.txt": csv_lines(undated.limit(3), ["quantity"]),
    }
    for path, lines in files.items():
        write_file(lines, f"{folder}/{path}")
    return folder


def q_scan_wide_files(spark, root):
    """Scan rows of every series of the folder, with one error row for each file that cannot be read."""
    from .queries import rounded
    header, panel, failures = panel_from_wide_files(spark, write_wide_files(spark, root))
    return rounded(internal(scan_batch(header, panel, failures=failures)))


def q_panel_wide_files(spark, root):
    """Every point of the folder's series, in file order where dates tie or are not given."""
    _, panel, _ = panel_from_wide_files(spark, write_wide_files(spark, root))
    return panel.select("id", "name", "granularity", "time_column", "dtype", "pos", "ts", "value")


def q_limit_wide_files(spark, root):
    """R4 on wide files: the first two new series of each file, in column order."""
    header, _, _ = panel_from_wide_files(spark, write_wide_files(spark, root))
    return limit_new(header, 2).select("id", "collection", "name", "ord")


def write_entry_files(spark: SparkSession, root: str) -> str:
    """One folder of JSON lines for each embedding label, in vec_id order over several files, some entries broken."""
    folder = new_folder(spark, "entries")
    v = F.col("vec_id")
    target = F.to_json(F.col("embedding").cast("array<double>"))
    line = (F.when(v % GARBLED == 5, F.concat(F.lit('{"item_id": '), v.cast("string"), F.lit(', "target": [1.0, ')))
             .when(v % TARGETLESS == 5, F.concat(F.lit('{"item_id": '), v.cast("string"), F.lit(', "start": "1990-01-01"}')))
             .when(v % WORDY == 5, F.concat(F.lit('{"target": ["a", 1], "item_id": "'), v.cast("string"), F.lit('"}')))
             .when(v % KEYLESS == 0, F.concat(F.lit('{"start": "1990-01-01", "item_id": null, "target": '), target, F.lit("}")))
             .otherwise(F.concat(F.lit('{"target": '), target, F.lit(', "item_id": '), v.cast("string"), F.lit("}"))))
    d = read_table(spark, root, "embeddings").select(F.concat(F.lit("emb"), F.col("label").cast("string")).alias("collection"), "vec_id", line.alias("value"))
    d = d.repartitionByRange(6, "vec_id").sortWithinPartitions("collection", "vec_id").select("collection", F.lit("train").alias("part"), "value")
    d.write.partitionBy("collection", "part").text(f"{folder}/parts")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for s in fs.listStatus(hadoop.Path(f"{folder}/parts")):
        name = s.getPath().getName()
        if name.startswith("collection="):
            base = f"{folder}/files/{name.removeprefix('collection=')}"
            fs.mkdirs(hadoop.Path(base))
            fs.rename(hadoop.Path(f"{folder}/parts/{name}/part=train"), hadoop.Path(f"{base}/train"))
            for part in fs.listStatus(hadoop.Path(f"{base}/train")):
                fs.rename(part.getPath(), hadoop.Path(f"{base}/train/{part.getPath().getName().removesuffix('.txt')}.json"))
            write_file(spark.createDataFrame([('{"freq": "H",',), ('  "target": [{"name": "target"}]}',)], "value string"), f"{base}/metadata/metadata.json")
    return f"{folder}/files"


def q_entries_from_files(spark, root):
    """Entries read from files and those put aside, each with its position: key, number of values, their sum, or the reason."""
    from .queries import sig
    entries, quarantine = entries_from_files(spark, write_entry_files(spark, root), new_folder(spark, "entry-table"))
    header = entry_header(entries, F.col("collection"), F.col("freq"))
    points = entry_points(entries, F.col("collection"), F.col("freq"), with_ord=True)
    sums = points.groupBy("id", "ord").agg(F.count("*").alias("n_values"), F.sum("value").alias("total"))
    good = header.join(sums, ["id", "ord"], "left").select("collection", F.col("ord").alias("entry_ord"), "id", "granularity", F.coalesce("n_values", F.lit(0)).alias("n_values"),
                                                  sig(F.col("total")).alias("total"), F.lit(None).cast("string").alias("reason"))
    none = F.lit(None)
    bad = quarantine.select("collection", "entry_ord", none.cast("string").alias("id"), none.cast("string").alias("granularity"),
                            none.cast("long").alias("n_values"), none.cast("double").alias("total"), "reason")
    return good.unionByName(bad)


FILE_QUERIES = {"scan_wide_files": q_scan_wide_files, "panel_wide_files": q_panel_wide_files,
                "limit_wide_files": q_limit_wide_files, "entries_from_files": q_entries_from_files}
