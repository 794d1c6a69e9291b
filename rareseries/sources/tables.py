"""Readers for stored tables and the panels derived from the given tables.

``read_table`` is a plain Parquet scan (projection and filters reach the
scan). The table panels turn a fact table into one series per key, ordered by
a timestamp plus tie-breakers; the order is total, so positions are
deterministic.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import make_id
from ..operators.profile import clean_values
from ..params import DEFAULT
from ..plans.sequence import number_rows
from ..schemas import SCAN

TABLE_SOURCE = "tables"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


@dataclass(frozen=True)
class TablePanel:
    """One series per ``key`` of ``table``; ``value_sql`` runs in Spark SQL and DuckDB alike."""

    collection: str
    table: str
    key: str
    order: tuple[str, ...]
    value_sql: str
    where_sql: str | None = None

    @property
    def time_column(self) -> str:
        return self.order[0]


TABLE_PANELS = {
    "events": TablePanel("events", "events", "user_id", ("ts", "event_id"), "value"),
    "events_gaps": TablePanel("events_gaps", "events", "user_id", ("ts", "event_id"),
                              "CASE WHEN event_type = 'error' THEN NULL ELSE value END"),
    "orders": TablePanel("orders", "orders", "o_custkey", ("o_orderdate", "o_orderkey"), "o_totalprice"),
    # (orderkey, linenumber) is not unique in the generated tables: the part and
    # the price complete the order key.
    "lineitem": TablePanel("lineitem", "lineitem", "l_suppkey",
                           ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"),
                           "l_extendedprice"),
    # Few, very long series: each event type holds about a fifth of all events.
    "event_types": TablePanel("event_types", "events", "event_type", ("ts", "event_id"), "value"),
}


def table_panel(spark: SparkSession, root: str, spec: TablePanel, chunk_rows: int = DEFAULT.chunk_rows
                ) -> tuple[DataFrame, DataFrame]:
    """(header, panel) for a :class:`TablePanel`."""
    src = read_table(spark, root, spec.table)
    if spec.where_sql:
        src = src.filter(F.expr(spec.where_sql))
    d = src.select(F.col(spec.key).cast("string").alias("name"), *spec.order,
                   F.expr(spec.value_sql).cast("double").alias("value"))
    d = clean_values(d).withColumn("id", make_id(F.lit(TABLE_SOURCE), F.lit(spec.collection), F.col("name")))
    # Numbered per id, so the scoring windows (also per id) reuse this shuffle.
    d = number_rows(d, ["id"], list(spec.order), "pos", chunk_rows)
    head = [
        F.col("id"), F.lit(TABLE_SOURCE).alias("source"), F.lit(spec.collection).alias("collection"), F.col("name"),
        F.lit(None).cast("string").alias("granularity"), F.lit(spec.time_column).alias("time_column"),
        F.lit("float64").alias("dtype"),
    ]
    panel = d.select(*head, F.col("pos"), F.col(spec.time_column).cast("timestamp_ntz").alias("ts"), "value")
    header = src.select(F.col(spec.key).cast("string").alias("name")).distinct().withColumn(
        "id", make_id(F.lit(TABLE_SOURCE), F.lit(spec.collection), F.col("name"))).select(
        *head, F.lit(None).cast("long").alias("ord"))
    return header, panel


def read_scan_results(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Scan results written by :func:`rareseries.operators.increment.append_scan`.

    CSV is read with the fixed schema (no inference; blanks become NULL, and
    the ``%Rare`` header maps onto ``pct_rare`` by position).
    """
    if fmt == "csv":
        return spark.read.schema(SCAN).option("header", True).option("enforceSchema", True).csv(path)
    return spark.read.schema(SCAN).parquet(path)
