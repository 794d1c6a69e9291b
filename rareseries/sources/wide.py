"""Wide tables -> long panel (S4, S5, S6) and granularity inference.

A wide table has an optional ``date`` column and one series per numeric
column. Rows are ordered by the parsed date (unparseable dates last), then by
file order; every series of the table shares that row position.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import epoch_micros, parse_dates
from ..functions.ids import make_id
from ..operators.profile import clean_values
from ..params import DEFAULT, WIDE_FOLDERS
from ..plans.joins import MAX_BROADCAST_ROWS
from ..plans.sequence import number_rows
from ..schemas import PANEL

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMERIC = _INTEGRAL + (T.FloatType, T.DoubleType, T.DecimalType)
_DAY_US = 86_400_000_000
_WEEKDAYS = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> dict[str, str]:
    """Numeric columns in table order with the dtype label of the source."""
    out = {}
    for f in df.schema.fields:
        if f.name in exclude or not isinstance(f.dataType, _NUMERIC):
            continue
        out[f.name] = "int64" if isinstance(f.dataType, _INTEGRAL) else "float64"
    return out


def _mod(a, b):
    """``a % b``, NULL when ``b`` is NULL or not positive (never a division error)."""
    return F.when(b > 0, a % b)


def infer_granularity(df: DataFrame, group: list[str], ts: str = "ts", n_groups: int | None = None) -> DataFrame:
    """Frequency label per group from its timestamps (all rows of the group).

    Rules: fewer than 3 rows, a NULL or a repeated timestamp -> NULL. A
    constant step -> ``D``/``nD``, ``H``/``nH``, ``min``/``nmin``, ``s``/``ns``,
    or ``W-<weekday of first>`` for 7 days. Midnight dates that are exactly
    the business days of their span -> ``B``. Midnight month ends (or month
    starts) with a constant month step of 1/3/12 -> ``M``/``Q``/``Y``. Anything
    else -> NULL. Two aggregation passes; no window over a group. A caller that knows the number of groups
    (``n_groups``) spares the second pass its shuffle: few groups' steps are broadcast to the timestamps.
    """
    t = F.col(ts)
    naive = not isinstance(df.schema[ts].dataType, T.TimestampType)
    us = epoch_micros(t.cast("timestamp_ntz") if naive else t, naive)
    day = F.floor(us / F.lit(_DAY_US))
    dow = F.dayofweek(t)  # 1 = Sunday .. 7 = Saturday
    wd = (dow + 5) % 7  # 0 = Monday .. 6 = Sunday
    # Business-day index: consecutive for consecutive Mon-Fri dates.
    bidx = F.floor((day - F.lit(4)) / 7) * 5 + F.least(F.pmod(day - F.lit(4), F.lit(7)), F.lit(5))
    midx = F.year(t) * 12 + F.month(t) - 1
    midnight = (us % F.lit(_DAY_US)) == 0
    d = df.select(*group, t.alias("_t"), us.alias("_us"), bidx.alias("_bidx"), midx.alias("_midx"),
                  wd.alias("_wd"), midnight.alias("_mid"),
                  (F.to_date(t) == F.last_day(t)).alias("_me"), (F.dayofmonth(t) == 1).alias("_ms"))
    s = d.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_n"), F.count("_t").alias("_nt"), F.count_distinct("_t").alias("_nd"),
        F.min("_us").alias("_lo"), F.max("_us").alias("_hi"),
        F.min_by("_wd", "_us").alias("_wd0"),
        F.min("_bidx").alias("_blo"), F.max("_bidx").alias("_bhi"), F.count_if(F.col("_wd") >= 5).alias("_wkend"),
        F.min("_midx").alias("_mlo"), F.max("_midx").alias("_mhi"),
        F.count_if(~F.col("_mid")).alias("_notmid"), F.count_if(~F.col("_me")).alias("_notme"),
        F.count_if(~F.col("_ms")).alias("_notms"))
    gaps = F.col("_n") - 1
    s = s.withColumn("_step", F.when(_mod(F.col("_hi") - F.col("_lo"), gaps) == 0,
                                     F.try_divide(F.col("_hi") - F.col("_lo"), gaps).cast("long"))) \
         .withColumn("_mstep", F.when(_mod(F.col("_mhi") - F.col("_mlo"), gaps) == 0,
                                      F.try_divide(F.col("_mhi") - F.col("_mlo"), gaps).cast("long")))
    # Second pass: every timestamp must sit on the grid the first pass implies.
    steps = s.select(*group, "_lo", "_step", "_mlo", "_mstep")
    if n_groups is not None and n_groups <= MAX_BROADCAST_ROWS:
        steps = F.broadcast(steps)
    off = d.join(steps, group, "inner").groupBy(*group).agg(
        F.count_if(F.coalesce(_mod(F.col("_us") - F.col("_lo"), F.col("_step")) != 0, F.lit(True)))
         .alias("_offgrid"),
        F.count_if(F.coalesce(_mod(F.col("_midx") - F.col("_mlo"), F.col("_mstep")) != 0, F.lit(True)))
         .alias("_moffgrid"))
    s = s.join(off, group, "inner")

    step = F.col("_step")
    days, hours, mins, secs = (step / _DAY_US, step / 3_600_000_000, step / 60_000_000, step / 1_000_000)

    def n_label(n, unit):
        return F.when(n == 1, F.lit(unit)).otherwise(F.concat(n.cast("long").cast("string"), F.lit(unit)))

    weekday = F.element_at(F.array(*[F.lit(w) for w in _WEEKDAYS]), (F.col("_wd0") + 1).cast("int"))
    fixed = (F.when(_mod(step, F.lit(_DAY_US)) == 0, F.when(days == 7, F.concat(F.lit("W-"), weekday))
                                          .otherwise(n_label(days, "D")))
              .when(_mod(step, F.lit(3_600_000_000)) == 0, n_label(hours, "H"))
              .when(_mod(step, F.lit(60_000_000)) == 0, n_label(mins, "min"))
              .when(_mod(step, F.lit(1_000_000)) == 0, n_label(secs, "s")))
    regular = step.isNotNull() & (step > 0) & (F.col("_offgrid") == 0)
    business = ((F.col("_notmid") == 0) & (F.col("_wkend") == 0)
                & ((F.col("_bhi") - F.col("_blo")) == gaps))
    monthly = ((F.col("_notmid") == 0) & ((F.col("_notme") == 0) | (F.col("_notms") == 0))
               & F.col("_mstep").isin(1, 3, 12) & (F.col("_moffgrid") == 0))
    mlabel = F.when(F.col("_mstep") == 1, "M").when(F.col("_mstep") == 3, "Q").otherwise("Y")
    valid = (F.col("_n") >= 3) & (F.col("_nt") == F.col("_n")) & (F.col("_nd") == F.col("_n"))
    label = (F.when(~valid, F.lit(None))
              .when(regular, fixed)
              .when(business, F.lit("B"))
              .when(monthly, mlabel))
    return s.select(*group, label.cast("string").alias("granularity"))


def panel_from_wide(df: DataFrame, collection: str, source: str = "tslib", date_col: str = "date",
                    ord_col: str | None = None, chunk_rows: int = DEFAULT.chunk_rows
                    ) -> tuple[DataFrame, DataFrame]:
    """(header, panel): one series per numeric column of a wide table.

    ``ord_col`` carries row order (ties and tables without dates); without it
    ``monotonically_increasing_id`` stands in, which follows the order of a table that was not shuffled (files have
    an order of their own: :mod:`rareseries.sources.files`). ``ord`` of the header is the column's position.
    """
    has_date = date_col in df.columns
    cols = numeric_columns(df, exclude=tuple(c for c in (date_col, ord_col) if c))
    ordc = F.col(ord_col) if ord_col else F.monotonically_increasing_id()
    d = df.select(ordc.alias("_ord"),
                  (parse_dates(date_col) if has_date else F.lit(None).cast("timestamp_ntz")).alias("_ts"),
                  *[F.col(c).cast("double").alias(c) for c in cols])
    d = number_rows(d.withColumn("_tbl", F.lit(collection)), ["_tbl"], ["_ts", "_ord"], "pos", chunk_rows)
    spark = df.sparkSession
    # The header comes from the schema, so a table without rows still lists its series.
    names = spark.createDataFrame([(c, t, df.columns.index(c)) for c, t in cols.items()], "name string, dtype string, ord long")
    header = names.select(
        make_id(F.lit(source), F.lit(collection), F.col("name")).alias("id"), F.lit(source).alias("source"),
        F.lit(collection).alias("collection"), "name", "dtype", "ord")
    if has_date:
        gran = infer_granularity(d.select("_tbl", F.col("_ts").alias("ts")), ["_tbl"], "ts", n_groups=1)
        header = header.withColumn("_tbl", F.lit(collection)).join(F.broadcast(gran), "_tbl", "left")
    else:
        header = header.withColumn("granularity", F.lit(None).cast("string"))
    header = header.select(
        "id", "source", "collection", "name", "granularity",
        F.lit(date_col if has_date else None).cast("string").alias("time_column"), "dtype", "ord")
    if not cols:
        return header, spark.createDataFrame([], PANEL)
    long = clean_values(d.unpivot(["pos", "_ts"], list(cols), "name", "value"))
    # One row per column of the table: a schema-sized broadcast.
    panel = long.join(F.broadcast(header.drop("ord")), "name", "inner").select(
        "id", "source", "collection", "name", "granularity", "time_column", "dtype",
        F.col("pos").cast("long").alias("pos"), F.col("_ts").alias("ts"), "value")
    return header, panel


def select_collections(files: DataFrame, folders=WIDE_FOLDERS, wanted=None, path_col: str = "path"
                       ) -> DataFrame:
    """Pick one CSV per collection from a listing of file paths.

    Keeps ``*.csv`` directly or deeper under an in-scope top folder; the
    collection is the file stem; optional ``wanted`` subset; the first path
    (lexicographically) wins per collection.
    """
    p = F.col(path_col)
    top = F.regexp_extract(p, r"^/*([^/]+)/", 1)
    stem = F.regexp_extract(p, r"([^/]+)\.csv$", 1)
    f = files.select(p.alias("path"), top.alias("folder"), stem.alias("collection")).filter(
        F.col("path").endswith(".csv") & F.col("folder").isin(*folders))
    if wanted:
        f = f.filter(F.col("collection").isin(*wanted))
    return f.groupBy("collection").agg(F.min("path").alias("path"), F.min_by("folder", "path").alias("folder")) \
        .select("path", "folder", "collection")
