"""Catalog analytics, profile and drift.

A profile is a long DataFrame ``(path, value)`` with dotted paths such as
``source.gluonts`` or ``numeric.IR.50%`` and values rendered as JSON
scalars, so two profiles compare with one full outer join. JSON is only used
at the edge (reading/writing a stored profile, which is a few hundred rows).
"""
from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import COLLECTION_EXAMPLES, DEFAULT, NULL_BUCKET, PROFILE_NUMERIC_ROUND
from ..plans.quantiles import exact_quantiles
from ..session import written

STATS = (("min", 0.0), ("25%", 0.25), ("50%", 0.5), ("75%", 0.75), ("max", 1.0))


def _c(x) -> Column:
    return F.col(f"`{x}`") if isinstance(x, str) else x


def catalog_filter(catalog: DataFrame, levels=None, sources=None, collections=None, granularity=None,
                   min_length=None, max_missing=None, max_pct_rare=None) -> DataFrame:
    """A1: the usual predicate filters over catalog columns (all optional, AND-ed)."""
    conds = []
    if levels:
        conds.append(F.col("imbalance_level").isin(*levels))
    if sources:
        conds.append(F.col("source").isin(*sources))
    if collections:
        conds.append(F.col("collection").isin(*collections))
    if granularity is not None:
        conds.append(F.col("granularity") == granularity)
    if min_length is not None:
        conds.append(F.col("length") >= min_length)
    if max_missing is not None:
        conds.append(F.col("missing_pct") <= max_missing)
    if max_pct_rare is not None:
        conds.append(F.col("pct_rare") < max_pct_rare)
    return catalog.filter(reduce(lambda a, b: a & b, conds)) if conds else catalog


def top_k(df: DataFrame, by: str, n: int, ascending: bool = True, cols=None) -> DataFrame:
    """A2: sort + head; planned as a per-task top-n and one final merge."""
    order = [F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last(), F.col("id")]
    out = df.orderBy(*order).limit(n)
    return out.select(*cols) if cols else out


def value_counts(df: DataFrame, col: str, null_bucket: str | None = None) -> DataFrame:
    """A3: ``(value, n)``; NULL dropped unless it is bucketed under ``null_bucket``."""
    c = _c(col).cast("string")
    if null_bucket is not None:
        c = F.coalesce(c, F.lit(null_bucket))
    out = df.select(c.alias("value")).filter(F.col("value").isNotNull())
    return out.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def first_value_by_group(df: DataFrame, group: str, col: str, order: str = "ord") -> DataFrame:
    """A4: first non-null ``col`` per ``group`` in ``order`` (NULL when there is none)."""
    v = _c(col)
    return df.groupBy(group).agg(F.min_by(v, F.when(v.isNotNull(), F.col(order))).alias(col))


def count_distinct(df: DataFrame, col: str) -> DataFrame:
    """A5: number of distinct non-null values (a two-phase aggregate)."""
    return df.select(_c(col)).distinct().agg(F.count(_c(col)).alias("n"))


def example_counts(df: DataFrame, names=COLLECTION_EXAMPLES, col: str = "collection") -> DataFrame:
    """Rows per listed value, 0 when absent."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([(n,) for n in names], "value string")
    counts = value_counts(df, col)
    return wanted.join(F.broadcast(counts.join(F.broadcast(wanted), "value", "left_semi")), "value", "left") \
        .select("value", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def _column_quantiles(df: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """(field, one column a statistic) and (field, number of NULLs) from one aggregate over all columns.

    Its buffers hold the distinct values of each column, so it is for tables of up to ``chunk_rows`` rows.
    """
    probs = F.array(*[F.lit(p) for _, p in STATS])
    v = [F.col(f"`{c}`").cast("double") for c in cols]
    one = df.agg(F.array(*[F.struct(F.lit(c).alias("field"), F.percentile(x, probs).alias("q"), F.count_if(x.isNull()).alias("_n")) for c, x in zip(cols, v)]).alias("_e"))
    one = one.select(F.explode("_e").alias("_e")).select("_e.*")
    return one.filter(F.col("q").isNotNull()).select("field", *[F.col("q")[i].alias(f"_s{i}") for i in range(len(STATS))]), one.select("field", "_n")


def numeric_profile(df: DataFrame, cols=None, chunk_rows: int = DEFAULT.chunk_rows, n_rows: int | None = None) -> DataFrame:
    """Exact min/25%/50%/75%/max of the non-null values of each column, rounded per column,
    plus ``null_count`` when some are NULL. Output ``(field, stat, value)``.

    A table of up to ``chunk_rows`` rows (``n_rows``, counted if not given) is one aggregate over all columns. A
    longer one goes through :func:`exact_quantiles` with the column name as the key, without one task holding a column.
    """
    cols = cols or list(PROFILE_NUMERIC_ROUND)
    present = [c for c in cols if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "field string, stat string, value string")
    if (df.count() if n_rows is None else n_rows) <= chunk_rows:
        q, missing = _column_quantiles(df, present)
    else:
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("field"), _c(c).cast("double").alias("v")) for c in present])).alias("_e")
        ).select("_e.field", "_e.v")
        q = exact_quantiles(long, [p for _, p in STATS], [f"_s{i}" for i in range(len(STATS))], key="field",
                            val="v", chunk_rows=chunk_rows)
        missing = long.groupBy("field").agg(F.count_if(F.col("v").isNull()).alias("_n"))
    stats = q.select("field", F.explode(F.array(*[
        F.struct(F.lit(name).alias("stat"), F.col(f"_s{i}").alias("_v")) for i, (name, _) in enumerate(STATS)]))
        .alias("_e")).select("field", "_e.stat", "_e._v")
    dp = F.coalesce(*[F.when(F.col("field") == c, F.lit(PROFILE_NUMERIC_ROUND.get(c, 6))) for c in present], F.lit(6))
    rendered = stats.withColumn("_dp", dp)
    value = F.when(F.col("_dp") == 0, F.bround(F.col("_v"), 0).cast("long").cast("string"))
    for d in sorted({v for v in PROFILE_NUMERIC_ROUND.values() if v}):
        value = value.when(F.col("_dp") == d, F.bround(F.col("_v"), d).cast("string"))
    rendered = rendered.select("field", "stat", value.alias("value"))
    nulls = missing.filter(F.col("_n") > 0).select("field", F.lit("null_count").alias("stat"), F.col("_n").cast("string").alias("value"))
    return rendered.unionByName(nulls)


def _json_string(c: Column) -> Column:
    """A string as a JSON scalar (quoted, escaped); NULL as ``null``."""
    escaped = F.regexp_replace(c, r'(["\\])', r"\\$1")
    return F.when(c.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), escaped, F.lit('"')))


#: Columns whose values a profile counts, and the one that it looks for examples in.
COUNTED, EXAMPLED = ("source", "license", "imbalance_level", "dtype", "granularity"), "collection"


def profile_counts(catalog: DataFrame, order: str = "id") -> DataFrame:
    """``(section, value, n, first)``: rows by value of each counted column, of the examples' column, and in all (no section).

    One scan, expanded to the grouping sets, and one aggregate that combines before its shuffle. ``first`` is the first
    non-null ``time_column`` of the group in ``order``. A NULL granularity has a bucket of its own.
    """
    cols = [*COUNTED, EXAMPLED]
    view = catalog.select(*[F.coalesce(F.col(c), F.lit(NULL_BUCKET)).alias(c) if c == "granularity" else F.col(c).cast("string").alias(c) for c in cols],
                          "time_column", F.col(order).alias("_order"))
    first = F.min_by("time_column", F.when(F.col("time_column").isNotNull(), F.col("_order")))
    sets = view.groupingSets([[F.col(c)] for c in cols] + [[]], *cols).agg(F.count(F.lit(1)).alias("n"), first.alias("first"), F.grouping_id().alias("_set"))
    all_sets = (1 << len(cols)) - 1
    mine = [F.col("_set") == all_sets - (1 << (len(cols) - 1 - i)) for i in range(len(cols))]
    section = F.coalesce(*[F.when(is_set, F.lit(c)) for c, is_set in zip(cols, mine)])
    value = F.coalesce(*[F.when(is_set, F.col(c)) for c, is_set in zip(cols, mine)])
    return sets.select(section.alias("section"), value.alias("value"), "n", "first")


def profile_catalog(catalog: DataFrame, order: str = "id", examples=COLLECTION_EXAMPLES) -> DataFrame:
    """The whole profile as ``(path, value)``.

    ``order`` decides which value is "first" per source (the published catalog
    is sorted by id). The catalog is read for its counts, and for the quantiles of its numbers.
    """
    counts = written(profile_counts(catalog, order))  # one row a distinct value; the number of rows decides the form of the quantiles
    total = counts.filter("section IS NULL").first()
    n_rows = total["n"] if total else 0
    known = counts.filter("value IS NOT NULL")
    wanted = catalog.sparkSession.createDataFrame([(n,) for n in examples], "value string")
    found = wanted.join(known.filter(F.col("section") == EXAMPLED), "value", "left")
    text = F.col("n").cast("string").alias("value")
    parts = [
        catalog.sparkSession.createDataFrame([("row_count", str(n_rows))], "path string, value string"),
        known.filter(F.col("section") != EXAMPLED).select(F.concat_ws(".", "section", "value").alias("path"), text),
        known.filter("section = 'source'").select(F.concat(F.lit("time_column_by_source."), F.col("value")).alias("path"), _json_string(F.col("first")).alias("value")),
        known.agg(F.count_if(F.col("section") == EXAMPLED).cast("string").alias("value")).select(F.lit("collection_count_distinct").alias("path"), "value"),
        found.select(F.concat(F.lit("collection_examples."), F.col("value")).alias("path"), F.coalesce("n", F.lit(0)).cast("string").alias("value")),
        numeric_profile(catalog, n_rows=n_rows).select(F.concat_ws(".", F.lit("numeric"), "field", "stat").alias("path"), "value"),
    ]
    return reduce(DataFrame.unionByName, parts)


def diff_profiles(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """A10: drift rows ``(path, kind, expected, actual)`` sorted by path.

    Values that are both numbers are compared as numbers: 2.0E7 is 20000000.0.
    """
    e = expected.select("path", F.col("value").alias("expected"))
    a = actual.select("path", F.col("value").alias("actual"))
    same = F.coalesce(F.col("expected").try_cast("double") == F.col("actual").try_cast("double"), F.lit(False))
    j = e.join(a, "path", "full_outer").filter(~F.col("expected").eqNullSafe(F.col("actual")) & ~same)
    kind = (F.when(F.col("expected").isNull(), "new in catalog")
             .when(F.col("actual").isNull(), "missing from catalog")
             .otherwise("changed"))
    return j.select("path", kind.alias("kind"), "expected", "actual").orderBy("path")


def _flatten(d: dict, prefix: str = "") -> list[tuple[str, str]]:
    out = []
    for k, v in d.items():
        p = f"{prefix}.{k}" if prefix else str(k)
        if isinstance(v, dict):
            out.extend(_flatten(v, p))
        elif isinstance(v, bool) or v is None or isinstance(v, str):
            out.append((p, json.dumps(v)))
        else:
            out.append((p, repr(v)))
    return out


def profile_from_json(spark: SparkSession, text: str) -> DataFrame:
    """A stored profile (nested JSON) as ``(path, value)``."""
    return spark.createDataFrame(_flatten(json.loads(text)), "path string, value string")


def profile_to_json(profile: DataFrame) -> str:
    """Nest a ``(path, value)`` profile into JSON; the profile has a few hundred rows."""
    root: dict = {}
    for row in profile.orderBy("path").collect():
        head, *rest = row["path"].split(".", 1) if not row["path"].startswith("numeric.") else \
            ["numeric", row["path"][len("numeric."):]]
        node = root
        if rest:
            if head == "numeric":
                col, stat = rest[0].rsplit(".", 1)
                node = root.setdefault("numeric", {}).setdefault(col, {})
                key = stat
            else:
                node = root.setdefault(head, {})
                key = rest[0]
        else:
            key = head
        node[key] = json.loads(row["value"])
    return json.dumps(root, indent=2, sort_keys=True) + "\n"


def check_profile(catalog: DataFrame, expected_json: str, examples=COLLECTION_EXAMPLES) -> DataFrame:
    """Drift rows of ``catalog`` against a stored profile (empty = no drift)."""
    spark = catalog.sparkSession
    return diff_profiles(profile_from_json(spark, expected_json), profile_catalog(catalog, examples=examples))


def write_profile(profile: DataFrame, path: str) -> str:
    """A11 (write): store the profile as one JSON document (a folder with one text file)."""
    spark = profile.sparkSession
    text = profile_to_json(profile)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return text


def read_profile_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())


class ProfileDrift(AssertionError):
    """Raised by :func:`assert_no_drift`; carries the whole report (``drift``), its size and the first rows."""

    def __init__(self, rows, drift=None, n=None):
        self.rows, self.drift, self.n = rows, drift, len(rows) if n is None else n
        lines = "\n".join(f"  - {r['path']}: {r['kind']} (expected={r['expected']}, actual={r['actual']})"
                          for r in rows)
        more = f"\n  - and {self.n - len(rows)} more" if self.n > len(rows) else ""
        super().__init__(f"catalog profile drifted from the stored profile:\n{lines}{more}")


def assert_no_drift(catalog: DataFrame, path: str) -> None:
    """A11 (check): fail when the catalog's profile differs from the stored one."""
    drift = check_profile(catalog, read_profile_text(catalog.sparkSession, path))
    n = drift.count()
    if n:
        raise ProfileDrift(drift.take(50), drift, n)  # the message shows the first rows; ``drift`` has them all


def describe(df: DataFrame, cols) -> DataFrame:
    """Summary statistics of heavy-tailed columns."""
    return df.select(*[_c(c) for c in cols]).summary()
