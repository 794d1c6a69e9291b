"""ANSI SQL (DuckDB dialect) equivalents of the Spark queries in :mod:`rareseries.queries`.

These are the independent cross-checks for the Spark plans: plain windows and
aggregates over the given tables, written without any of the chunking the
Spark side uses. Every double is rounded to 8 significant digits on both sides (same IEEE
steps), so summation-order noise between the engines does not reach the result.
"""
from __future__ import annotations

from .params import DEFAULT, EMPTY_HASH, SEASONAL_PERIOD, GRANULARITY_ALIASES, ScoreParams
from .sources.tables import TABLE_PANELS, TABLE_SOURCE, TablePanel

DIGITS = 8  # significant digits kept for doubles on both sides
R = DIGITS


def sig(x: str, digits: int = DIGITS) -> str:
    """Round to ``digits`` significant digits with the same IEEE steps as the Spark side.

    Powers of ten are exact (0..22); the value is multiplied or divided so no
    inexact power is used.
    """
    e = f"floor(log10(abs({x})))"
    k = f"({digits - 1} - {e})"
    return (f"(CASE WHEN ({x}) IS NULL OR isinf({x}) OR isnan({x}) OR ({x}) = 0 THEN ({x}) "
            f"WHEN {k} >= 0 THEN round(({x}) * pow(10, {k})) / pow(10, {k}) "
            f"ELSE round(({x}) / pow(10, -{k})) * pow(10, -{k}) END)")


def make_id_sql(source: str, collection: str, key: str) -> str:
    return f"replace(lower(concat_ws(':', {source}, {collection}, CAST({key} AS VARCHAR))), ' ', '-')"


def table_panel_sql(spec: TablePanel) -> str:
    key, order = spec.key, ", ".join(spec.order)
    return f"""SELECT {make_id_sql(f"'{TABLE_SOURCE}'", f"'{spec.collection}'", key)} AS id,
        '{TABLE_SOURCE}' AS source, '{spec.collection}' AS collection, CAST({key} AS VARCHAR) AS name,
        CAST(NULL AS VARCHAR) AS granularity, '{spec.time_column}' AS time_column, 'float64' AS dtype,
        ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {order}) - 1 AS pos,
        CAST({spec.time_column} AS TIMESTAMP) AS ts, CAST({spec.value_sql} AS DOUBLE) AS value
      FROM {spec.table}""" + (f" WHERE {spec.where_sql}" if spec.where_sql else "")


def _lookup_sql(col: str, table: dict, default: str) -> str:
    arms = " ".join(f"WHEN {col} = '{k}' THEN {v!r}" if isinstance(v, str) else f"WHEN {col} = '{k}' THEN {v}"
                    for k, v in table.items())
    return f"CASE {arms} ELSE {default} END"


def normalize_granularity_sql(col: str) -> str:
    return _lookup_sql(col, GRANULARITY_ALIASES, col)


def seasonal_period_sql(col: str) -> str:
    return f"CAST({_lookup_sql(col, SEASONAL_PERIOD, 'NULL')} AS BIGINT)"


# Fixed per-label frequency for the entries panel built from ``embeddings``.
# Divisors of vec_id: entries written without a key, without a target, garbled, and with a target of words.
KEYLESS, TARGETLESS, GARBLED, WORDY = 3, 7, 11, 13
ENTRY_FREQS = ("H", "1H", "h", "1B", "0.5h", "D", "W-TUE", "M", "Q", "min")


def entry_freq_sql(label: str) -> str:
    arms = " ".join(f"WHEN {label} = {i} THEN '{f}'" for i, f in enumerate(ENTRY_FREQS))
    return f"CASE {arms} END"


def entries_panel_sql() -> str:
    return f"""SELECT {make_id_sql("'gluonts'", "'emb' || CAST(label AS VARCHAR)", 'vec_id')} AS id,
        'gluonts' AS source, 'emb' || CAST(label AS VARCHAR) AS collection, CAST(vec_id AS VARCHAR) AS name,
        {entry_freq_sql('label')} AS granularity, CAST(NULL AS VARCHAR) AS time_column, 'float64' AS dtype,
        CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS pos, CAST(NULL AS TIMESTAMP) AS ts,
        CAST(unnest(embedding) AS DOUBLE) AS value
      FROM embeddings"""


def daily_wide_sql() -> str:
    return """SELECT strftime(CAST(l_shipdate AS DATE), '%Y-%-m-%-d') AS date, SUM(l_quantity) AS qty,
        COUNT(*) AS n_lines, ROUND(SUM(l_extendedprice), 2) AS revenue
      FROM lineitem GROUP BY 1"""


WIDE_COLUMNS = {"qty": "float64", "n_lines": "int64", "revenue": "float64"}


def wide_panel_sql() -> str:
    w = f"""SELECT *, CAST(CAST(date AS DATE) AS TIMESTAMP) AS ts,
                   ROW_NUMBER() OVER (ORDER BY CAST(date AS DATE)) - 1 AS pos FROM ({daily_wide_sql()})"""
    gran = f"(SELECT granularity FROM ({granularity_sql(f'SELECT 0 AS grp, ts FROM ({w})')}))"
    parts = []
    for c, dt in WIDE_COLUMNS.items():
        parts.append(f"""SELECT {make_id_sql("'tslib'", "'daily_wide'", f"'{c}'")} AS id, 'tslib' AS source,
            'daily_wide' AS collection, '{c}' AS name, {gran} AS granularity, 'date' AS time_column,
            '{dt}' AS dtype, pos, ts, CAST({c} AS DOUBLE) AS value FROM ({w})""")
    return " UNION ALL ".join(parts)


def wide_files_sql(collection: str, rows: str, order: str, columns: dict[str, tuple[str, int]], dated: bool) -> str:
    """Panel rows of one wide file: ``rows`` has ``ts`` (NULL without dates) and the columns, ``order`` is the order of its lines."""
    w = f"SELECT *, ROW_NUMBER() OVER (ORDER BY {order}) - 1 AS pos FROM ({rows})"
    gran = f"(SELECT granularity FROM ({granularity_sql(f'SELECT 0 AS grp, ts FROM ({w})')}))" if dated else "CAST(NULL AS VARCHAR)"
    return " UNION ALL ".join(f"""SELECT {make_id_sql("'tslib'", f"'{collection}'", f"'{c}'")} AS id, 'tslib' AS source,
            '{collection}' AS collection, '{c}' AS name, {gran} AS granularity, {"'date'" if dated else "CAST(NULL AS VARCHAR)"} AS time_column,
            '{kind}' AS dtype, pos, CAST({"ts" if dated else "NULL"} AS TIMESTAMP) AS ts, CAST({c} AS DOUBLE) AS value, CAST({at} AS BIGINT) AS ord FROM ({w})"""
                              for c, (kind, at) in columns.items())


def wide_files_panel_sql() -> str:
    days = """SELECT CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS ts, SUM(l_quantity) AS qty, COUNT(*) AS n_lines,
            CASE WHEN day(CAST(l_shipdate AS DATE)) % 7 <> 3 THEN ROUND(SUM(l_extendedprice), 2) END AS revenue
          FROM lineitem GROUP BY CAST(l_shipdate AS DATE)"""
    hours = "SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, COUNT(*) AS n, MAX(value) AS top, MIN(value) AS low FROM events GROUP BY 1"
    quantities = "SELECT NULL AS ts, MAX(l_extendedprice) AS dearest, COUNT(*) AS n, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem GROUP BY 4"
    return " UNION ALL ".join([
        wide_files_sql("daily lines", days, "ts", {"qty": ("int64", 1), "revenue": ("float64", 3), "n_lines": ("int64", 4)}, True),
        wide_files_sql("events", hours, "ts", {"n": ("int64", 0), "top": ("float64", 1), "low": ("float64", 3)}, True),
        wide_files_sql("quantities", quantities, "n DESC, quantity", {"dearest": ("float64", 0), "n": ("int64", 1), "quantity": ("int64", 2)}, False)])


def scan_wide_files_sql() -> str:
    panel = f"SELECT * EXCLUDE (ord) FROM ({wide_files_panel_sql()})"
    notes = {"broken": "read failed: a line has more fields than the header", "empty": "read failed: the file has no header line"}
    errors = " UNION ALL ".join(f"SELECT 'tslib:{c}:dataset' AS id, 'tslib' AS source, '{c}' AS collection, 'error' AS status, '{n}' AS note" for c, n in notes.items())
    return f"SELECT * FROM ({with_hash_sql(scan_rows_sql(panel), panel)}) UNION ALL BY NAME ({errors})"


def limit_wide_files_sql() -> str:
    return f"""SELECT id, collection, name, ord FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY collection ORDER BY ord) AS rn
        FROM (SELECT DISTINCT id, collection, name, ord FROM ({wide_files_panel_sql()}))) WHERE rn <= 2"""


def entries_from_files_sql() -> str:
    reason = f"""CASE WHEN vec_id % {GARBLED} = 5 THEN 'line is not JSON' WHEN vec_id % {TARGETLESS} = 5 THEN 'entry has no target array'
        WHEN vec_id % {WORDY} = 5 THEN 'target is not an array of numbers' END"""
    return f"""WITH e AS (SELECT *, 'emb' || CAST(label AS VARCHAR) AS collection, ROW_NUMBER() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS entry_ord,
                     {reason} AS reason FROM embeddings),
        k AS (SELECT *, CASE WHEN vec_id % {KEYLESS} = 0 THEN entry_ord ELSE vec_id END AS key FROM e),
        v AS (SELECT collection, entry_ord, COUNT(*) AS n_values, SUM(CAST(x AS DOUBLE)) AS total FROM (SELECT collection, entry_ord, unnest(embedding) AS x FROM k) GROUP BY 1, 2)
      SELECT k.collection, k.entry_ord, CASE WHEN reason IS NULL THEN {make_id_sql("'gluonts'", 'k.collection', 'key')} END AS id,
             CASE WHEN reason IS NULL THEN 'H' END AS granularity, CASE WHEN reason IS NULL THEN COALESCE(n_values, 0) END AS n_values,
             CASE WHEN reason IS NULL THEN {sig('total')} END AS total, reason
      FROM k LEFT JOIN v ON v.collection = k.collection AND v.entry_ord = k.entry_ord"""


def panel_sql(name: str) -> str:
    if name in TABLE_PANELS:
        return table_panel_sql(TABLE_PANELS[name])
    if name == "entries":
        return entries_panel_sql()
    if name == "wide":
        return wide_panel_sql()
    raise KeyError(name)


def phi_sql(p: ScoreParams = DEFAULT) -> str:
    t_hi = "LEAST(GREATEST((y - med) / NULLIF(hw - med, 0), 0.0), 1.0)"
    t_lo = "LEAST(GREATEST((med - y) / NULLIF(med - lw, 0), 0.0), 1.0)"
    return f"""CASE WHEN hi_on AND y > med THEN
                 CASE WHEN hw > med THEN 3.0 * {t_hi} * {t_hi} - 2.0 * {t_hi} * {t_hi} * {t_hi} ELSE 1.0 END
               WHEN lo_on AND y < med THEN
                 CASE WHEN lw < med THEN 3.0 * {t_lo} * {t_lo} - 2.0 * {t_lo} * {t_lo} * {t_lo} ELSE 1.0 END
               ELSE 0.0 END"""


def scoring_ctes(panel: str, p: ScoreParams = DEFAULT) -> str:
    """CTEs ``panel, clean, base, ac, tg, q, f, cp, ph, sc`` over a panel query."""
    hi_ok = "TRUE" if p.rel_xtrm_type in ("both", "high") else "FALSE"
    lo_ok = "TRUE" if p.rel_xtrm_type in ("both", "low") else "FALSE"
    return f"""panel AS ({panel}),
      clean AS (SELECT id, pos, value, ROW_NUMBER() OVER (PARTITION BY id ORDER BY pos) - 1 AS cpos,
                       LAG(value) OVER (PARTITION BY id ORDER BY pos) AS prev
                FROM panel WHERE value IS NOT NULL),
      base AS (SELECT id, COUNT(*) AS length, COUNT(value) AS n_obs,
                      COUNT(*) FILTER (WHERE value IS NULL) AS n_missing,
                      AVG(value) AS mean, STDDEV_SAMP(value) AS std,
                      SKEWNESS(value) AS skew, KURTOSIS(value) AS kurt
               FROM panel GROUP BY id),
      ac AS (SELECT id, CASE WHEN STDDEV_POP(value) > 0 AND STDDEV_POP(prev) > 0 THEN
                  GREATEST(LEAST(COVAR_POP(value, prev) / (STDDEV_POP(value) * STDDEV_POP(prev)), 1.0), -1.0)
                  END AS autocorr_lag1
             FROM clean WHERE prev IS NOT NULL GROUP BY id),
      tg AS (SELECT id, cpos, value AS y FROM clean WHERE cpos >= {p.k}),
      q AS (SELECT id, COUNT(*) AS N, QUANTILE_CONT(y, 0.25) AS q1, QUANTILE_CONT(y, 0.5) AS med,
                   QUANTILE_CONT(y, 0.75) AS q3 FROM tg GROUP BY id),
      f AS (SELECT id, N, q1, med, q3, q1 - {p.rel_coef} * (q3 - q1) AS lf, q3 + {p.rel_coef} * (q3 - q1) AS uf
            FROM q),
      cp AS (SELECT tg.id, MAX(y) FILTER (WHERE y <= uf) AS hw, MIN(y) FILTER (WHERE y >= lf) AS lw,
                    (COUNT(*) FILTER (WHERE y > uf) > 0) AND {hi_ok} AS hi_on,
                    (COUNT(*) FILTER (WHERE y < lf) > 0) AND {lo_ok} AS lo_on
             FROM tg JOIN f ON tg.id = f.id GROUP BY tg.id),
      ph AS (SELECT tg.id, tg.cpos, tg.y, f.med, cp.hw, cp.lw, cp.hi_on, cp.lo_on, {phi_sql(p)} AS phi
             FROM tg JOIN f ON tg.id = f.id JOIN cp ON tg.id = cp.id),
      sc AS (SELECT id, COUNT(*) AS N, COUNT(*) FILTER (WHERE phi >= {p.rel_thres}) AS n_rare
             FROM ph GROUP BY id)"""


def level_sql(n_rare: str, pct: str) -> str:
    return f"""CASE WHEN {n_rare} IS NULL THEN NULL WHEN {n_rare} = 0 THEN 'none'
                 WHEN {pct} < 1 THEN 'extreme' WHEN {pct} < 5 THEN 'severe'
                 WHEN {pct} < 15 THEN 'moderate' ELSE 'mild' END"""


def scan_rows_sql(panel: str, p: ScoreParams = DEFAULT) -> str:
    """24-column scan rows without ``content_hash`` (its own query has it)."""
    k2 = p.min_points
    ok = f"(COALESCE(b.n_obs, 0) >= {k2})"
    pct = "100.0 * (sc.n_rare / sc.N)"
    return f"""WITH {scoring_ctes(panel, p)},
      header AS (SELECT DISTINCT id, source, collection, name, granularity, time_column, dtype FROM panel)
    SELECT h.id, h.source, h.collection, h.name, h.granularity, h.time_column,
           CAST(COALESCE(b.length, 0) AS BIGINT) AS length, h.dtype,
           CASE WHEN {ok} THEN sc.N END AS N,
           CASE WHEN {ok} THEN sc.N - sc.n_rare END AS n_normal,
           CASE WHEN {ok} THEN sc.n_rare END AS n_rare,
           CASE WHEN {ok} THEN CASE WHEN sc.n_rare = 0 THEN 'inf'::DOUBLE
                ELSE {sig('(sc.N - sc.n_rare) / sc.n_rare')} END END AS IR,
           CASE WHEN {ok} THEN {sig(pct)} END AS pct_rare,
           CASE WHEN {ok} THEN {level_sql('sc.n_rare', pct)} END AS imbalance_level,
           ROUND(100.0 * (b.n_missing / b.length), 4) AS missing_pct,
           CASE WHEN {ok} THEN {sig('b.mean')} END AS mean,
           CASE WHEN {ok} THEN {sig('b.std')} END AS std,
           CASE WHEN {ok} AND ABS(b.mean) > 1e-12 THEN {sig('b.std / ABS(b.mean)')} END AS cv,
           CASE WHEN {ok} THEN {sig('COALESCE(b.skew, 0.0)')} END AS skewness,
           CASE WHEN {ok} THEN {sig('COALESCE(b.kurt, 0.0)')} END AS kurtosis,
           CASE WHEN {ok} THEN {sig('ac.autocorr_lag1')} END AS autocorr_lag1,
           CASE WHEN {ok} THEN 'ok' ELSE 'skipped_short' END AS status,
           CASE WHEN {ok} THEN NULL ELSE 'only ' || CAST(COALESCE(b.n_obs, 0) AS VARCHAR)
                || ' non-null values, need >= {k2} to embed' END AS note
    FROM header h LEFT JOIN base b ON h.id = b.id LEFT JOIN ac ON h.id = ac.id LEFT JOIN sc ON h.id = sc.id"""


def _ctes(panel_name: str) -> str:
    return scoring_ctes(panel_sql(panel_name))


def level_counts_sql() -> str:
    return f"""WITH s AS ({scan_rows_sql(panel_sql('events'))})
      SELECT imbalance_level, COUNT(*) AS n_series FROM s WHERE status = 'ok' GROUP BY imbalance_level"""


def profile_moments_sql(name: str) -> str:
    return f"""WITH {_ctes(name)}
      SELECT id, length, n_obs, ROUND(100.0 * (n_missing / length), 4) AS missing_pct,
             {sig('mean')} AS mean, {sig('std')} AS std,
             CASE WHEN ABS(mean) > 1e-12 THEN {sig('std / ABS(mean)')} END AS cv,
             CASE WHEN n_obs >= 3 THEN {sig('COALESCE(skew, 0.0)')} END AS skewness,
             CASE WHEN n_obs >= 4 THEN {sig('COALESCE(kurt, 0.0)')} END AS kurtosis
      FROM base"""


def embedding_sql(k: int = DEFAULT.k) -> str:
    lags = ", ".join(f"LAG(value, {i}) OVER (PARTITION BY id ORDER BY cpos) AS lag_{i}" for i in range(k, 0, -1))
    return f"""WITH {_ctes('events')},
      e AS (SELECT id, cpos AS t, {lags}, value AS target FROM clean)
      SELECT * FROM e WHERE t >= {k}"""


def control_points_sql() -> str:
    return f"""WITH {_ctes('events')}
      SELECT f.id, f.N, {sig('q1')} AS q1, {sig('med')} AS median, {sig('q3')} AS q3,
             {sig('lf')} AS lower_fence, {sig('uf')} AS upper_fence,
             {sig('lw')} AS lo_adj, {sig('hw')} AS hi_adj, lo_on, hi_on
      FROM f JOIN cp ON f.id = cp.id"""


def relevance_sql() -> str:
    return f"""WITH {_ctes('events')}
      SELECT id, cpos, {sig('y')} AS y, {sig('phi')} AS phi FROM ph"""


def imbalance_scores_sql() -> str:
    pct = "100.0 * (n_rare / N)"
    return f"""WITH {_ctes('lineitem')}
      SELECT id, N, N - n_rare AS n_normal, n_rare,
             CASE WHEN n_rare = 0 THEN 'inf'::DOUBLE ELSE {sig('(N - n_rare) / n_rare')} END AS IR,
             {sig(pct)} AS pct_rare, {level_sql('n_rare', pct)} AS imbalance_level
      FROM sc"""


def autocorr_sql() -> str:
    return f"""WITH {_ctes('events_gaps')} SELECT id, {sig('autocorr_lag1')} AS autocorr_lag1 FROM ac"""



# ---------------------------------------------------------------------------
# Scan table, catalog, publish, retrieval, drift
# ---------------------------------------------------------------------------

CATALOG_RUNS = ("events_gaps", "orders", "entries", "wide")
EXAMPLES = ("events_gaps", "orders", "emb3", "daily_wide", "m4_monthly")
EARLIER_ORDERS = TablePanel("orders", "orders", "o_custkey", ("o_orderdate", "o_orderkey"), "o_totalprice",
                            "o_orderdate < TIMESTAMP '1997-01-01 00:00:00'")
PUBLISH_STAMP = ("rev-0001", "0.1.0", "2026-01-01T00:00:00+00:00")


def catalog_scan_sql(runs=CATALOG_RUNS) -> str:
    return " UNION ALL ".join(f"SELECT *, CAST({i} AS BIGINT) AS ord FROM ({scan_rows_sql(panel_sql(n))})"
                              for i, n in enumerate(runs))


def catalog_panels_sql() -> str:
    """The points of all runs."""
    return " UNION ALL ".join(f"SELECT id, pos, value FROM ({panel_sql(n)})" for n in CATALOG_RUNS)


def accepted_sql() -> str:
    return "COALESCE(status = 'ok' AND n_rare > 0, FALSE)"


def license_sql() -> str:
    return ("CASE WHEN source = 'tslib' THEN 'unknown' WHEN starts_with(collection, 'm4') THEN 'unlicensed' "
            "ELSE 'cc-by-4.0' END")


def build_series_sql(scan: str, p: ScoreParams = DEFAULT) -> str:
    g = normalize_granularity_sql("granularity")
    return f"""SELECT id, name, source, collection, {license_sql()} AS license, {g} AS granularity, time_column,
        length, dtype, CAST(NULL AS BIGINT) AS size_bytes, N, n_normal, n_rare, IR, pct_rare, imbalance_level,
        CAST({p.rel_thres} AS DOUBLE) AS rel_thres, CAST({p.rel_coef} AS DOUBLE) AS rel_coef,
        '{p.rel_xtrm_type}' AS rel_xtrm_type, CAST({p.k} AS BIGINT) AS k, {str(p.embed).upper()} AS embed,
        {str(p.diff).upper()} AS diff, missing_pct, mean, std, cv, skewness, kurtosis, autocorr_lag1,
        {seasonal_period_sql(g)} AS seasonal_period,
        CAST(NULL AS VARCHAR) AS blob_path, CAST(NULL AS VARCHAR) AS hf_revision,
        CAST(NULL AS VARCHAR) AS pipeline_version, CAST(NULL AS VARCHAR) AS ingested_at
      FROM ({scan}) WHERE {accepted_sql()}"""


def series_sql() -> str:
    return build_series_sql(catalog_scan_sql())


def build_scanned_sql() -> str:
    return f"""SELECT id, N, n_rare, pct_rare, IR, imbalance_level,
        CASE WHEN {accepted_sql()} THEN 'accepted' ELSE 'rejected' END AS verdict
      FROM ({catalog_scan_sql()})"""


def scan_summary_sql() -> str:
    return f"""WITH s AS ({catalog_scan_sql()})
      SELECT 'total' AS section, CAST(NULL AS VARCHAR) AS value, COUNT(*) AS n FROM s
      UNION ALL SELECT 'status', status, COUNT(*) FROM s GROUP BY status
      UNION ALL SELECT 'imbalance_level', imbalance_level, COUNT(*) FROM s GROUP BY imbalance_level
      UNION ALL SELECT 'passed', NULL, COUNT(*) FILTER (WHERE COALESCE(n_rare, 0) > 0) FROM s"""


def resume_anti_sql() -> str:
    return f"""WITH cur AS (SELECT DISTINCT id, source, collection, name FROM ({panel_sql('orders')})),
        prev AS (SELECT DISTINCT id FROM ({table_panel_sql(EARLIER_ORDERS)}))
      SELECT * FROM cur WHERE id NOT IN (SELECT id FROM prev)"""


def entries_header_sql() -> str:
    return f"""SELECT {make_id_sql("'gluonts'", "'emb' || CAST(label AS VARCHAR)", 'vec_id')} AS id,
        'gluonts' AS source, 'emb' || CAST(label AS VARCHAR) AS collection,
        ROW_NUMBER() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS ord FROM embeddings"""


def limit_new_sql(n: int = 5) -> str:
    return f"""SELECT id, collection, ord FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY source, collection ORDER BY ord, id) AS rn
        FROM ({entries_header_sql()})) WHERE rn <= {n}"""


def rerun_sql() -> str:
    gaps = TablePanel("events", "events", "user_id", ("ts", "event_id"), TABLE_PANELS["events_gaps"].value_sql)
    return (f"SELECT *, CAST(0 AS BIGINT) AS ord FROM ({scan_rows_sql(panel_sql('events'))}) UNION ALL "
            f"SELECT *, CAST(1 AS BIGINT) AS ord FROM ({scan_rows_sql(table_panel_sql(gaps))})")


def dedupe_first_sql() -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY ord) AS rn FROM ({rerun_sql()})) WHERE rn = 1"""


def duplicate_report_sql() -> str:
    return f"""SELECT id, COUNT(*) AS n_rows, COUNT(*) - 1 AS n_dropped FROM ({rerun_sql()})
      GROUP BY id HAVING COUNT(*) > 1"""


def blob_path_sql(id_: str = "id") -> str:
    key = f"regexp_extract({id_}, '^[^:]*:[^:]*:(.*)$', 1)"
    return (f"concat_ws('/', split_part({id_}, ':', 1), split_part({id_}, ':', 2), substr(md5({id_}), 1, 2), "
            f"regexp_replace({key}, '[^a-z0-9._-]', '-', 'g') || '.parquet')")


def blob_paths_sql() -> str:
    return f"""SELECT id, split_part(id, ':', 1) AS id_source, split_part(id, ':', 2) AS id_collection,
        regexp_extract(id, '^[^:]*:[^:]*:(.*)$', 1) AS id_key, {blob_path_sql()} AS blob_path
      FROM ({series_sql()})"""


def path_collisions_sql() -> str:
    return f"""SELECT blob_path, COUNT(*) AS n_ids, MIN(id) AS first_id, MAX(id) AS last_id FROM (
        SELECT DISTINCT id, {blob_path_sql()} AS blob_path FROM ({catalog_scan_sql()}))
      GROUP BY blob_path HAVING COUNT(*) > 1"""


FIRST_ROUND = ("events_gaps", "orders")


def runs_panel_sql() -> str:
    return " UNION ALL ".join(f"SELECT id, source, collection, pos, ts, value FROM ({panel_sql(n)})" for n in CATALOG_RUNS)


def finalized_sql(collections=None) -> str:
    rev, ver, at = PUBLISH_STAMP
    due = f"cat.collection IN ({', '.join(repr(c) for c in collections)})" if collections else "TRUE"
    return f"""WITH cat AS MATERIALIZED ({series_sql()}),
        sizes AS (SELECT p.id, CAST(8 * COUNT(*) + 8 * COUNT(p.ts) AS BIGINT) AS size_bytes
                  FROM ({runs_panel_sql()}) p JOIN cat ON p.id = cat.id
                  WHERE {due} GROUP BY p.id)
      SELECT cat.* REPLACE (
          CASE WHEN s.id IS NOT NULL THEN {blob_path_sql('cat.id')} ELSE cat.blob_path END AS blob_path,
          CASE WHEN s.id IS NOT NULL THEN s.size_bytes ELSE cat.size_bytes END AS size_bytes,
          CASE WHEN s.id IS NOT NULL THEN '{rev}' ELSE cat.hf_revision END AS hf_revision,
          CASE WHEN s.id IS NOT NULL THEN '{ver}' ELSE cat.pipeline_version END AS pipeline_version,
          CASE WHEN s.id IS NOT NULL THEN '{at}' ELSE cat.ingested_at END AS ingested_at)
      FROM cat LEFT JOIN sizes s ON cat.id = s.id"""


def finalize_sql() -> str:
    return f"""SELECT id, blob_path, size_bytes, hf_revision, pipeline_version, ingested_at
      FROM ({finalized_sql()})"""


def missing_from_source_sql() -> str:
    return f"""WITH wanted AS (SELECT id, source, collection FROM ({series_sql()})
                             WHERE blob_path IS NULL AND collection = 'orders'),
        present AS (SELECT DISTINCT id FROM ({table_panel_sql(EARLIER_ORDERS)}))
      SELECT source, collection, COUNT(present.id) AS staged, COUNT(*) AS wanted
      FROM wanted LEFT JOIN present ON wanted.id = present.id GROUP BY source, collection"""


def requests_sql() -> str:
    return f"""SELECT ROW_NUMBER() OVER (ORDER BY id) - 1 AS ord, id FROM (
        SELECT id FROM ({catalog_scan_sql()})
        UNION ALL SELECT DISTINCT id FROM ({panel_sql('lineitem')}))"""


def pull_status_sql(collections=FIRST_ROUND) -> str:
    return f"""WITH cat AS ({finalized_sql(collections)}), req AS ({requests_sql()})
      SELECT req.ord, req.id,
             CASE WHEN cat.id IS NULL THEN 'unknown_id' WHEN cat.blob_path IS NULL THEN 'no_blob'
                  ELSE 'ok' END AS status
      FROM req LEFT JOIN cat ON req.id = cat.id"""


def pull_many_sql() -> str:
    return f"""WITH st AS MATERIALIZED ({pull_status_sql(None)})
      SELECT st.ord, p.id, p.pos, p.ts, p.value FROM ({runs_panel_sql()}) p
      JOIN st ON p.id = st.id WHERE st.status = 'ok'"""


def verify_pulled_sql() -> str:
    # Every published series was stored from the points it was scored on; the values of 'orders' are altered.
    return f"SELECT id, collection <> 'orders' AS hash_ok FROM ({finalized_sql()}) WHERE blob_path IS NOT NULL"


def stored_series_sql() -> str:
    return f"""WITH cat AS MATERIALIZED ({series_sql()})
      SELECT p.source, p.collection, COUNT(DISTINCT p.id) AS n_series, COUNT(*) AS n_points, COUNT(p.ts) AS n_dated
      FROM ({runs_panel_sql()}) p JOIN cat ON p.id = cat.id GROUP BY p.source, p.collection"""


def scan_batch_resume_sql() -> str:
    """Every well-formed entry once, but for the failed collection, which has one error row."""
    panel = f"""SELECT {make_id_sql("'gluonts'", "collection", 'key')} AS id, 'gluonts' AS source, collection, key AS name,
          {entry_freq_sql('label')} AS granularity, CAST(NULL AS VARCHAR) AS time_column, 'float64' AS dtype,
          CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS pos, CAST(NULL AS TIMESTAMP) AS ts,
          CAST(unnest(embedding) AS DOUBLE) AS value
        FROM (SELECT *, 'emb' || CAST(label AS VARCHAR) AS collection, CAST(CASE WHEN label = 3
                THEN ROW_NUMBER() OVER (PARTITION BY label ORDER BY vec_id) - 1 ELSE vec_id END AS VARCHAR) AS key
              FROM embeddings)
        WHERE collection <> 'emb2' AND NOT (label = 4 AND embedding[1] < 0)"""
    cols = "id, source, collection, name, granularity, length, N, n_rare, mean, status, note"
    return f"""SELECT {cols} FROM ({scan_rows_sql(panel)})
      UNION ALL SELECT DISTINCT 'gluonts:emb2:dataset', 'gluonts', 'emb2', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
        CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), 'error', 'cannot be read'
      FROM embeddings WHERE label = 2"""


def value_counts_sql() -> str:
    return f"""SELECT COALESCE(granularity, '__null__') AS value, COUNT(*) AS n FROM ({series_sql()})
      GROUP BY 1"""


def time_column_by_source_sql() -> str:
    return f"""SELECT source, arg_min(time_column, ord) FILTER (WHERE time_column IS NOT NULL) AS time_column
      FROM ({catalog_scan_sql()}) GROUP BY source"""


def collection_count_sql() -> str:
    return f"SELECT COUNT(DISTINCT collection) AS n FROM ({series_sql()})"


def example_counts_sql(series: str | None = None) -> str:
    names = ", ".join(f"('{n}')" for n in EXAMPLES)
    return f"""WITH names(value) AS (VALUES {names}),
        c AS (SELECT collection AS value, COUNT(*) AS n FROM ({series or series_sql()}) GROUP BY collection)
      SELECT names.value, CAST(COALESCE(c.n, 0) AS BIGINT) AS n FROM names LEFT JOIN c ON names.value = c.value"""


NUMERIC = {"N": ("N", 0), "IR": ("IR", 2), "%Rare": ("pct_rare", 2), "length": ("length", 0),
           "missing_pct": ("missing_pct", 4), "seasonal_period": ("seasonal_period", 0)}
STATS = (("min", 0.0), ("25%", 0.25), ("50%", 0.5), ("75%", 0.75), ("max", 1.0))


def content_hash_sql(panel: str) -> str:
    """SHA-256 over the little-endian float64 bytes of a series: DuckDB's bit form is big-endian, so bytes are reversed."""
    hexed = "hex((value::DOUBLE::BIT)::BLOB)"
    little = " || ".join(f"substr(h, {i}, 2)" for i in range(15, 0, -2))
    return f"""WITH v AS (SELECT id, pos, {hexed} AS h FROM ({panel}) WHERE value IS NOT NULL AND NOT isnan(value))
      SELECT id, substr(sha256(unhex(string_agg({little}, '' ORDER BY pos))), 1, 16) AS content_hash FROM v GROUP BY id"""


def with_hash_sql(rows: str, panel: str) -> str:
    """``rows`` with the content hash of each id; a series without values hashes nothing."""
    return f"SELECT r.*, COALESCE(h.content_hash, '{EMPTY_HASH}') AS content_hash FROM ({rows}) r LEFT JOIN ({content_hash_sql(panel)}) h ON r.id = h.id"


def numeric_profile_sql(series: str | None = None) -> str:
    if series is None:
        return f"WITH s_once AS MATERIALIZED ({series_sql()}) {numeric_profile_sql('SELECT * FROM s_once')}"
    src = series
    parts = []
    for name, (col, dp) in NUMERIC.items():
        for stat, p in STATS:
            q = f"quantile_cont({col}, {p})"
            v = (f"CAST(CAST(round_even({q}, 0) AS BIGINT) AS VARCHAR)" if dp == 0
                 else f"CAST(round_even({q}, {dp}) AS VARCHAR)")
            parts.append(f"SELECT '{name}' AS field, '{stat}' AS stat, {v} AS value FROM ({src}) "
                         f"HAVING COUNT({col}) > 0")
        parts.append(f"SELECT '{name}', 'null_count', CAST(COUNT(*) FILTER (WHERE {col} IS NULL) AS VARCHAR) "
                     f"FROM ({src}) HAVING COUNT(*) FILTER (WHERE {col} IS NULL) > 0")
    return " UNION ALL ".join(parts)


def _json_str(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN 'null' ELSE '\"' || replace(replace({c}, '\\', '\\\\'), '\"', '\\\"')"
            f" || '\"' END")


def profile_sql(series: str) -> str:
    counts = []
    for col, bucket in (("source", None), ("license", None), ("imbalance_level", None), ("dtype", None),
                        ("granularity", "__null__")):
        c = f"COALESCE({col}, '{bucket}')" if bucket else col
        counts.append(f"SELECT '{col}.' || {c} AS path, CAST(COUNT(*) AS VARCHAR) AS value FROM s "
                      f"WHERE {c} IS NOT NULL GROUP BY {c}")
    return f"""WITH s AS ({series})
      SELECT 'row_count' AS path, CAST(COUNT(*) AS VARCHAR) AS value FROM s
      UNION ALL {' UNION ALL '.join(counts)}
      UNION ALL SELECT 'time_column_by_source.' || source,
             {_json_str('arg_min(time_column, id) FILTER (WHERE time_column IS NOT NULL)')} FROM s GROUP BY source
      UNION ALL SELECT 'collection_count_distinct', CAST(COUNT(DISTINCT collection) AS VARCHAR) FROM s
      UNION ALL SELECT 'collection_examples.' || value, CAST(n AS VARCHAR) FROM ({example_counts_sql('SELECT * FROM s')})
      UNION ALL SELECT 'numeric.' || field || '.' || stat, value FROM ({numeric_profile_sql('SELECT * FROM s')})"""


def profile_diff_sql() -> str:
    before = build_series_sql(catalog_scan_sql(CATALOG_RUNS[:2]))
    return f"""WITH e AS ({profile_sql(before)}), a AS ({profile_sql(series_sql())})
      SELECT COALESCE(e.path, a.path) AS path,
             CASE WHEN e.path IS NULL THEN 'new in catalog' WHEN a.path IS NULL THEN 'missing from catalog'
                  ELSE 'changed' END AS kind, e.value AS expected, a.value AS actual
      FROM e FULL OUTER JOIN a ON e.path = a.path WHERE e.value IS DISTINCT FROM a.value"""


def derived_dates_sql() -> str:
    return """SELECT DISTINCT grp, ts FROM (
        SELECT 'ship_daily' AS grp, date_trunc('day', l_shipdate) AS ts FROM lineitem
        UNION ALL SELECT 'ship_weekly', date_trunc('week', l_shipdate) FROM lineitem
        UNION ALL SELECT 'ship_business', date_trunc('day', l_shipdate) FROM lineitem
                  WHERE isodow(l_shipdate) BETWEEN 1 AND 5
        UNION ALL SELECT 'order_month_end', CAST(last_day(o_orderdate) AS TIMESTAMP) FROM orders
        UNION ALL SELECT 'order_quarter_start', date_trunc('quarter', o_orderdate) FROM orders
        UNION ALL SELECT 'order_year_start', date_trunc('year', o_orderdate) FROM orders
        UNION ALL SELECT 'event_hourly', date_trunc('hour', ts) FROM events
        UNION ALL SELECT 'event_raw', ts FROM events)"""


# What stands before a key: paths hold letters, digits, points, underscores and hyphens only, so most of these look alike there.
COLLIDING = ("k/", "k+", "k*", "k(", "k&", "k#", "k!", "k=", "k.", "k_")
# Parts of which paths are built.
PATH_PARTS = ("a", "..", ".", "", "b..", "...")


def exclude_collections_sql() -> str:
    headers = " UNION ALL ".join(f"SELECT DISTINCT id, source, collection FROM ({panel_sql(n)})" for n in ("entries", "orders", "wide"))
    return f"""SELECT source, collection, COUNT(*) AS n_series FROM ({headers})
      WHERE source IN ('gluonts', 'tables') AND collection NOT IN ('emb1', 'emb7', 'orders') GROUP BY 1, 2"""


def path_collisions_keys_sql() -> str:
    keys = ", ".join(f"'{a}' || c_custkey" for a in COLLIDING)
    return f"""WITH k AS (SELECT DISTINCT {make_id_sql("'tables'", "'customer'", 'key')} AS id FROM (SELECT unnest([{keys}]) AS key FROM customer))
      SELECT {blob_path_sql()} AS blob_path, COUNT(*) AS n_ids, MIN(id) AS first_id, MAX(id) AS last_id FROM k GROUP BY 1 HAVING COUNT(*) > 1"""


def unsafe_paths_sql() -> str:
    parts, n = ", ".join(f"'{p}'" for p in PATH_PARTS), len(PATH_PARTS)
    path = " || '/' || ".join(f"([{parts}])[CAST((c_custkey // {n**k}) % {n} AS BIGINT) + 1]" for k in range(4))
    return f"""WITH p AS (SELECT c_custkey, {path} || '/' || c_custkey AS path FROM customer),
        d AS (SELECT *, list_transform(string_split(path, '/'), lambda x: CASE WHEN x = '..' THEN -1 WHEN x IN ('', '.') THEN 0 ELSE 1 END) AS steps FROM p)
      SELECT c_custkey, path, starts_with(path, '/') OR list_min(list_transform(range(1, len(steps) + 1), lambda i: list_sum(steps[1:i]))) < 0 AS unsafe FROM d"""


def pull_one_sql() -> str:
    return f"""WITH cat AS MATERIALIZED ({series_sql()})
      SELECT p.pos, p.ts, p.value FROM ({panel_sql('orders')}) p WHERE p.id = (SELECT MIN(id) FROM cat WHERE collection = 'orders')"""


def catalog_versions_sql() -> str:
    return f"""WITH s AS MATERIALIZED ({catalog_scan_sql()})
      SELECT '1.1' AS version, 'series' AS table_name, COUNT(*) AS n, TRUE AS rewrite_refused FROM s WHERE ord < 2 AND {accepted_sql()}
      UNION ALL SELECT '1.1', 'scanned', COUNT(*), TRUE FROM s WHERE ord < 2
      UNION ALL SELECT 'latest', 'series', COUNT(*), TRUE FROM s WHERE {accepted_sql()}
      UNION ALL SELECT 'latest', 'scanned', COUNT(*), TRUE FROM s"""


def describe_sql() -> str:
    stats = {"count": "COUNT({c})", "mean": "AVG({c})", "stddev": "STDDEV_SAMP({c})", "min": "MIN({c})", "25%": "QUANTILE_DISC({c}, 0.25)",
             "50%": "QUANTILE_DISC({c}, 0.5)", "75%": "QUANTILE_DISC({c}, 0.75)", "max": "MAX({c})"}
    rows = " UNION ALL ".join(f"SELECT '{name}' AS summary, " + ", ".join(f"{sig('CAST(' + f.format(c=c) + ' AS DOUBLE)')} AS {c}" for c in ("pct_rare", "length", "n_rare")) + " FROM s"
                              for name, f in stats.items())
    return f"WITH s AS MATERIALIZED ({series_sql()}) {rows}"


def granularity_sql(dates: str | None = None) -> str:
    """Granularity per ``grp`` of a ``(grp, ts)`` query (default: the derived date sets)."""
    day = 86_400_000_000
    return f"""WITH d AS (SELECT grp, ts, epoch_us(ts) AS us, isodow(ts) - 1 AS wd,
                   (epoch_us(ts) // {day}) AS dnum, year(ts) * 12 + month(ts) - 1 AS midx,
                   epoch_us(ts) % {day} = 0 AS mid, CAST(ts AS DATE) = last_day(ts) AS me, day(ts) = 1 AS ms
                 FROM ({dates or derived_dates_sql()})),
        d2 AS (SELECT *, floor((dnum - 4) / 7) * 5 + LEAST(((dnum - 4) % 7 + 7) % 7, 5) AS bidx FROM d),
        s AS (SELECT grp, COUNT(*) AS n, COUNT(ts) AS nt, COUNT(DISTINCT ts) AS nd, MIN(us) AS lo, MAX(us) AS hi,
                     arg_min(wd, us) AS wd0, MIN(bidx) AS blo, MAX(bidx) AS bhi,
                     COUNT(*) FILTER (WHERE wd >= 5) AS wkend, MIN(midx) AS mlo, MAX(midx) AS mhi,
                     COUNT(*) FILTER (WHERE NOT mid) AS notmid, COUNT(*) FILTER (WHERE NOT me) AS notme,
                     COUNT(*) FILTER (WHERE NOT ms) AS notms
              FROM d2 GROUP BY grp),
        s2 AS (SELECT *, CASE WHEN n > 1 AND (hi - lo) % (n - 1) = 0 THEN (hi - lo) // (n - 1) END AS step,
                         CASE WHEN n > 1 AND (mhi - mlo) % (n - 1) = 0 THEN (mhi - mlo) // (n - 1) END AS mstep
               FROM s),
        o AS (SELECT d2.grp,
                     COUNT(*) FILTER (WHERE COALESCE((d2.us - s2.lo) % NULLIF(s2.step, 0) <> 0, TRUE)) AS offgrid,
                     COUNT(*) FILTER (WHERE COALESCE((d2.midx - s2.mlo) % NULLIF(s2.mstep, 0) <> 0, TRUE))
                       AS moffgrid
              FROM d2 JOIN s2 ON d2.grp = s2.grp GROUP BY d2.grp),
        j AS (SELECT s2.*, o.offgrid, o.moffgrid FROM s2 JOIN o ON s2.grp = o.grp)
      SELECT grp, CASE
          WHEN NOT (n >= 3 AND nt = n AND nd = n) THEN NULL
          WHEN step IS NOT NULL AND step > 0 AND offgrid = 0 THEN CASE
              WHEN step % {day} = 0 THEN CASE WHEN step // {day} = 7
                   THEN 'W-' || ['MON','TUE','WED','THU','FRI','SAT','SUN'][wd0 + 1]
                   WHEN step // {day} = 1 THEN 'D' ELSE CAST(step // {day} AS VARCHAR) || 'D' END
              WHEN step % 3600000000 = 0 THEN CASE WHEN step // 3600000000 = 1 THEN 'H'
                   ELSE CAST(step // 3600000000 AS VARCHAR) || 'H' END
              WHEN step % 60000000 = 0 THEN CASE WHEN step // 60000000 = 1 THEN 'min'
                   ELSE CAST(step // 60000000 AS VARCHAR) || 'min' END
              WHEN step % 1000000 = 0 THEN CASE WHEN step // 1000000 = 1 THEN 's'
                   ELSE CAST(step // 1000000 AS VARCHAR) || 's' END
              END
          WHEN notmid = 0 AND wkend = 0 AND bhi - blo = n - 1 THEN 'B'
          WHEN notmid = 0 AND (notme = 0 OR notms = 0) AND mstep IN (1, 3, 12) AND moffgrid = 0 THEN
               CASE mstep WHEN 1 THEN 'M' WHEN 3 THEN 'Q' ELSE 'Y' END
          END AS granularity
      FROM j"""


def topk_rare_sql() -> str:
    return f"""SELECT id, pct_rare, imbalance_level FROM ({series_sql()})
      ORDER BY pct_rare ASC NULLS LAST, id LIMIT 10"""


def catalog_filter_sql() -> str:
    return f"""SELECT id, collection, N, n_rare, pct_rare, imbalance_level FROM ({series_sql()})
      WHERE imbalance_level IN ('severe', 'extreme', 'mild') AND length >= 20 AND missing_pct <= 0.0"""


ORACLE: dict[str, str] = {}


def _register() -> None:
    from .queries import HASHED_SCANS, SCAN_PANELS
    for n in SCAN_PANELS:
        ORACLE[f"scan_{n}"] = scan_rows_sql(panel_sql(n))
    for n in HASHED_SCANS:
        ORACLE[f"scan_{n}"] = with_hash_sql(scan_rows_sql(panel_sql(n)), panel_sql(n))
    ORACLE.update({
        "content_hash": content_hash_sql(panel_sql("events_gaps")),
        "resume_bucketed": resume_anti_sql(),
        "exclude_collections": exclude_collections_sql(),
        "path_collisions_keys": path_collisions_keys_sql(),
        "unsafe_paths": unsafe_paths_sql(),
        "pull_one": pull_one_sql(),
        "catalog_versions": catalog_versions_sql(),
        "describe": describe_sql(),
        "profile_check": profile_diff_sql(),
        "scan_wide_files": scan_wide_files_sql(),
        "panel_wide_files": f"SELECT id, name, granularity, time_column, dtype, pos, ts, value FROM ({wide_files_panel_sql()})",
        "limit_wide_files": limit_wide_files_sql(),
        "entries_from_files": entries_from_files_sql(),
        "level_counts": level_counts_sql(),
        "panel_events": f"SELECT id, pos, ts, value FROM ({panel_sql('events')})",
        "panel_entries": f"SELECT id, source, collection, name, granularity, pos, value FROM ({panel_sql('entries')})",
        "panel_wide": f"SELECT id, name, granularity, time_column, dtype, pos, ts, value FROM ({panel_sql('wide')})",
        "profile_moments": profile_moments_sql("events_gaps"),
        "profile_moments_orders": profile_moments_sql("orders"),
        "autocorr": autocorr_sql(),
        "embedding": embedding_sql(),
        "control_points": control_points_sql(),
        "relevance": relevance_sql(),
        "imbalance_scores": imbalance_scores_sql(),
        "scan_summary": scan_summary_sql(),
        "resume_anti": resume_anti_sql(),
        "limit_new": limit_new_sql(),
        "dedupe_first": dedupe_first_sql(),
        "duplicate_report": duplicate_report_sql(),
        "build_series": with_hash_sql(series_sql(), catalog_panels_sql()),
        "build_scanned": with_hash_sql(build_scanned_sql(), catalog_panels_sql()),
        "blob_paths": blob_paths_sql(),
        "path_collisions": path_collisions_sql(),
        "finalize": finalize_sql(),
        "missing_from_source": missing_from_source_sql(),
        "pull_status": pull_status_sql(),
        "pull_many": pull_many_sql(),
        "verify_pulled": verify_pulled_sql(),
        "stored_series": stored_series_sql(),
        "scan_batch_resume": scan_batch_resume_sql(),
        "value_counts": value_counts_sql(),
        "time_column_by_source": time_column_by_source_sql(),
        "collection_count": collection_count_sql(),
        "example_counts": example_counts_sql(),
        "numeric_profile": numeric_profile_sql(),
        "profile_catalog": profile_sql(series_sql()),
        "profile_diff": profile_diff_sql(),
        "granularity": granularity_sql(),
        "topk_rare": topk_rare_sql(),
        "catalog_filter": catalog_filter_sql(),
    })
