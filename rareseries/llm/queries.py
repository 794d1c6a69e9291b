"""Registered queries of the operators: each derives its contract columns from the operator's own output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rareseries.llm.common import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rareseries.llm.exact_dedup import exact_groups

    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rareseries.llm.jaccard_join import jaccard_groups

    return jaccard_groups(table(spark, sf_dir, "documents"), k=4, percent=85)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rareseries.llm.suffix_dedup import remove_repeats

    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rareseries.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rareseries.llm.token_files import new_root, read_records, write_records

    root = new_root(spark)
    found = read_records(write_records(table(spark, sf_dir, "documents"), root), root)
    return found.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rareseries.llm.line_dedup import line_copies

    return line_copies(table(spark, sf_dir, "documents"), short=True)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rareseries.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rareseries.llm.quality import rate

    rated = rate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return rated.select("doc_id", "expected_grade", "tail_probability", (F.col("tail_probability") >= 0.5).alias("kept"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rareseries.llm.packing import pack

    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rareseries.llm.vector_dedup import vector_groups

    return vector_groups(table(spark, sf_dir, "embeddings"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rareseries.llm.alignment import align

    return align(table(spark, sf_dir, "documents"))[0]


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rareseries.llm.token_files import new_root
    from rareseries.llm.warc import read_warc, write_warc

    root = new_root(spark)
    found = read_warc(write_warc(table(spark, sf_dir, "pages"), root), root, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rareseries.llm.divergence import source_divergence

    return source_divergence(table(spark, sf_dir, "documents"))


LLM_QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_jaccard_join, op3_suffix_dedup, op4_mixing, op5_token_files, op6_line_dedup, op7_toxicity, op8_quality, op9_packing, op10_vector_dedup, op11_token_alignment, op12_warc, op13_source_divergence)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Recursive components of ``links`` (a, b) over ``nodes`` (id): the smallest id that each reaches.
_COMPONENTS = """
        ties AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
        walk AS (SELECT id, id AS seen FROM nodes UNION SELECT w.id, e.b FROM walk w JOIN ties e ON w.seen = e.a),
        comp AS (SELECT id, min(seen) AS component_id FROM walk GROUP BY id)"""
_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(h, {5 * i + 1}, 5) AS INTEGER) >> {k}) & 31) + 1, 1)" for i in range(8) for k in (15, 10, 5, 0))

LLM_ORACLE = {
    "op2_jaccard_join": f"""
        WITH RECURSIVE d AS (SELECT doc_id AS id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        s AS (SELECT id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                              ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM d),
        g AS (SELECT id, len(s) AS n, unnest(s) AS x FROM s),
        links AS (SELECT a.id AS a, b.id AS b FROM g a JOIN g b ON a.x = b.x AND a.id < b.id GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        nodes AS (SELECT id FROM d),{_COMPONENTS}
        SELECT s.id AS doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, comp.component_id FROM s JOIN comp ON comp.id = s.id""",
    "op3_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
        w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS x FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS p FROM d)),
        hit AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY x) AS least FROM w) WHERE least < doc_id),
        turn AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER o <= 50 THEN 0 ELSE 1 END AS new FROM hit WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
        span AS (SELECT doc_id, min(p) AS s, max(p) + 50 AS e FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM turn) GROUP BY doc_id, run),
        piece AS (SELECT doc_id, s, e, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS after FROM span),
        kept AS (SELECT p.doc_id, count(*) AS n_spans, sum(e - s) AS n_removed, max(e) AS last, string_agg(substr(d.h, 2 * after + 1, 2 * (s - after)), '' ORDER BY s) AS k FROM piece p JOIN d USING (doc_id) GROUP BY p.doc_id)
        SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(k || substr(d.h, 2 * last + 1), d.h))) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op10_vector_dedup": f"""
        WITH RECURSIVE v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        ok AS (SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
        links AS (SELECT a.id AS a, b.id AS b FROM ok a JOIN ok b ON a.id < b.id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
        nodes AS (SELECT id FROM v),{_COMPONENTS}, degree AS (SELECT a AS id, count(*) AS n FROM ties GROUP BY a)
        SELECT v.id AS vec_id, coalesce(degree.n, 0) AS n_links, comp.component_id, v.id = comp.component_id AS kept FROM v JOIN comp ON comp.id = v.id LEFT JOIN degree ON degree.id = v.id""",
    "op12_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS t, upper(sha1(coalesce(html, ''))) AS h FROM pages),
        r AS (SELECT *, max(page_id) OVER (PARTITION BY t) AS best FROM p)
        SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
               CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> best THEN best END AS refers_to
        FROM r""",
    "op1_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)""",
    "op13_source_divergence": f"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LOWER} AS t FROM documents),
        w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
        k AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 30),
        c AS (SELECT lang, source, term, count(*) AS c FROM w JOIN k USING (lang, term) GROUP BY ALL),
        v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
        g AS (SELECT DISTINCT lang, source FROM d),
        f AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, sum(coalesce(c.c, 0)) OVER (PARTITION BY g.lang, g.source) AS n,
                     sum(coalesce(c.c, 0)) OVER (PARTITION BY g.lang, k.term) AS lang_c, sum(coalesce(c.c, 0)) OVER (PARTITION BY g.lang) AS lang_n, v.v
              FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        s AS (SELECT lang, source, term, c, 1 + CAST(1000000000 AS HUGEINT) * (c + 5) // (n + 5 * v) AS p, 1 + CAST(1000000000 AS HUGEINT) * (lang_c + 5) // (lang_n + 5 * v) AS q FROM f),
        x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        parts AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
            UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM s WHERE c > 0 AND p > q),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts)
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50""",
}
