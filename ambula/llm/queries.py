"""The queries of the training-data operators, and their SQL where DuckDB can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ambula.llm import ann, bpe, ngram_join, packing, quality, secrets, span_dedup, token_counts, url_filter, winnow
from ambula.llm.base import table


def op1_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.fingerprint_documents(table(spark, sf_dir, "documents"))


def op3_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(table(spark, sf_dir, "documents"))


def op5_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_sections(table(spark, sf_dir, "documents"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op10_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup.report_spans(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_cross_polytope, op2_winnowing, op3_bradley_terry, op4_byte_bpe, op5_bin_slack, op6_secrets, op7_token_counts, op8_ngram_jaccard, op9_url_filter, op10_sentence_spans)}


def _glob_regex(glob: str) -> str:
    special = ".^$+{}[]()|\\"
    return "".join(".*" if c == "*" else "." if c == "?" else "\\" + c if c in special else c for c in glob)


def _url_sql() -> str:
    rules = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    rule = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'" for _, h, p in rules)
    verdict = " ".join(f"WHEN rule = '{h}{p}' THEN '{v}'" for v, h, p in rules)
    globs = " OR ".join(f"regexp_full_match(host || path, '{_glob_regex(g)}', 's')" for g in url_filter.BLOCKED_GLOBS)
    return f"""
    WITH cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(url, '^.*?://([^?#]*)', 1, 's') ELSE '' END AS rest FROM pages),
    parts AS (SELECT page_id,
        translate(coalesce(regexp_extract(rest, '^([^/]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(rest, '^[^/]*(.*)$', 1, 's'), '') AS path FROM cut),
    ruled AS (SELECT *, CASE {rule} END AS rule FROM parts)
    SELECT page_id, host, path, rule, CASE {verdict} WHEN {globs} THEN 'block' ELSE 'allow' END AS verdict FROM ruled
    """


def _secrets_sql() -> str:
    """Spans by the gaps between matches, and each window's entropy counted anew."""
    words = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    assign = f"""({words})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    patterns = (assign, "AKIA[A-Z0-9]+", "[0-9a-f]{24,}", secrets.CANDIDATE)
    found = " UNION ALL ".join(f"SELECT r, {k} AS k, regexp_extract_all(t, '{p}') AS ms, string_split_regex(t, '{p}') AS gaps FROM texts" for k, p in enumerate(patterns))
    # the pattern for one character over and over has a back reference, which DuckDB lacks
    allow = " OR ".join(f"regexp_matches(m, '{p}')" for p in secrets.ALLOW if "\\1" not in p)
    classes = " ".join("WHEN " + " AND ".join(f"regexp_matches(m, '{p}')" for p in fits) + f" THEN {secrets.THRESHOLDS[name]}" for name, fits in secrets.CLASSES)
    names = " ".join(f"WHEN {k} THEN '{name}'" for k, name in enumerate(secrets.KINDS))
    counts = ", ".join(f"count(*) FILTER (k = {k}) AS n_{name}" for k, name in enumerate(secrets.KINDS))
    return f"""
    WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    found AS ({found}),
    matched AS (SELECT r, k, generate_subscripts(ms, 1) AS i, unnest(ms) AS m, unnest(gaps[1:len(ms)]) AS gap FROM found WHERE len(ms) > 0),
    placed AS (SELECT r, k, m, sum(length(gap) + length(m)) OVER (PARTITION BY r, k ORDER BY i) AS stop FROM matched),
    classed AS (SELECT *, CASE
            WHEN k < 3 OR {allow} OR replace(m, left(m, 1), '') = '' THEN NULL
            {classes} END AS threshold FROM placed),
    kept AS (SELECT r, k, CASE k {names} END || ':' || CAST(stop - length(m) AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span, stop - length(m) AS start FROM classed
        WHERE CASE k WHEN 0 THEN length(regexp_extract(m, '{assign}', 2)) >= 6 WHEN 1 THEN length(m) >= 20 WHEN 2 THEN true
            ELSE threshold IS NOT NULL AND list_max(list_transform(range(1, length(m) - {secrets.WINDOW} + 2), lambda j: list_aggregate(string_split(substring(m, j, {secrets.WINDOW}), ''), 'entropy'))) >= threshold END),
    by_text AS (SELECT r, {counts}, string_agg(span, ',' ORDER BY start, k) FILTER (k < 3) AS base, string_agg(span, ',' ORDER BY start, k) AS spans FROM kept GROUP BY r)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
        sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_entropy, 0) AS n_entropy
    FROM texts LEFT JOIN by_text USING (r)
    """


def _jaccard_sql() -> str:
    """Links by counting common shingles of one document for each different set; components by reachability."""
    return rf"""
    WITH RECURSIVE words AS (
        SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
    grams AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM words),
    sizes AS MATERIALIZED (SELECT doc_id, CAST(len(g) AS BIGINT) AS n, md5(array_to_string(list_sort(g), chr(10))) AS h FROM grams),
    reps AS MATERIALIZED (SELECT h, min(doc_id) AS rep, min(n) AS n FROM sizes WHERE n > 0 GROUP BY h),
    each_gram AS MATERIALIZED (SELECT rep, n, unnest(g) AS s FROM reps JOIN grams ON doc_id = rep),
    common AS (SELECT a.rep AS a, b.rep AS b, a.n AS n, b.n AS m, count(*) AS i FROM each_gram a JOIN each_gram b USING (s)
        WHERE a.rep < b.rep AND 100 * least(a.n, b.n) >= {ngram_join.RATIO} * greatest(a.n, b.n) GROUP BY ALL),
    links AS MATERIALIZED (SELECT a, b FROM common WHERE 100 * i >= {ngram_join.RATIO} * (n + m - i)),
    both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached(node, via) AS (SELECT rep, rep FROM reps UNION SELECT r.node, e.b FROM reached r JOIN both_ways e ON e.a = r.via),
    lowest AS (SELECT node, min(via) AS component FROM reached GROUP BY node)
    SELECT doc_id, sizes.n AS n_shingles, coalesce(component, doc_id) AS component_id FROM sizes LEFT JOIN reps USING (h) LEFT JOIN lowest ON node = rep
    """


ORACLE_SQL = {"op6_secrets": _secrets_sql(), "op8_ngram_jaccard": _jaccard_sql(), "op9_url_filter": _url_sql()}
