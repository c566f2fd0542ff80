"""One query for each operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm import divergence, exact_dedup, hard_negatives, html_text, licenses, line_dedup, lm_scoring, mixing, near_dedup, packing, quality, repeats, resampling

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_index(spark: SparkSession) -> exact_dedup.DigestIndex:
    """An empty index under a name of its own; a standing one would keep its name from load to load."""
    return exact_dedup.DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    trusted = quality.trusted_ids(table(spark, folder, "labels"))
    return quality.judge(table(spark, folder, "documents"), trusted)


def op2_html_text(spark: SparkSession, folder: str) -> DataFrame:
    found = html_text.extract(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_cut")


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.verdicts(new_index(spark), table(spark, folder, "documents"))


def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score(table(spark, folder, "documents"))


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op6_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, folder, "documents"))


def op7_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return resampling.resample(documents, quality.trusted_ids(table(spark, folder, "labels")))


def op8_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeats(table(spark, folder, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    joined = {c: F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")}
    found = licenses.scan(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", *joined.values(), "score")


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(table(spark, folder, "documents"))


def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, folder, "documents")).drop("kept")


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, folder, "embeddings"))


def registry() -> dict[str, Query]:
    import corpus_pipeline

    found = [op1_quality_rules, op2_html_text, op3_exact_dedup, op4_lm_scoring, op5_best_fit_packing, op6_minhash_dedup, op7_importance_resampling]
    found += [op8_repeats, op9_mixing, op10_license_scan, op11_source_divergence, op12_line_dedup, op13_hard_negatives]
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def check_sql() -> dict[str, str]:
    import corpus_pipeline

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    exact = f"""
        WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{upper}', '{lower}')) AS h FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, h AS text_sha256
        FROM d WINDOW w AS (PARTITION BY h)"""
    mix = r"""
        WITH d AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                   ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
            FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight FROM s),
        o AS (SELECT *, row_number() OVER (ORDER BY 2 * source_size / weight, source NULLS LAST) AS rank FROM w),
        l AS (
            SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(2 * source_size) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
            FROM o WINDOW b AS (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        f AS (SELECT arg_min(level, rank) AS level FROM l WHERE 2 * source_size >= level * weight),
        t AS (SELECT source, source_size, least((2 * source_size)::DOUBLE, f.level * weight) AS target FROM w, f),
        q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t)
        SELECT doc_id, size, source_size, target,
               (size * (whole + (target - whole * source_size > 0
                   AND sum(size) OVER (PARTITION BY d.source ORDER BY h) <= target - whole * source_size)::INT))::BIGINT AS taken
        FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source"""
    audit = rf"""
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        w AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
        c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY ALL),
        k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 3),
        l AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER x + count(*) OVER x) AS q FROM k WINDOW x AS (PARTITION BY lang)),
        g AS (SELECT DISTINCT lang, source FROM d),
        t AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        p AS (SELECT *, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER x + count(*) OVER x) AS p FROM t WINDOW x AS (PARTITION BY lang, source)),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
                SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
                FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
            ) f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
        above AS (SELECT p.lang, p.source, p.term AS item, ((p - q) * (p - q)) // q AS value FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q),
        u AS (SELECT 'pair' AS part, * FROM pairs UNION ALL SELECT 'term', * FROM above)
        SELECT lang, source, part, item, value::BIGINT AS value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
        FROM u QUALIFY part = 'pair' OR rank <= 200"""
    line = rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS doc, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        e AS (SELECT r, doc, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM d),
        k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{upper}', '{lower}') AS key FROM e),
        s AS (SELECT key, min(doc) AS least FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc) >= 2),
        f AS (SELECT k.*, s.least IS NOT NULL AND doc > s.least AS gone FROM k LEFT JOIN s USING (key)),
        j AS (SELECT r, count(*) FILTER (WHERE gone) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS kept FROM f GROUP BY r)
        SELECT doc_id, len(lines)::BIGINT AS n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM d JOIN j USING (r)"""
    negatives = """
        WITH e AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, e.vec_id AS other_id, a.label = e.label AS same, list_inner_product(a.v, e.v)::BIGINT AS score
            FROM e a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 50 = 0),
        p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT p.anchor_id, p.other_id AS positive_id,
               (row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id))::INTEGER AS rank,
               s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
        QUALIFY rank <= 3"""
    found = {"op3_exact_dedup": exact, "op9_mixing": mix, "op11_source_divergence": audit, "op12_line_dedup": line, "op13_hard_negatives": negatives}
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
