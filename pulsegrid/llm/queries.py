"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from pulsegrid.llm import (
    best_fit, filter_audit, html_text, jaccard_join, mixing, packing, quality_model, quality_rules, search, suffix_dedup,
    text_stats, toxicity, vector_codes, warc)
from pulsegrid.llm.common import held_out, staged, table


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    stats = staged(text_stats.with_counts(docs).drop("text"), "stats")
    rules = quality_rules.learn(stats, table(spark, folder, "labels"))
    return quality_rules.judge(stats, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rule")


def op2_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages")).select("page_id", "text")


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, folder, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted", "spans")


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = mixing.with_size(table(spark, folder, "documents")).select("doc_id", "source", "size")
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", taken)


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op7_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality_model.score(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.linked_components(table(spark, folder, "documents"))


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.report(table(spark, folder, "documents"))


def op10_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(table(spark, folder, "embeddings"))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compress(table(spark, folder, "embeddings"))


def op12_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return best_fit.pack(table(spark, folder, "documents"))


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_html_text": op2_html_text,
        "op3_toxicity": op3_toxicity,
        "op4_mixing": op4_mixing,
        "op5_warc": op5_warc,
        "op6_packing": op6_packing,
        "op7_quality_model": op7_quality_model,
        "op8_jaccard_join": op8_jaccard_join,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_search": op10_search,
        "op11_vector_codes": op11_vector_codes,
        "op12_best_fit": op12_best_fit,
        "op13_filter_audit": op13_filter_audit,
        "pipeline": corpus_pipeline.run,
    }


def _codes_sql(rounds: int = 6) -> str:
    """Codebooks as rows (part, entry, v), each round made from the one before."""
    nearest = """
  SELECT vec_id, label, part, v, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT p.vec_id, p.label, p.part, p.v, b.entry,
      list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - b.v[i]) * (p.v[i] - b.v[i])))::BIGINT AS d
    FROM parts p JOIN book{0} b ON p.part = b.part) x GROUP BY ALL"""
    steps = "".join(f"""
), near{r} AS MATERIALIZED ({nearest.format(r)}
), mean{r} AS (
  SELECT part, entry, list(m ORDER BY i) AS v FROM (
    SELECT part, entry, i, floor(sum(v[i])::DOUBLE / count(*))::BIGINT AS m
    FROM near{r}, range(1, 1025) t(i) WHERE i <= len(v) GROUP BY part, entry, i) y GROUP BY part, entry
), book{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN mean{r} m USING (part, entry)""" for r in range(rounds))
    return f"""
WITH whole AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v,
    row_number() OVER (ORDER BY vec_id) - 1 AS place
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), parts AS MATERIALIZED (
  SELECT vec_id, label, place, part, v[part * len(v) // 8 + 1:(part + 1) * len(v) // 8] AS v FROM whole, range(8) t(part)
), book0 AS MATERIALIZED (
  SELECT part, place AS entry, v FROM parts WHERE place < 16{steps}
), coded AS ({nearest.format(rounds)}
), one AS (
  SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM coded GROUP BY vec_id, label
), digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM one, digest"""


AUDIT_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), counted AS (
  SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) AS copy
  FROM texts
), known AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, concat(
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END,
    CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END,
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
    CASE WHEN copy THEN 'E' ELSE '' END) AS failed
  FROM counted LEFT JOIN known USING (doc_id)
), cells AS (
  SELECT part, good, toxic, failed, count(*) AS n FROM failing GROUP BY ALL
), letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
  SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step::INTEGER AS step, filter_order[step] AS own, filter_order[1:step - 1] AS earlier
  FROM orders, range(1, 6) t(step)
), met AS (
  SELECT part, filter_order, step, own, n, good, toxic, failed, contains(failed, own) AS fails,
    regexp_matches(failed, '[' || earlier || '.]') AS before
  FROM cells, steps
), counts AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (NOT fails AND NOT before), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (fails AND NOT before), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (fails AND before), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (failed = own), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (fails AND NOT before AND good), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (fails AND NOT before AND toxic), 0)::BIGINT AS toxic_lost
  FROM met GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM counts"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of what SQL can express on whole tables; tests/llm has plain versions of the rest."""
    return {"op11_vector_codes": _codes_sql(), "op13_filter_audit": AUDIT_SQL, "op10_search": """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), one AS (
  SELECT vec_id, max(v) AS v FROM whole GROUP BY vec_id
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.v, d.v)::BIGINT AS score
  FROM one q JOIN one d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id AND len(q.v) = len(d.v)
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id, score
FROM scored QUALIFY rank <= 5"""}
