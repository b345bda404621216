"""The operators as registered queries, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (bpe, exact_dedup, filter_audit, html_extract, jaccard_join,
                           language_id, packing, quality, secret_scan, token_align,
                           token_counts, topk_search, url_filter)
from clickloom.llm.scratch import id_remainder
from clickloom.sources.testdata import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.length_histogram(
        token_counts.token_counts(table(spark, sf_dir, "documents")))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = language_id.profiles(docs.where(id_remainder("doc_id", 4) != 2))
    held_out = F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False))
    return language_id.identify(docs, known).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    of = lambda kind: f"CAST(size(filter(found, x -> x.kind = '{kind}')) AS BIGINT) AS n_{kind}"
    told = "array_join(transform({}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')".format
    base = told("filter(found, x -> x.kind IN ('assign', 'access', 'hex'))")
    return found.selectExpr("doc_id", of("assign"), of("access"), of("hex"),
                            f"sha2({base}, 256) AS base_sha256", f"{told('found')} AS spans")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), keep_ids=False).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align(table(spark, sf_dir, "documents"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_exact_dedup, op2_token_counts, op3_html_extraction, op4_jaccard_join,
             op5_topk_search, op6_language_id, op7_secret_scan, op8_bpe, op9_packing,
             op10_quality, op11_filter_audit, op12_token_align, op13_url_filter, pipeline)
    return {f.__name__: f for f in found}


OP1 = r"""
WITH keyed AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS kept,
       sha256(norm) AS text_sha256
FROM keyed"""

OP5 = """
WITH scaled AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
ranked AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM scaled q JOIN scaled c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0)
SELECT query_id,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM ranked
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20"""


OP11 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                     lambda w: w <> '') AS words
  FROM documents),
label AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
masked AS (
  SELECT w.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text)
                THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
  FROM words w LEFT JOIN label l ON w.doc_id = l.doc_id),
cells AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM masked GROUP BY part, mask),
filters (letter, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders (filter_order, used) AS (
  SELECT '', 0
  UNION ALL
  SELECT filter_order || letter, used + b FROM orders, filters WHERE used & b = 0),
steps AS (
  SELECT filter_order, step, CAST(instr('ABCDE', substr(filter_order, step, 1)) AS INTEGER) AS at
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) WHERE length(filter_order) = 5),
bits AS (
  SELECT s.filter_order, s.step, CAST(1 << (s.at - 1) AS BIGINT) AS b,
         coalesce(sum(CAST(1 << (e.at - 1) AS BIGINT)), 0) AS earlier
  FROM steps s LEFT JOIN steps e ON e.filter_order = s.filter_order AND e.step < s.step
  GROUP BY s.filter_order, s.step, s.at),
told AS (
  SELECT part, filter_order, step, b,
         sum(CASE WHEN mask & (earlier + b) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & b <> 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & b <> 0 AND mask & earlier <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = b THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & b <> 0 AND mask & earlier = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & b <> 0 AND mask & earlier = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, (SELECT filter_order, step, b, CAST(earlier AS BIGINT) AS earlier FROM bits)
  GROUP BY part, filter_order, step, b)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, b) AS BIGINT) AS shapley
FROM told"""


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1, "op5_topk_search": OP5, "op11_filter_audit": OP11}
