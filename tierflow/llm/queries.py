"""Registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm import (
    decontamination, embedding_tiles, hard_negatives, language_unigram, line_frequency, packing, prefix_free, private_terms, quality_nbsvm, recurrent_lm,
    simhash_golay, token_alignment, toxicity_ftrl,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_toxicity_ftrl(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_ftrl.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op2_quality_nbsvm(spark: SparkSession, folder: str) -> DataFrame:
    return quality_nbsvm.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op3_pii_disclosure(spark: SparkSession, folder: str) -> DataFrame:
    return private_terms.find(table(spark, folder, "documents")).drop("base")


@query
def op4_cost_balanced_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents")).drop("ids")


@query
def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op6_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_golay.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
    )


@query
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_unigram.identify(table(spark, folder, "documents"))


@query
def op8_recurrent_lm(spark: SparkSession, folder: str) -> DataFrame:
    return recurrent_lm.score(table(spark, folder, "documents"))


@query
def op9_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_tiles.near_duplicates(table(spark, folder, "embeddings"))


ORACLES["op9_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
    SELECT a.vec_id AS i, b.vec_id AS j FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
    WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.98
), reached(i, j) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT r.i, p.j FROM reached r JOIN p ON r.j = p.i
), c AS (SELECT i, min(j) AS component_id FROM reached GROUP BY i)
SELECT e.vec_id, (SELECT count(*) FROM p WHERE p.i = e.vec_id) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.i = e.vec_id
"""


@query
def op10_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = prefix_free.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op11_line_frequency(spark: SparkSession, folder: str) -> DataFrame:
    found = line_frequency.judge(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLES["op11_line_frequency"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
    SELECT r, generate_subscripts(ws, 1) AS i, unnest(ws) AS word
    FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d)
), g AS (
    SELECT r, i, CASE WHEN lead(i, 7) OVER p IS NULL THEN NULL
                      ELSE list(word) OVER (p ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) END AS gram, word
    FROM w WINDOW p AS (PARTITION BY r ORDER BY i)
), t AS (
    SELECT r, i, word, CASE WHEN gram IS NOT NULL AND count(*) OVER (PARTITION BY r, gram) > 1 THEN 1 ELSE 0 END AS again FROM g
), c AS (
    SELECT r, word, max(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS covered FROM t
), words AS (
    SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars, sum(covered) AS n_repeat_words FROM c GROUP BY r
), l AS (
    SELECT r, source, text, unnest(string_split(text, chr(10))) AS line FROM d
), n AS (
    SELECT r, source, text, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS size,
           array_to_string(regexp_extract_all(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                             '[0-9]', '0', 'g'), '[^\x20\x09-\x0D]+'), ' ') AS norm
    FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), common AS (
    SELECT source, norm FROM n GROUP BY source, norm HAVING count(DISTINCT text) > 6
), lines AS (
    SELECT n.r, count(*) - count(DISTINCT n.line) AS n_dup_lines, sum(CASE WHEN common.norm IS NULL THEN 0 ELSE n.size END) AS lost
    FROM n LEFT JOIN common ON n.norm = common.norm AND n.source IS NOT DISTINCT FROM common.source GROUP BY n.r
), f AS (
    SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
    FROM d LEFT JOIN words USING (r) LEFT JOIN lines USING (r)
), b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars::BIGINT AS word_chars, n_symbols, n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND n_words - lost >= 20 AND 100 * (n_words - lost) >= 50 * n_words AS kept
FROM b
"""


@query
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.align(table(spark, folder, "documents"))


@query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.quantised(table(spark, folder, "embeddings")), F.col("vec_id") % 50 == 0)


ORACLES["op13_hard_negatives"] = """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.e) = len(b.e)
), p AS (
    SELECT a, anchor_id, b, id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id, b) <= 5
), n AS (
    SELECT p.anchor_id, p.positive_id, p.positive_score, s.id AS negative_id, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.id, s.b) AS rank
    FROM p JOIN s ON p.a = s.a AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
