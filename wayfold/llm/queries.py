"""Queries over the given tables, one per operator, and the same results in SQL where SQL has them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate,
    embedding_dups,
    hard_negatives,
    html_main,
    language_id,
    license_scan,
    ngram_join,
    ordinal_quality,
    packing,
    quality_rules,
    token_align,
    token_scan,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def op1_ngram_join(spark, folder):
    plan = ngram_join.Plan(words=4, num=85, den=100)
    out = ngram_join.jaccard_components(_table(spark, folder, "documents"), plan)
    return out.select("doc_id", "n_shingles", "component_id", "class_id")


def op2_toxicity(spark, folder):
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    labels = labels.select("doc_id", (1 - F.col("quality")).alias("poor"), "toxic")
    chain = toxicity.fit(docs, labels, ["poor", "toxic"])
    return toxicity.scored(docs.select("doc_id", "text"), chain).select("doc_id", "p_poor", "p_toxic", F.col("is_toxic").alias("toxic"))


def op3_decontamination(spark, folder):
    found = decontaminate.hits(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), 10)
    hit = decontaminate.n_hit(F.col("spans"))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op4_quality_classifier(spark, folder):
    docs = _table(spark, folder, "documents")
    model = ordinal_quality.fit(docs, ordinal_quality.grades(_table(spark, folder, "labels")))
    return ordinal_quality.graded(docs.select("doc_id", "text"), model).drop("text")


def op5_html_extraction(spark, folder):
    pages = _table(spark, folder, "pages")
    return html_main.extracted(pages, html_main.fit(pages))


def op6_quality_rules(spark, folder):
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = quality_rules.cascade(docs, report=measures)
    base = [rule.rejects({x: F.col(x) for x in measures}) for rule in quality_rules.BASE]
    return judged.select(
        "doc_id", *measures, (base[0] | base[1]).alias("base_failed"), F.col("rejected_by").isNull().alias("kept")
    )


def op7_license_scan(spark, folder):
    return license_scan.licenses(_table(spark, folder, "documents"))


def op8_token_counts(spark, folder):
    return token_scan.document_token_counts(_table(spark, folder, "documents"))


def op9_best_fit_packing(spark, folder):
    return packing.packed(_table(spark, folder, "documents"))


def op10_language_id(spark, folder):
    docs = _table(spark, folder, "documents")
    held_out = language_id.held_out(F.col("doc_id"))
    model = language_id.fit(docs.where(~held_out).select("doc_id", "text", "lang"))
    found = language_id.predicted(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_embedding_dups(spark, folder):
    return embedding_dups.near_duplicates(_table(spark, folder, "embeddings"), 0.98)


def op12_token_align(spark, folder):
    return token_align.alignment(_table(spark, folder, "documents").withColumn("doc_id", F.col("doc_id").cast("long")))


def op13_hard_negatives(spark, folder):
    rows = _table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Query] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_html_extraction": op5_html_extraction,
    "op6_quality_rules": op6_quality_rules,
    "op7_license_scan": op7_license_scan,
    "op8_token_counts": op8_token_counts,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_language_id": op10_language_id,
    "op11_embedding_dups": op11_embedding_dups,
    "op12_token_align": op12_token_align,
    "op13_hard_negatives": op13_hard_negatives,
}

_OP3 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (
  SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
  FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS t FROM bi),
k AS (SELECT DISTINCT k FROM bw),
di AS (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, k WHERE len(w) >= k),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS t FROM di),
hit AS (SELECT doc_id, i, k, item_id FROM dw JOIN bw USING (k, t)),
places AS (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM hit),
n AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
items AS (
  SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP6 = r"""
WITH d AS (
  SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 7], ' ')) AS n FROM i),
rep AS (
  SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS covered
  FROM win WHERE n > 1),
r AS (SELECT doc_id, sum(covered) AS n FROM rep GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(w, lambda x: regexp_matches(x, '[^\x00-\x40\x5B-\x60\x7B-\x7F]'))) AS n_letter_words,
    len(list_filter(lines, lambda x: regexp_matches(x, '\A[\x20\x09-\x0D]*[-*\x{2022}]'))) AS n_bullet_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|\x{2026})[\x20\x09-\x0D]*\z'))) AS n_open_lines
  FROM d LEFT JOIN r USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 15 * word_chars OR 100 * n_dup_lines > 30 * n_lines
    OR 100 * word_chars > 2000 * n_words OR 100 * word_chars < 200 * n_words
    OR 100 * n_letter_words < 50 * n_words OR n_bullet_lines >= 5 AND 100 * n_bullet_lines > 90 * n_lines
    OR n_open_lines >= 5 AND 100 * n_open_lines > 30 * n_lines) AS kept
FROM f
"""

_OP11 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reached AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
c AS (SELECT a, min(b) AS smallest FROM reached GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(smallest, vec_id) AS component_id,
  coalesce(smallest, vec_id) IS NOT DISTINCT FROM vec_id AS kept
FROM embeddings LEFT JOIN c ON vec_id = c.a LEFT JOIN n ON vec_id = n.a
"""

_OP13 = """
WITH v AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
  AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) <= 10
"""

ORACLES: dict[str, str] = {
    "op3_decontamination": _OP3,
    "op6_quality_rules": _OP6,
    "op11_embedding_dups": _OP11,
    "op13_hard_negatives": _OP13,
}
