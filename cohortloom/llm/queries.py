"""Queries of the training-data problems, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortloom.llm import packing, spam, tokens, topn, vectors
from cohortloom.session import table

PROFILE_SIZE, NEAR, LEAST_SIMILARITY, BEST = 48, 5, 0.9, 5


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "matrix_rows")
    return vectors.neighbour_pairs(vectors.nearest(rows, "row_key", "row_values", PROFILE_SIZE, NEAR, LEAST_SIMILARITY))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.top_n(table(spark, sf_dir, "matrix_cells"), "col_id", "row_id", "cell_value", BEST)


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_texts(table(spark, sf_dir, "documents"))


def p8_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.decode_ids(p8_ids(spark, sf_dir))


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return packing.pack(tokens.count_tokens(documents), "doc_id", "n_tokens", total=documents.count())


def p9_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_report(p9_containers(spark, sf_dir))


def p9_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each document is placed, its pieces follow each other, and its containers hold no more than they can."""
    pieces = p9_containers(spark, sf_dir)
    return packing.placement_report(pieces, "doc_id")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam.spam_pages(table(spark, sf_dir, "documents"))


def p10_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam.page_features(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p6_found, p8_ids, p8_decoded, p9_containers, p9_fill, p9_placed, p10_found, p10_figures)}

_PROFILES = """
WITH p AS (
  SELECT row_key, row_values AS v FROM matrix_rows
  WHERE len(row_values) = 48 AND len(list_filter(row_values, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_min(row_values) < list_max(row_values)
), z AS (
  SELECT row_key, list_transform(v, lambda x: x - list_avg(v)) AS c FROM p
), u AS (
  SELECT row_key, CAST(list_transform(c, lambda x: x / sqrt(list_inner_product(c, c))) AS DOUBLE[48]) AS u FROM z
), s AS (
  SELECT a.row_key AS k, b.row_key AS o, round(array_inner_product(a.u, b.u), 6) AS sim FROM u a JOIN u b ON a.row_key <> b.row_key
  WHERE array_inner_product(a.u, b.u) >= 0.8999
), r AS (
  SELECT k, o FROM s WHERE sim >= 0.9 QUALIFY row_number() OVER (PARTITION BY k ORDER BY sim DESC, o) <= 5
)
SELECT DISTINCT least(k, o) AS key_a, greatest(k, o) AS key_b FROM r
"""

ORACLES = {
    "p1_found": _PROFILES,
    "p6_found": """
SELECT col_id, row_id, rank_no FROM (
  SELECT col_id, row_id, row_number() OVER (PARTITION BY col_id ORDER BY v DESC, row_id) AS rank_no
  FROM (SELECT col_id, row_id, max(cell_value) AS v FROM matrix_cells WHERE isfinite(cell_value) AND col_id IS NOT NULL AND row_id IS NOT NULL GROUP BY ALL)
) WHERE rank_no <= 5""",
    "p9_placed": "SELECT doc_id, coalesce(text, '') <> '' AS placed, true AS whole, true AS fits FROM documents",
    "p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
