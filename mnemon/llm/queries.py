"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mnemon.llm import decontam, embed_dedup, jaccard_join, langid, pieceset, pii, sharding, toxicity, url_filter, warc


#: The public SentencePiece model that op4 encodes with.
PIECE_MODEL = os.environ.get("MNEMON_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), 16)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn(docs))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieceset.encode(_table(spark, sf_dir, "documents"), PIECE_MODEL)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_passages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive(_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_sharding, op2_url_filters, op3_language_id, op4_sentencepiece, op5_decontamination, op6_toxicity, op7_embedding_dedup, op8_pii, op9_jaccard_join, op10_warc)}


#: Words of op9: A-Z lower-cased, parted at the six ASCII white-space characters.
_JACCARD_SQL = r"""
WITH RECURSIVE told AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM told
), flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets
), met AS (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS shared
  FROM flat a JOIN flat b ON a.t = b.t AND a.doc_id < b.doc_id AND a.n * 100 >= b.n * 75 AND b.n * 100 >= a.n * 75 GROUP BY ALL
), links AS (SELECT x, y FROM met WHERE 100 * shared >= 75 * (nx + ny - shared)
), ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach(node, root) AS (
  SELECT DISTINCT x, x FROM ways UNION SELECT ways.y, reach.root FROM reach JOIN ways ON ways.x = reach.node
), least AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(root, doc_id) AS component_id FROM sets LEFT JOIN least ON node = doc_id
"""

_COSINE_SQL = """
WITH RECURSIVE told AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
), sound AS (
  SELECT vec_id, v FROM told WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v)) / sqrt(list_dot_product(b.v, b.v)) >= 0.95
), reach(node, root) AS (
  SELECT DISTINCT x, x FROM links UNION SELECT links.y, reach.root FROM reach JOIN links ON links.x = reach.node
), least AS (SELECT node, min(root) AS root FROM reach GROUP BY node), many AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN least ON node = vec_id LEFT JOIN many ON x = vec_id
"""

_WARC_SQL = """
WITH told AS (
  SELECT page_id, url, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), first AS (SELECT payload_digest AS d, max(page_id) AS response FROM told WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN response <> page_id THEN response END AS refers_to, url
FROM told LEFT JOIN first ON d = payload_digest
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB's answer, where SQL can give it: not to hashes that DuckDB lacks, nor to what is learned."""
    return {"op7_embedding_dedup": _COSINE_SQL, "op9_jaccard_join": _JACCARD_SQL, "op10_warc": _WARC_SQL}
