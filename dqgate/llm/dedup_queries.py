"""Queries over groups of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from dqgate.llm import jaccard_join, simhash
from dqgate.llm.common import table
from dqgate.llm.registry import query


@query("op5_simhash_dedup")
def op5_simhash_dedup(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# Shared shingles of all pairs, then reachability.
_JACCARD_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM w
), n AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM n a JOIN n b ON a.g = b.g AND a.doc_id <> b.doc_id AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), r AS (
  WITH RECURSIVE reach(a, b) AS (SELECT a, b FROM p UNION SELECT reach.a, p.b FROM reach JOIN p ON reach.b = p.a) SELECT * FROM reach
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(m.b, s.doc_id)) AS component_id
FROM s LEFT JOIN (SELECT a, min(b) AS b FROM r GROUP BY a) m ON m.a = s.doc_id
"""


@query("op13_jaccard_join", _JACCARD_SQL)
def op13_jaccard_join(spark, sf_dir):
    return jaccard_join.linked_documents(table(spark, sf_dir, "documents"))
