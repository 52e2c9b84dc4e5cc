"""Queries over vectors."""

from __future__ import annotations

from dqgate.llm import topk
from dqgate.llm.common import table
from dqgate.llm.registry import query

_TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id) AS rank
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
) WHERE rank <= 20
"""


@query("op4_exact_topk", _TOPK_SQL)
def op4_exact_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
