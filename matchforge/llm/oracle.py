"""SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "op5_top_products": """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS w
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5""",
}
