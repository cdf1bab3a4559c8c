"""op4: near-duplicate ``embeddings`` of one label by cosine >= 0.98."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm.common import read
from panelcast.llm.nn_descent import near_duplicates

SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT vec_id AS u, vec_id AS r FROM embeddings UNION SELECT reach.u, links.v FROM reach JOIN links ON links.u = reach.r),
found AS (
  SELECT u, min(r) AS component_id FROM reach GROUP BY u)
SELECT u AS vec_id, (SELECT count(*) FROM links l WHERE l.u = found.u) AS n_links, component_id, u = component_id AS kept FROM found
"""


def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
