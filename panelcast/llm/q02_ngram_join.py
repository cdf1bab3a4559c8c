"""op2: near-duplicate components of ``documents`` by word 5-gram Jaccard >= 0.8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm.common import read
from panelcast.llm.ngram_join import near_duplicates

SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id AS u, doc_id AS r FROM documents UNION SELECT reach.u, links.v FROM reach JOIN links ON links.u = reach.r)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT u, min(r) AS component_id FROM reach GROUP BY u) ON u = d.doc_id
"""


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("id", "n_shingles", "component_id").withColumnRenamed("id", "doc_id")
