"""op5: the 5 nearest rows of ``embeddings`` for every 50th vector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import read
from panelcast.llm.multi_index import search

NEAREST, QUERY_STEP = 5, 50


def is_query():
    return F.col("id") % QUERY_STEP == 0


def op5_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search(read(spark, sf_dir, "embeddings"), is_query(), NEAREST)
    return found.withColumnRenamed("id", "vec_id").select("query_id", "rank", "vec_id", "score")
