"""op9: quality scores of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import read
from panelcast.llm.quality_vote import THRESHOLD, fit, held_out, score


def op9_quality_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, read(spark, sf_dir, "labels")))
    return scored.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
