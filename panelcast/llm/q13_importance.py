"""op13: importance resampling of ``documents`` towards ``benchmark``. SQL has no CRC-32;
tests compare with a brute-force version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm.common import read
from panelcast.llm.importance import resample


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select("id", "n_features", "weight", "score", "rank").withColumnRenamed("id", "doc_id")
