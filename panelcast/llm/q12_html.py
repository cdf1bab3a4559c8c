"""op12: main text of ``pages``. SQL cannot parse html; tests compare with written pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import read
from panelcast.llm.wrapper_induction import main_texts


def op12_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = main_texts(read(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
