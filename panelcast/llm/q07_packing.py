"""op7: ``documents`` packed into sequences of 4096 tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm.common import read
from panelcast.llm.packing import pack
from panelcast.llm.tokens import tokenizer_path

END_ID = 2


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, tokenizer_path(), END_ID).withColumnRenamed("id", "doc_id")
