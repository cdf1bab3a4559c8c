"""op6: token files of ``documents``, written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm.common import read
from panelcast.llm.pfor import roundtrip
from panelcast.llm.tokens import tokenizer_path

END_ID = 1


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return roundtrip(docs, tokenizer_path(), END_ID).withColumnRenamed("id", "doc_id")
