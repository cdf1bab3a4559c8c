"""op3: BPE ids and decoded texts of ``documents``, as digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm.bpe_roundtrip import digest_column
from panelcast.llm.common import read
from panelcast.llm.tokens import tokenizer_path


def op3_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return digest_column(docs, "doc_id", "text", tokenizer_path()).withColumnRenamed("id", "doc_id")
