"""Training corpus pipeline over ``documents``: quality classifier, line
de-duplication, near-duplicate removal, packing. Each stage is written as
Parquet in the shared folder and read again by the next.

Defined results: null and empty texts get the classifier's share of good labels
and stay if it reaches the threshold; they are one empty line, link with nothing
and end as a piece of one token, the end id. Without labels the classifier keeps
every document. Equal texts are near-duplicates: the smallest doc_id stays. Rows
that repeat a doc_id are judged each for itself by the classifier. Extra columns
pass through all stages but the last. Empty tables give empty tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm import line_dedup, ngram_join, packing, quality_vote
from panelcast.llm.common import Work, read
from panelcast.llm.q07_packing import END_ID
from panelcast.llm.tokens import tokenizer_path

#: SQL has no tokenizer and no classifier; tests compare with a brute-force version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_vote.keep_good(docs, quality_vote.fit(docs, read(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; n_chars follows the text."""
    return line_dedup.dedup_lines(docs, length_col="n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return ngram_join.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 4096 tokens."""
    return packing.pack(docs, tokenizer_path(), END_ID).withColumnRenamed("id", "doc_id")


STAGES = [("quality classifier", quality), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work, docs = Work(spark, "corpus-pipeline"), read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = work.table(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
