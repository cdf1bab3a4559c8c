"""op11: periodic runs of ``documents``, one document in ten made periodic first. SQL has
no CRC-32; tests compare with a brute-force version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import SPACE, read
from panelcast.llm.periodic_runs import periodic_runs


def made_periodic(docs: DataFrame) -> DataFrame:
    """(doc_id, text): where crc32(doc_id) ends in 0, the words from a on repeat the
    first p of them; other texts, and rows without an id, stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.split(F.trim("text", F.lit(SPACE)), "[ \\t\\n\\x0B\\f\\r]+")
    g, n = F.floor(h / 10), F.size("words")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    named = (docs.select("doc_id", "text", h.alias("h"))
             .withColumn("words", F.when((F.col("h") % 10 == 0) & (F.trim("text", F.lit(SPACE)) != ""), words))
             .withColumn("a", a.cast("int")).withColumn("p", p.cast("int")))
    picked = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(
        "words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))))
    return named.select("doc_id", F.when(F.col("words").isNull(), F.col("text"))
                        .otherwise(F.array_join(picked, " ")).alias("text"))


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared as whole products; the first
    of equal ones (runs are in order of start, period)."""
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(
        r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(made_periodic(read(spark, sf_dir, "documents")))
    found = found.withColumn("best", strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))
