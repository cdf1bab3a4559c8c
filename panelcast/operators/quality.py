"""Data-quality profile: missingness, unseen categories, status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _is_missing(df: DataFrame, c: str):
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def missingness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """AGG-10: null (and NaN) rate per column: one aggregate for all columns,
    then ``unpivot`` to (column, missing_rate)."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.avg(_is_missing(df, c).cast("double")).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "missing_rate")


def unpivot_as_text(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, value) pairs with values as text, nulls dropped."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in features
    ])).alias("kv")).select("kv.feature", "kv.value").filter(F.col("value").isNotNull())


def unseen_categories(current: DataFrame, reference: DataFrame, features: Sequence[str],
                      examples: int = 20) -> DataFrame:
    """AGG-11: distinct text values in current not in reference, per feature:
    count and the first ``examples`` sorted values, comma-joined.

    distinct -> left-anti join -> count; the examples use a rank filter
    that Spark turns into a per-partition group limit before the shuffle, so
    no task collects more than ``examples`` values of a feature.
    Features absent from either side are skipped (reported separately).
    """
    feats = [f for f in features if f in current.columns and f in reference.columns]
    cur = unpivot_as_text(current, feats).distinct()
    ref = unpivot_as_text(reference, feats).distinct()
    unseen = cur.join(ref, ["feature", "value"], "left_anti")
    rk = F.row_number().over(Window.partitionBy("feature").orderBy("value"))
    firsts = unseen.withColumn("_rk", rk).filter(F.col("_rk") <= examples).groupBy("feature").agg(
        F.array_join(F.array_sort(F.collect_list("value")), ",").alias("unseen_categories"))
    counts = unseen.groupBy("feature").agg(F.count(F.lit(1)).alias("unseen_category_count"))
    base = current.sparkSession.createDataFrame([(f,) for f in feats], "feature string")
    return (base.join(counts, "feature", "left").join(firsts, "feature", "left")
            .select("feature", F.coalesce("unseen_category_count", F.lit(0)).alias("unseen_category_count"),
                    F.coalesce("unseen_categories", F.lit("")).alias("unseen_categories")))


def quality_status(current: DataFrame, reference: DataFrame, features: Sequence[str],
                   enabled: bool = True) -> DataFrame:
    """AGG-12: disabled / empty / warning (any missing rate or unseen count
    > 0) / ok, with the row count; one row."""
    rows = current.agg(F.count(F.lit(1)).alias("row_count"))
    if not enabled:
        return rows.withColumn("quality_status", F.lit("disabled"))
    miss = missingness(current).agg(F.max("missing_rate").alias("max_missing_rate"))
    unseen = unseen_categories(current, reference, features).agg(
        F.coalesce(F.sum("unseen_category_count"), F.lit(0)).alias("unseen_total"))
    # One-row tables side by side (scalar subqueries, no join of facts).
    out = rows.select("row_count", miss.scalar().alias("max_missing_rate"), unseen.scalar().alias("unseen_total"))
    status = (F.when(F.col("row_count") == 0, F.lit("empty"))
              .when((F.coalesce("max_missing_rate", F.lit(0.0)) > 0) | (F.col("unseen_total") > 0), F.lit("warning"))
              .otherwise(F.lit("ok")))
    return out.withColumn("quality_status", status)
