"""Join operators: dimension joins, checked joins, alignment, anti joins.

Strategy is left to Catalyst and AQE: a side is broadcast only when its
size estimate is under ``spark.sql.autoBroadcastJoinThreshold``, otherwise
the join is a shuffle join on the keys; AQE re-plans at runtime and splits
skewed keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.scalar import integral_key
from panelcast.operators.dedup import dedup_last


def join_dimension(fact: DataFrame, dim: DataFrame, keys: str | Sequence[str], how: str = "left") -> DataFrame:
    """JON-01: fact x dimension left join on the entity key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return fact.join(dim, keys, how)


def join_dimension_required(fact: DataFrame, dim: DataFrame, keys: str | Sequence[str],
                            required: str = "Promo2") -> DataFrame:
    """JON-02: left join where every row must match (``required`` non-null);
    a miss raises at execution inside the plan."""
    out = join_dimension(fact, dim, keys, "left")
    return out.withColumn(required, F.when(F.col(required).isNotNull(), F.col(required)).otherwise(
        F.raise_error(F.lit(f"Missing store metadata after merge ({required} is null)")).cast(
            out.schema[required].dataType)))


def coerce_keys(df: DataFrame, entity: str = "Store", time: str = "Date") -> DataFrame:
    """Keys coerced (bad values -> NULL) and NULL keys dropped."""
    return (df.withColumn(entity, integral_key(df, entity))
              .withColumn(time, F.col(time).cast("date"))
              .dropna(subset=[entity, time]))


def join_predictions_truth(preds: DataFrame, truth: DataFrame, keys: Sequence[str] = ("Store", "Date")) -> DataFrame:
    """JON-06: predictions x ground truth inner join (duplicates fan out, as
    in the reference); keys coerced and NULL keys dropped on both sides."""
    keys = list(keys)
    return coerce_keys(preds, *keys).join(coerce_keys(truth, *keys), keys, "inner")


def join_one_to_one(a: DataFrame, b: DataFrame, keys: Sequence[str], order_a: str, order_b: str) -> DataFrame:
    """JON-07: both sides de-duplicated keep-last (explicit order), then inner
    join; after the de-duplication the keys are unique by construction."""
    return dedup_last(a, keys, order_a).join(dedup_last(b, keys, order_b), list(keys), "inner")


def align_common_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """JON-08: keep in both frames only keys found in both (two semi joins)."""
    ka, kb = a.select(*keys).distinct(), b.select(*keys).distinct()
    return a.join(kb, list(keys), "left_semi"), b.join(ka, list(keys), "left_semi")


def join_runs(a: DataFrame, b: DataFrame, on: str = "day", suffixes: tuple[str, str] = ("_without", "_with")) -> DataFrame:
    """JON-12: two runs joined on the day; other columns get suffixes."""
    ra = a.select(on, *[F.col(c).alias(c + suffixes[0]) for c in a.columns if c != on])
    rb = b.select(on, *[F.col(c).alias(c + suffixes[1]) for c in b.columns if c != on])
    return ra.join(rb, on, "inner")


def new_batches(batches: DataFrame, processed: DataFrame, id_col: str = "batch_id") -> DataFrame:
    """JON-13: batches whose content id is neither processed nor repeated in this run."""
    return batches.dropDuplicates([id_col]).join(processed.select(id_col), id_col, "left_anti")


def align_category_counts(ref: DataFrame, cur: DataFrame, col: str) -> DataFrame:
    """JON-14: counts of both samples over the union of categories, absent = 0.

    One conditional aggregate over the union (one shuffle) instead of two
    aggregates and a full outer join.
    """
    u = ref.select(F.col(col).alias("category"), F.lit(1).alias("_r")).unionByName(
        cur.select(F.col(col).alias("category"), F.lit(0).alias("_r")))
    return u.groupBy("category").agg(F.sum("_r").alias("reference_count"),
                                     F.sum(1 - F.col("_r")).alias("current_count"))


def last_n_keys(df: DataFrame, col: str, n: int) -> DataFrame:
    """The last ``n`` distinct values of ``col`` (distributed top-k, n rows)."""
    return df.select(col).distinct().orderBy(F.col(col).desc()).limit(n)


def in_last_n(df: DataFrame, col: str, n: int) -> DataFrame:
    """JON-15: rows whose ``col`` is one of the last n distinct values
    (top-k of distinct values, then a semi join: no global window)."""
    return df.join(last_n_keys(df, col, n), col, "left_semi")


def compare_predictions(a: DataFrame, b: DataFrame, keys: Sequence[str], col: str = "prediction",
                        tolerance: float = 1e-6) -> tuple[DataFrame, DataFrame]:
    """JON-16: the same rows scored by two paths, joined on the row key (not
    position): per-row diff and a one-row summary."""
    j = a.select(*keys, F.col(col).alias("a")).join(b.select(*keys, F.col(col).alias("b")), list(keys), "inner")
    rows = j.withColumn("diff", F.col("a") - F.col("b")).withColumn("abs_diff", F.abs(F.col("diff")))
    summary = rows.agg(F.count(F.lit(1)).alias("rows"), F.max("abs_diff").alias("max_abs_diff"),
                       F.avg("abs_diff").alias("mean_abs_diff"),
                       F.count_if(F.col("abs_diff") > tolerance).alias("rows_over_tolerance"))
    return rows, summary
