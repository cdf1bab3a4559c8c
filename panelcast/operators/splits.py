"""Chronological splits and walk-forward folds.

Split dates are scalars computed by a small aggregate over distinct dates
and used as scalar subqueries; facts are then filtered (pushed into the
scan where possible), never collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from panelcast.schema import Roles


def split_date_90_10(df: DataFrame, roles: Roles = Roles(), fraction: float = 0.9) -> DataFrame:
    """One-row table with the split date = sorted unique dates[int(n*0.9)],
    index clamped to [0, n-1] (T26: over unique dates, not rows)."""
    dates = df.select(F.col(roles.time).cast("date").alias("d")).distinct()
    # Rank of each distinct date (the window spans distinct dates only: bounded by days).
    ranked = dates.withColumn("i", F.row_number().over(Window.orderBy("d")) - 1)
    n = dates.agg(F.count(F.lit(1)).alias("n"))
    idx = n.select(F.least(F.greatest(F.floor(F.col("n") * fraction), F.lit(0)), F.col("n") - 1).cast("long").alias("i"))
    return ranked.join(idx, "i").select(F.col("d").alias("split_date"))


def split_90_10(df: DataFrame, roles: Roles = Roles(), fraction: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """MLD-01: base = date < split date; held-back pool = date >= split date."""
    sd = split_date_90_10(df, roles, fraction).scalar()
    d = F.col(roles.time).cast("date")
    return df.filter(d < sd), df.filter(d >= sd)


def holdout_split(df: DataFrame, roles: Roles = Roles(), days: int = 14) -> tuple[DataFrame, DataFrame]:
    """MLD-02: the last ``days`` days by max date validate, the rest trains
    (14 normally, 7 in a drift run). max(date) is a scalar subquery."""
    last = df.agg(F.max(F.col(roles.time).cast("date"))).scalar()
    cut = F.date_sub(last, days)
    d = F.col(roles.time).cast("date")
    return df.filter(d <= cut), df.filter(d > cut)


def fold_table(df: DataFrame, roles: Roles = Roles(), folds: int = 4, days: int = 14) -> DataFrame:
    """MLD-03: the last folds*days unique dates cut into consecutive blocks.

    Returns one row per (fold, validation date) with the fold's block start
    (training uses dates < block start: expanding window). The ranking runs
    over distinct dates only.
    """
    dates = df.select(F.col(roles.time).cast("date").alias("d")).distinct()
    need = folds * days
    if dates.limit(need + 1).count() <= need:   # bounded check
        raise ValueError("Not enough unique dates for the requested walk-forward folds.")
    ranked = dates.withColumn("r", F.row_number().over(Window.orderBy(F.col("d").desc())) - 1)
    tail = ranked.filter(F.col("r") < need)
    t = tail.withColumn("fold", (F.floor((need - 1 - F.col("r")) / days) + 1).cast("int"))
    start = F.min("d").over(Window.partitionBy("fold"))
    return t.select("fold", F.col("d").alias("validation_date"), start.alias("train_end_exclusive"))


def _fold_blocks(df: DataFrame, roles: Roles, folds: int, days: int) -> DataFrame:
    ft = fold_table(df, roles, folds, days)
    return ft.groupBy("fold").agg(F.min("train_end_exclusive").alias("block_start"),
                                  F.max("validation_date").alias("block_end"))


def fold_limits(df: DataFrame, roles: Roles = Roles(), folds: int = 4, days: int = 14) -> list[Row]:
    """(fold, block_start, block_end) of every fold, read once (one row a fold)."""
    return _fold_blocks(df, roles, folds, days).orderBy("fold").collect()


def walk_forward(df: DataFrame, roles: Roles = Roles(), folds: int = 4, days: int = 14,
                 limits: Sequence[Row] | None = None) -> DataFrame:
    """MLD-03 applied: rows tagged with (fold, role) where role is train for
    dates before the fold's block and validation inside the block.

    The blocks (one entry per fold) are a scalar subquery: each row is tagged
    with the folds it belongs to without a join. With ``limits`` (from ``fold_limits``) the
    folds are a union of date filters instead, for a table that is read fold by fold: a
    filter on fold and role leaves one scan with a limit of its dates, where the subquery
    would run in every such plan and every row be copied for all folds first.
    """
    if limits is not None:
        d = F.col(roles.time).cast("date")
        return reduce(DataFrame.unionAll, [df.filter(d <= F.lit(b.block_end)).select(
            *df.columns, F.lit(b.fold).alias("fold"), F.lit(b.block_start).alias("block_start"),
            F.lit(b.block_end).alias("block_end"),
            F.when(d < F.lit(b.block_start), "train").otherwise("validation").alias("role")) for b in limits])
    blocks = _fold_blocks(df, roles, folds, days)
    listed = blocks.agg(F.array_sort(F.collect_list(F.struct("fold", "block_start", "block_end"))).alias("b")).scalar()
    d = F.col(roles.time).cast("date")
    tagged = df.withColumn("_blocks", listed).withColumn("_d", d)
    tagged = tagged.select(*df.columns, "_d", F.explode(F.filter("_blocks", lambda b: F.col("_d") <= b["block_end"])).alias("_b"))
    return tagged.select(*df.columns, F.col("_b.fold").alias("fold"), F.col("_b.block_start").alias("block_start"),
                         F.col("_b.block_end").alias("block_end"),
                         F.when(F.col("_d") < F.col("_b.block_start"), "train").otherwise("validation").alias("role"))


# Recency tiers (age upper bounds in days) and the code
# default weights; the configuration uses 5 / 3 / 1.5 / 1.
RECENCY_TIER_DAYS = (30, 60, 120)
CODE_DEFAULT_WEIGHTS = (10.0, 5.0, 2.0, 1.0)
CONFIG_WEIGHTS = (5.0, 3.0, 1.5, 1.0)


def recency_weights(df: DataFrame, roles: Roles = Roles(), weights=CODE_DEFAULT_WEIGHTS,
                    tiers=RECENCY_TIER_DAYS, promo_only: bool = True, name: str = "weight") -> DataFrame:
    """WIN-13: age = max(date) - date (scalar subquery); promo rows within
    30 / 60 / 120 days get tier weights, everything else the default;
    float32 like the reference."""
    d = F.col(roles.time).cast("date")
    last = df.agg(F.max(d)).scalar()
    age = F.datediff(last, d)
    promo = F.coalesce(F.col(roles.promo).cast("string").try_cast("double"), F.lit(0.0)) == 1
    gate = promo if promo_only else F.lit(True)
    w = (F.when(gate & (age <= tiers[0]), weights[0])
         .when(gate & (age > tiers[0]) & (age <= tiers[1]), weights[1])
         .when(gate & (age > tiers[1]) & (age <= tiers[2]), weights[2])
         .otherwise(weights[3]))
    return df.withColumn(name, w.cast("float"))


def split_profile(df: DataFrame, roles: Roles = Roles(), split_col: str | None = None) -> DataFrame:
    """AGG-20: distinct days, min / max date and rows (per split)."""
    d = F.col(roles.time).cast("date")
    keys = [split_col] if split_col else []
    return df.groupBy(*keys).agg(F.count_distinct(d).alias("days"), F.min(d).alias("min_date"),
                                 F.max(d).alias("max_date"), F.count(F.lit(1)).alias("rows"))
