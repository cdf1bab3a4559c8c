"""Catalogue: entity state, splits, folds, weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.operators.dedup import union_keep_last
from panelcast.operators.splits import (CONFIG_WEIGHTS, fold_table, holdout_split, recency_weights,
                                        split_90_10, split_profile, walk_forward)
from panelcast.operators.state import create_state, inject_state, update_state
from panelcast.plans.registry import Inputs, query, rounded
from panelcast.plans.sql import with_ctes
from panelcast.schema import Roles

R = Roles()

TRAIN = "SELECT * FROM sales_panel WHERE Date <= (SELECT MAX(Date) FROM sales_panel) - 14"
VAL = "SELECT * FROM sales_panel WHERE Date > (SELECT MAX(Date) FROM sales_panel) - 14"


@query("win_07_tail_n_state", with_ctes("""
SELECT Store AS entity, list(Sales ORDER BY Date) AS history
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY Store ORDER BY Date DESC) AS rn FROM sales_panel) t
WHERE rn <= 28 GROUP BY Store""", "sales_panel"))
def win_07_tail_n_state(spark, sf_dir):
    return create_state(Inputs(spark, sf_dir).panel(), R, 28)


@query("win_08_state_roll_forward", with_ctes("""
SELECT Store AS entity, list(Sales ORDER BY Date) AS history
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY Store ORDER BY Date DESC) AS rn
      FROM (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY Store ORDER BY Date DESC) AS r0 FROM train) a
            WHERE r0 <= 28
            UNION ALL SELECT *, 0 AS r0 FROM val) u) t
WHERE rn <= 28 GROUP BY Store""", "sales_panel", extra={"train": TRAIN, "val": VAL}))
def win_08_state_roll_forward(spark, sf_dir):
    """State from the training period, rolled forward with the holdout batch."""
    p = Inputs(spark, sf_dir).panel()
    train, val = holdout_split(p, R, 14)
    new_state, _summary = update_state(create_state(train, R, 28), val, R, 28, order_col="Customers")
    return new_state


@query("win_08_state_update_summary", with_ctes("""
SELECT COUNT(DISTINCT Store) AS updated_entities, COUNT(*) AS appended_values,
       (SELECT COUNT(DISTINCT Store) FROM sales_panel) AS state_entities FROM val""",
                                               "sales_panel", extra={"train": TRAIN, "val": VAL}))
def win_08_state_update_summary(spark, sf_dir):
    p = Inputs(spark, sf_dir).panel()
    train, val = holdout_split(p, R, 14)
    return update_state(create_state(train, R, 28), val, R, 28, order_col="Customers")[1]


def _state_rows_sql() -> str:
    return """SELECT Store, Sales, ROW_NUMBER() OVER (PARTITION BY Store ORDER BY Date DESC) AS rn FROM train"""


def _inject_sql(mode: str) -> str:
    lags = ", ".join(
        f"COALESCE(MAX(CASE WHEN s.rn = {k} THEN s.Sales END), 0.0) AS sales_lag_{k}" for k in (1, 7, 14, 28))
    if mode == "strict":
        rolls = ", ".join(
            f"ROUND(CASE WHEN COUNT(CASE WHEN s.rn <= {w} THEN 1 END) = {w} THEN AVG(CASE WHEN s.rn <= {w} "
            f"THEN s.Sales END) ELSE 0.0 END, 4) AS sales_rolling_mean_{w}" for w in (7, 14, 28))
    else:
        rolls = ", ".join(
            f"ROUND(CASE WHEN COUNT(s.rn) >= {w} THEN AVG(CASE WHEN s.rn <= {w} THEN s.Sales END) "
            f"WHEN COUNT(s.rn) = 0 THEN 0.0 "
            f"ELSE COALESCE(SUM(s.Sales), 0.0) / GREATEST(COUNT(s.rn), 7) END, 4) AS sales_rolling_mean_{w}"
            for w in (7, 14, 28))
    return with_ctes(f"""
SELECT v.Store, v.Date, {lags}, {rolls}
FROM val v LEFT JOIN st s ON v.Store = s.Store AND s.rn <= 28
GROUP BY v.Store, v.Date""", "sales_panel", extra={"train": TRAIN, "val": VAL, "st": _state_rows_sql()})


@query("jon_11_state_lookup_join", _inject_sql("strict"))
def jon_11_state_lookup_join(spark, sf_dir):
    """Holdout rows get lag / rolling features from the training-period state."""
    p = Inputs(spark, sf_dir).panel()
    train, val = holdout_split(p, R, 14)
    st = create_state(train, R, 28)
    return rounded(inject_state(val.select("Store", "Date"), st, R, mode="strict"))


@query("fun_09_state_array_features_padded", _inject_sql("pad"))
def fun_09_state_array_features_padded(spark, sf_dir):
    """Live-path rule: histories shorter than 7 are left-padded with zeros."""
    p = Inputs(spark, sf_dir).panel()
    train, val = holdout_split(p, R, 14)
    st = create_state(train, R, 28)
    return rounded(inject_state(val.select("Store", "Date"), st, R, mode="pad"))


@query("mld_01_chronological_90_10", with_ctes("""
SELECT CASE WHEN Date < sd THEN 'base' ELSE 'pool' END AS part, COUNT(*) AS rows, MIN(Date) AS min_date,
       MAX(Date) AS max_date
FROM sales_panel, (SELECT d AS sd FROM (SELECT d, ROW_NUMBER() OVER (ORDER BY d) - 1 AS i FROM
      (SELECT DISTINCT Date AS d FROM sales_panel) x) y
      WHERE i = (SELECT LEAST(GREATEST(CAST(FLOOR(COUNT(DISTINCT Date) * 0.9) AS BIGINT), 0), COUNT(DISTINCT Date) - 1) FROM sales_panel)) s
GROUP BY 1""", "sales_panel"))
def mld_01_chronological_90_10(spark, sf_dir):
    p = Inputs(spark, sf_dir).panel()
    base, pool = split_90_10(p, R)
    tagged = base.withColumn("part", F.lit("base")).unionByName(pool.withColumn("part", F.lit("pool")))
    return tagged.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.min("Date").alias("min_date"),
                                      F.max("Date").alias("max_date"))


@query("mld_02_holdout_split", with_ctes("""
SELECT split, COUNT(DISTINCT Date) AS days, MIN(Date) AS min_date, MAX(Date) AS max_date, COUNT(*) AS rows
FROM (SELECT *, 'train' AS split FROM train UNION ALL SELECT *, 'validation' AS split FROM val) u GROUP BY split
""", "sales_panel", extra={"train": TRAIN, "val": VAL}))
def mld_02_holdout_split(spark, sf_dir):
    """Holdout split profiled per side (AGG-20 over MLD-02)."""
    p = Inputs(spark, sf_dir).panel()
    train, val = holdout_split(p, R, 14)
    u = train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("validation")))
    return split_profile(u, R, "split")


@query("agg_20_split_profile", with_ctes("""
SELECT COUNT(DISTINCT Date) AS days, MIN(Date) AS min_date, MAX(Date) AS max_date, COUNT(*) AS rows FROM sales_panel
""", "sales_panel"))
def agg_20_split_profile(spark, sf_dir):
    return split_profile(Inputs(spark, sf_dir).panel(), R)


@query("mld_03_walk_forward_folds", with_ctes("""
SELECT b.fold, CASE WHEN p.Date < b.block_start THEN 'train' ELSE 'validation' END AS role,
       COUNT(*) AS rows, MIN(p.Date) AS min_date, MAX(p.Date) AS max_date
FROM sales_panel p JOIN b ON p.Date <= b.block_end GROUP BY 1, 2""", "sales_panel", extra={
    "dd": "SELECT DISTINCT Date AS d FROM sales_panel",
    "r": "SELECT d, ROW_NUMBER() OVER (ORDER BY d DESC) - 1 AS r FROM dd",
    "f": "SELECT d, CAST(FLOOR((55 - r) / 14) + 1 AS INT) AS fold FROM r WHERE r < 56",
    "b": "SELECT fold, MIN(d) AS block_start, MAX(d) AS block_end FROM f GROUP BY fold"}))
def mld_03_walk_forward_folds(spark, sf_dir):
    """4 expanding folds x 14 days: rows per (fold, role)."""
    tagged = walk_forward(Inputs(spark, sf_dir).panel(), R, 4, 14)
    return tagged.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("rows"), F.min("Date").alias("min_date"),
                                              F.max("Date").alias("max_date"))


@query("win_13_recency_weights", with_ctes("""
SELECT Store, Date, Promo, CAST(CASE WHEN Promo = 1 AND age <= 30 THEN 5.0 WHEN Promo = 1 AND age > 30 AND age <= 60 THEN 3.0
  WHEN Promo = 1 AND age > 60 AND age <= 120 THEN 1.5 ELSE 1.0 END AS FLOAT) AS weight
FROM (SELECT *, (SELECT MAX(Date) FROM train) - Date AS age FROM train) t""", "sales_panel", extra={"train": TRAIN}))
def win_13_recency_weights(spark, sf_dir):
    """Configured tiers 5 / 3 / 1.5 / 1 on the training period."""
    p = Inputs(spark, sf_dir).panel()
    train, _ = holdout_split(p, R, 14)
    return recency_weights(train, R, CONFIG_WEIGHTS).select("Store", "Date", "Promo", "weight")


@query("agg_19_weight_distribution", with_ctes("""
SELECT weight, COUNT(*) AS count FROM (SELECT CAST(CASE WHEN Promo = 1 AND age <= 30 THEN 5.0 WHEN Promo = 1 AND age > 30 AND age <= 60 THEN 3.0
  WHEN Promo = 1 AND age > 60 AND age <= 120 THEN 1.5 ELSE 1.0 END AS FLOAT) AS weight
FROM (SELECT *, (SELECT MAX(Date) FROM train) - Date AS age FROM train) t) w GROUP BY weight""",
                                              "sales_panel", extra={"train": TRAIN}))
def agg_19_weight_distribution(spark, sf_dir):
    p = Inputs(spark, sf_dir).panel()
    train, _ = holdout_split(p, R, 14)
    return recency_weights(train, R, CONFIG_WEIGHTS).groupBy("weight").count()


@query("set_04_refit_union", with_ctes("""
SELECT Store, Date, Sales FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY Store, Date ORDER BY src DESC) AS rk
  FROM (SELECT Store, Date, Sales, 0 AS src FROM train UNION ALL SELECT Store, Date, Sales, 1 AS src FROM val) u) x
WHERE rk = 1""", "sales_panel", extra={"train": TRAIN, "val": VAL}))
def set_04_refit_union(spark, sf_dir):
    """Final-refit set: train + validation, keep last per (Store, Date)."""
    p = Inputs(spark, sf_dir).panel().select("Store", "Date", "Sales")
    train, val = holdout_split(p, R, 14)
    return union_keep_last([train, val], ["Store", "Date"])
