"""Catalogue: data quality and drift over the events table
(reference = events before 2024-01-16, current = from that day on)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from panelcast.operators.drift import (categorical_drift, drift_run, drift_summary, numeric_drift,
                                       persistent_degradation, persistent_drift, target_drift)
from panelcast.operators.joins import align_category_counts, in_last_n
from panelcast.operators.metrics import rolling_metrics
from panelcast.operators.quality import missingness, quality_status, unseen_categories
from panelcast.operators.splits import holdout_split
from panelcast.plans.registry import Inputs, query, rounded
from panelcast.plans.sql import with_ctes
from panelcast.schema import Roles
from panelcast.sources.adapters import DRIFT_SPLIT_TS, drift_samples

R = Roles()
NUMERIC = ["value", "user_id"]
CATEGORICAL = ["event_type", "user_id"]
UNSEEN_FEATURES = ["event_type", "user_id", "props"]
REF = f"SELECT * FROM events WHERE CAST(ts AS TIMESTAMP) < TIMESTAMP '{DRIFT_SPLIT_TS}'"
CUR = f"SELECT * FROM events WHERE CAST(ts AS TIMESTAMP) >= TIMESTAMP '{DRIFT_SPLIT_TS}'"
EV = {"ref": REF, "cur": CUR}
STORE_COLS = ["Store", "StoreType", "Assortment", "CompetitionDistance", "CompetitionOpenSinceMonth",
              "CompetitionOpenSinceYear", "Promo2", "Promo2SinceWeek", "Promo2SinceYear", "PromoInterval"]


def _samples(spark, sf_dir):
    return drift_samples(Inputs(spark, sf_dir).t.events)


@query("agg_10_missingness", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS column, ROUND(AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 4) AS missing_rate FROM store_dim"
    for c in STORE_COLS), "store_dim"))
def agg_10_missingness(spark, sf_dir):
    return rounded(missingness(Inputs(spark, sf_dir).store()))


def _unseen_sql() -> str:
    parts = []
    for f in UNSEEN_FEATURES:
        parts.append(f"""SELECT '{f}' AS feature, COUNT(v) AS unseen_category_count,
  COALESCE(string_agg(CASE WHEN rk <= 20 THEN v END, ',' ORDER BY v), '') AS unseen_categories
FROM (SELECT v, ROW_NUMBER() OVER (ORDER BY v) AS rk FROM (
   SELECT DISTINCT CAST({f} AS VARCHAR) AS v FROM cur WHERE {f} IS NOT NULL
   EXCEPT SELECT DISTINCT CAST({f} AS VARCHAR) FROM ref WHERE {f} IS NOT NULL) d) u""")
    return " UNION ALL ".join(parts)


@query("agg_11_unseen_categories", with_ctes(_unseen_sql(), extra=EV))
def agg_11_unseen_categories(spark, sf_dir):
    ref, cur = _samples(spark, sf_dir)
    return unseen_categories(cur, ref, UNSEEN_FEATURES)


@query("agg_12_quality_status", with_ctes(f"""
SELECT (SELECT COUNT(*) FROM cur) AS row_count,
       GREATEST({", ".join(f"(SELECT AVG(CASE WHEN {c} IS NULL OR (TRY_CAST({c} AS DOUBLE) IS NOT NULL AND isnan(TRY_CAST({c} AS DOUBLE)) AND typeof({c}) = 'DOUBLE') THEN 1.0 ELSE 0.0 END) FROM cur)" for c in ["event_id", "ts", "user_id", "event_type", "value", "props"])}) AS max_missing_rate,
       (SELECT SUM(unseen_category_count) FROM unseen) AS unseen_total,
       CASE WHEN (SELECT COUNT(*) FROM cur) = 0 THEN 'empty'
            WHEN (SELECT SUM(unseen_category_count) FROM unseen) > 0 THEN 'warning'
            ELSE 'ok' END AS quality_status""", extra={**EV, "unseen": _unseen_sql()}))
def agg_12_quality_status(spark, sf_dir):
    ref, cur = _samples(spark, sf_dir)
    return quality_status(cur, ref, UNSEEN_FEATURES)


def _ks_pvalue_sql(d: str, n: str, m: str) -> str:
    """Two-sample KS p-value, written for the oracle alone: up to 10,000 rows a side the
    chance of a lattice path to stay inside the band, folded over the diagonals; above it
    the corrected limit law. The accumulator is [first i, 0, chances..., 0]."""
    lim = f"CAST(ROUND({d} * {n} * {m}) AS BIGINT)"
    s = "CAST(x[1] AS BIGINT)"
    lo = f"GREATEST(0, {s} - {m}, CAST(FLOOR(({s} * {n} - {lim}) / ({n} + {m})) AS BIGINT) + 1)"
    hi = f"LEAST({n}, {s}, CAST(CEIL(({s} * {n} + {lim}) / ({n} + {m})) AS BIGINT) - 1)"
    at = "COALESCE(acc[CAST(i - acc[1] AS BIGINT) + {}], 0.0)"
    exact = (f"1.0 - COALESCE(list_reduce(list_transform(range(1, {n} + {m} + 1), lambda t: [CAST(t AS DOUBLE)]), "
             f"lambda acc, x: list_concat([CAST({lo} AS DOUBLE), 0.0], list_transform(range({lo}, {hi} + 1), "
             f"lambda i: (i * {at.format(2)} + ({s} - i) * {at.format(3)}) / {s}), [0.0]), "
             f"[CAST(0.0 AS DOUBLE), 0.0, 1.0, 0.0])[3], 0.0)")
    size = f"ROUND_EVEN(CAST({n} AS DOUBLE) * {m} / ({n} + {m}), 0)"
    z = f"({d} * SQRT({size}))"
    a, b = "(pi() * pi() * (k + 0.5) * (k + 0.5))", "(pi() * pi() * k * k)"

    def total(term: str, e: str) -> str:
        return f"list_sum(list_transform(range(-30, 31), lambda k: ({term}) * EXP(-{e} / (2 * {z} * {z}))))"

    def zp(e: int) -> str:
        return f"POW({z}, {e})"
    limit = (f"{total('1.0', a)} / {z} + {total(f'{a} - {zp(2)}', a)} / (6 * {zp(4)} * SQRT({size})) + ("
             + total(f"6 * {zp(6)} + 2 * {zp(4)} + (2 * {zp(4)} - 5 * {zp(2)}) * {a} + (1 - 2 * {zp(2)}) * {a} * {a}", a)
             + f" / (72 * {zp(7)}) - {total(b, b)} / (36 * {zp(3)})) / {size} + ("
             + total(f"(5 - 30 * {zp(2)}) * POW({a}, 3) + (212 * {zp(4)} - 60 * {zp(2)}) * {a} * {a} "
                     f"+ (135 * {zp(4)} - 96 * {zp(6)}) * {a} - 30 * {zp(6)} - 90 * {zp(8)}", a)
             + f" / (6480 * {zp(10)}) + {total(f'3 * {b} * {zp(2)} - {b} * {b}', b)} / (108 * {zp(6)})) / POW({size}, 1.5)")
    return (f"CASE WHEN {n} = 0 OR {m} = 0 OR {d} <= 0 THEN 1.0 WHEN GREATEST({n}, {m}) <= 10000 THEN {exact} "
            f"WHEN {d} >= 1 THEN 0.0 ELSE LEAST(GREATEST(1.0 - SQRT(pi() / 2) * ({limit}), 0.0), 1.0) END")


def _ks_sql(features, group: str | None = None, src_ref="ref", src_cur="cur", value_filter: str = "TRUE",
            min_samples: int = 50, p_thr: float = 0.01, stat_thr: float = 0.10, current_only: bool = False) -> str:
    g = f"{group}, " if group else ""
    longs = " UNION ALL ".join(
        f"SELECT {g}'{f}' AS feature, TRY_CAST({f} AS DOUBLE) AS v, 0 AS side FROM {src_ref} WHERE {value_filter.format(c=f)} "
        f"UNION ALL SELECT {g}'{f}' AS feature, TRY_CAST({f} AS DOUBLE) AS v, 1 AS side FROM {src_cur} WHERE {value_filter.format(c=f)}"
        for f in features)
    gk = f"{group}, " if group else ""
    part = f"PARTITION BY {gk}feature"
    short = "current_n < {m}" if current_only else "reference_n < {m} OR current_n < {m}"
    short = short.format(m=min_samples)
    p = _ks_pvalue_sql("d", "reference_n", "current_n")
    return f"""
SELECT {gk}feature, 'numeric' AS feature_type, 'ks' AS metric_type,
  ROUND(CASE WHEN {short} THEN 0.0 ELSE d END, 4) AS score,
  ROUND(CASE WHEN {short} THEN 1.0 ELSE p END, 4) AS p_value,
  CAST({stat_thr} AS DOUBLE) AS threshold,
  CASE WHEN {short} THEN false ELSE p < {p_thr} AND d > {stat_thr} END AS drift_detected,
  reference_n, current_n, CASE WHEN {short} THEN 'insufficient_samples' ELSE '' END AS reason
FROM (SELECT *, {p} AS p FROM (
  SELECT {gk}feature, MAX(ABS(CASE WHEN nr > 0 AND nc > 0 THEN cr / nr - cc / nc END)) AS d, CAST(MAX(nr) AS BIGINT) AS reference_n,
         CAST(MAX(nc) AS BIGINT) AS current_n
  FROM (SELECT {gk}feature, v, SUM(c_ref) OVER ({part} ORDER BY v) AS cr, SUM(c_cur) OVER ({part} ORDER BY v) AS cc,
               SUM(c_ref) OVER ({part}) AS nr, SUM(c_cur) OVER ({part}) AS nc
        FROM (SELECT {gk}feature, v, CAST(SUM(1 - side) AS DOUBLE) AS c_ref, CAST(SUM(side) AS DOUBLE) AS c_cur
              FROM ({longs}) l WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY ALL) c) w
  GROUP BY ALL) k0) k"""


@query("agg_13_numeric_drift_ks", with_ctes(_ks_sql(NUMERIC), extra=EV))
def agg_13_numeric_drift_ks(spark, sf_dir):
    ref, cur = _samples(spark, sf_dir)
    return rounded(numeric_drift(ref, cur, NUMERIC))


@query("agg_13_numeric_drift_ks_by_type", with_ctes(_ks_sql(["value"], group="event_type"), extra=EV))
def agg_13_numeric_drift_ks_by_type(spark, sf_dir):
    """KS of ``value`` per event type (grouped drift in one job)."""
    ref, cur = _samples(spark, sf_dir)
    return rounded(numeric_drift(ref, cur, ["value"], group_cols=["event_type"]))


_TRAIN = "SELECT * FROM sales_panel WHERE Date <= (SELECT MAX(Date) FROM sales_panel) - 14"
_VAL = "SELECT * FROM sales_panel WHERE Date > (SELECT MAX(Date) FROM sales_panel) - 14"


@query("agg_14_target_drift_ks", with_ctes(_ks_sql(["Sales"], src_ref="tr", src_cur="va", value_filter="{c} > 0",
                                                    p_thr=0.05, stat_thr=0.1, current_only=True),
                                            "sales_panel", extra={"tr": _TRAIN, "va": _VAL}))
def agg_14_target_drift_ks(spark, sf_dir):
    """Target drift: training period vs the 14-day holdout, Sales > 0."""
    p = Inputs(spark, sf_dir).panel()
    train, val = holdout_split(p, R, 14)
    return rounded(target_drift(train, val, "Sales", p_threshold=0.05))


def _erfc_sql(z: str) -> str:
    coeffs = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807,
              -1.13520398, 1.48851587, -0.82215223, 0.17087277]
    t = f"(1.0 / (1.0 + 0.5 * ABS({z})))"
    poly = f"CAST({coeffs[-1]!r} AS DOUBLE)"
    for c in reversed(coeffs[:-1]):
        poly = f"(CAST({c!r} AS DOUBLE) + {t} * {poly})"
    return f"({t} * EXP(-({z}) * ({z}) + {poly}))"


def _chi_sql(features, group: str | None = None) -> str:
    gk = f"{group}, " if group else ""
    longs = " UNION ALL ".join(
        f"SELECT {gk}'{f}' AS feature, COALESCE(CAST({f} AS VARCHAR), 'nan') AS v, 0 AS side FROM ref "
        f"UNION ALL SELECT {gk}'{f}' AS feature, COALESCE(CAST({f} AS VARCHAR), 'nan') AS v, 1 AS side FROM cur"
        for f in features)
    h = "(score / 2.0)"
    # Independent tail: sums over generate_series with lgamma instead of a recurrence.
    # -h stays inside the exponent: no term overflows.
    even = (f"(SELECT SUM(EXP(i * LN({h}) - lgamma(i + 1) - {h})) FROM generate_series(0, CAST(dof / 2 - 1 AS BIGINT)) g(i))")
    odd = (f"{_erfc_sql(f'SQRT({h})')} + COALESCE((SELECT SUM(EXP((i - 0.5) * LN({h}) - lgamma(i + 0.5) - {h})) "
           f"FROM generate_series(1, CAST((dof - 1) / 2 AS BIGINT)) g(i)), 0)")
    p = f"LEAST(GREATEST(CASE WHEN score <= 0 THEN 1.0 WHEN dof % 2 = 0 THEN {even} ELSE {odd} END, 0.0), 1.0)"
    short = "reference_n < 50 OR current_n < 50"
    return f"""
SELECT {gk}feature, 'categorical' AS feature_type, 'chisquare' AS metric_type,
  ROUND(CASE WHEN {short} THEN 0.0 ELSE score END, 4) AS score,
  ROUND(CASE WHEN {short} THEN 1.0 ELSE {p} END, 4) AS p_value, CAST(0.01 AS DOUBLE) AS threshold,
  CASE WHEN {short} THEN false ELSE {p} < 0.01 END AS drift_detected,
  reference_n, current_n, CASE WHEN {short} THEN 'insufficient_samples' ELSE '' END AS reason
FROM (
  SELECT {gk}feature, SUM((c_cur - e) * (c_cur - e) / e) AS score, COUNT(*) - 1 AS dof,
         CAST(MAX(nr) AS BIGINT) AS reference_n, CAST(MAX(nc) AS BIGINT) AS current_n
  FROM (SELECT *, GREATEST(c_ref / nr * nc, 1e-9) AS e FROM (
          SELECT {gk}feature, v, c_ref, c_cur, SUM(c_ref) OVER (PARTITION BY {gk}feature) AS nr,
                 SUM(c_cur) OVER (PARTITION BY {gk}feature) AS nc
          FROM (SELECT {gk}feature, v, CAST(SUM(1 - side) AS DOUBLE) AS c_ref, CAST(SUM(side) AS DOUBLE) AS c_cur
                FROM ({longs}) l GROUP BY ALL) c) x) y
  GROUP BY ALL) s"""


@query("agg_15_categorical_drift_chisquare", with_ctes(_chi_sql(CATEGORICAL), extra=EV))
def agg_15_categorical_drift_chisquare(spark, sf_dir):
    ref, cur = _samples(spark, sf_dir)
    return rounded(categorical_drift(ref, cur, CATEGORICAL))


@query("agg_16_feature_drift_run", with_ctes(
    f"SELECT * FROM ({_ks_sql(NUMERIC)}) a UNION ALL SELECT * FROM ({_chi_sql(CATEGORICAL)}) b", extra=EV))
def agg_16_feature_drift_run(spark, sf_dir):
    """All configured numeric + categorical features in one result table;
    ``missing_feature`` is skipped (absent on both sides)."""
    ref, cur = _samples(spark, sf_dir)
    res, _skipped = drift_run(ref, cur, [*NUMERIC, "missing_feature"], CATEGORICAL)
    return rounded(res)


@query("agg_16_feature_drift_summary", with_ctes(f"""
SELECT COUNT(*) AS checked_features, COUNT(*) FILTER (WHERE drift_detected) AS drifted_features,
       COALESCE(list_sort(list(feature) FILTER (WHERE drift_detected)), []) AS drifted_feature_names
FROM (SELECT * FROM ({_ks_sql(NUMERIC)}) a UNION ALL SELECT * FROM ({_chi_sql(CATEGORICAL)}) b) r""", extra=EV))
def agg_16_feature_drift_summary(spark, sf_dir):
    ref, cur = _samples(spark, sf_dir)
    res, _ = drift_run(ref, cur, NUMERIC, CATEGORICAL)
    return drift_summary(res)


@query("jon_14_category_count_alignment", with_ctes("""
SELECT category, CAST(SUM(r) AS BIGINT) AS reference_count, CAST(SUM(1 - r) AS BIGINT) AS current_count
FROM (SELECT event_type AS category, 1 AS r FROM ref UNION ALL SELECT event_type, 0 FROM cur) u GROUP BY category""",
                                                    extra=EV))
def jon_14_category_count_alignment(spark, sf_dir):
    ref, cur = _samples(spark, sf_dir)
    return align_category_counts(ref, cur, "event_type")


# Day-over-day drift runs: the run at the end of day d compares day d
# (current) with day d-1 (reference); every event is used twice, once per side.
_DAY_CUR = "SELECT *, CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS run_ts FROM events"
_DAY_REF = ("SELECT *, CAST(CAST(ts AS DATE) + 2 AS TIMESTAMP) AS run_ts FROM events "
            "WHERE CAST(ts AS DATE) + 2 <= (SELECT MAX(CAST(ts AS DATE)) + 1 FROM events)")


@query("agg_17_persistent_drift", with_ctes(f"""
SELECT COUNT(*) >= 2 AND COALESCE(len(f.features), 0) > 0 AS triggered, CAST(COUNT(*) AS BIGINT) AS windows_found,
       MAX(run_ts) AS window_end, CASE WHEN COUNT(*) >= 2 THEN COALESCE(f.features, []) ELSE [] END AS features,
       CASE WHEN COUNT(*) < 2 THEN 'Not enough recent feature drift windows: ' || COUNT(*) || '/2.'
            WHEN COALESCE(len(f.features), 0) = 0 THEN 'No feature drift persisted across 2 windows.'
            ELSE 'Persistent feature drift detected for: [' || chr(39) || array_to_string(f.features, chr(39) || ', ' || chr(39))
                 || chr(39) || '].' END AS reason
FROM lastw, (SELECT list_sort(list(feature)) AS features FROM (
      SELECT feature FROM hist WHERE run_ts IN (SELECT run_ts FROM lastw)
      GROUP BY feature HAVING COUNT(*) = 2 AND COUNT(*) FILTER (WHERE drift_detected) = 2)) f
GROUP BY f.features""", extra={"dcur": _DAY_CUR, "dref": _DAY_REF,
                               "hist": _ks_sql(["value", "user_id"], group="run_ts", src_cur="dcur", src_ref="dref",
                                               min_samples=50),
                               "lastw": "SELECT DISTINCT run_ts FROM hist WHERE run_ts >= (SELECT MAX(run_ts) FROM hist) - INTERVAL 14 DAY ORDER BY run_ts DESC LIMIT 2"}))
def agg_17_persistent_drift(spark, sf_dir):
    """Day-over-day drift runs of ``value`` and ``user_id`` build a drift
    history; the persistence rule (last 2 runs within 14 days) is then
    evaluated at the last run."""
    ev = Inputs(spark, sf_dir).t.events
    day = F.col("ts").cast("date")
    dcur = ev.withColumn("run_ts", F.date_add(day, 1).cast("timestamp"))
    last_day = ev.agg(F.max(day)).scalar()
    dref = ev.filter(F.date_add(day, 2) <= F.date_add(last_day, 1)).withColumn(
        "run_ts", F.date_add(day, 2).cast("timestamp"))
    hist = numeric_drift(dref, dcur, ["value", "user_id"], group_cols=["run_ts"])
    # the last run is the end of the last event day (a scalar subquery)
    at = F.date_add(last_day, 1).cast("timestamp")
    return persistent_drift(hist, at, 14, 2, ts_col="run_ts")


@query("agg_18_persistent_degradation", with_ctes("""
SELECT COUNT(*) = 2 AND COUNT(*) FILTER (WHERE (rmse > 1375.0 AND mae > 990.0) OR ABS(bias) > 900.0) = 2 AS triggered,
       COUNT(*) AS windows_found,
       COUNT(*) FILTER (WHERE (rmse > 1375.0 AND mae > 990.0) OR ABS(bias) > 900.0) AS bad_windows,
       MAX(window_end) AS performance_window_end,
       CASE WHEN COUNT(*) < 2 THEN 'Not enough performance windows: ' || COUNT(*) || '/2.'
            WHEN COUNT(*) FILTER (WHERE (rmse > 1375.0 AND mae > 990.0) OR ABS(bias) > 900.0) < 2
            THEN 'Performance degradation is not persistent across 2 windows.'
            ELSE 'Persistent performance degradation detected across 2 windows.' END AS reason
FROM (SELECT * FROM rm ORDER BY window_end DESC LIMIT 2) t""", "naive_predictions", extra={"rm": """
SELECT d AS window_end, SQRT(s2 / n) AS rmse, sa / n AS mae, s1 / n AS bias FROM (
  SELECT d, SUM(s2) OVER w AS s2, SUM(sa) OVER w AS sa, SUM(s1) OVER w AS s1, SUM(n) OVER w AS n
  FROM (SELECT Date AS d, SUM((Sales - prediction) * (Sales - prediction)) AS s2, SUM(ABS(Sales - prediction)) AS sa,
               SUM(Sales - prediction) AS s1, COUNT(*) AS n FROM naive_predictions GROUP BY Date) x
  WINDOW w AS (ORDER BY d RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)) y"""}))
def agg_18_persistent_degradation(spark, sf_dir):
    hist = rolling_metrics(Inputs(spark, sf_dir).predictions(), days=7)
    # one row per window end: the end itself orders them
    return persistent_degradation(hist, 2, order_col="window_end")


@query("jon_15_window_membership", with_ctes("""
SELECT window_end, n_samples FROM rm WHERE window_end IN (SELECT DISTINCT window_end FROM rm ORDER BY window_end DESC LIMIT 3)
""", "naive_predictions", extra={"rm": """
SELECT d AS window_end, SUM(n) OVER (ORDER BY d RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS n_samples
FROM (SELECT Date AS d, COUNT(*) AS n FROM naive_predictions GROUP BY Date) x"""}))
def jon_15_window_membership(spark, sf_dir):
    hist = rolling_metrics(Inputs(spark, sf_dir).predictions(), days=7)
    return in_last_n(hist, "window_end", 3).select("window_end", "n_samples")


@query("set_05_value_set_difference", with_ctes("""
SELECT 'except' AS op, v FROM (SELECT DISTINCT props AS v FROM cur EXCEPT SELECT DISTINCT props FROM ref) a
UNION ALL SELECT 'intersect' AS op, v FROM (SELECT DISTINCT props AS v FROM cur INTERSECT SELECT DISTINCT props FROM ref) b
""", extra=EV))
def set_05_value_set_difference(spark, sf_dir):
    from panelcast.operators.dedup import value_set_difference, value_set_intersection
    ref, cur = _samples(spark, sf_dir)
    a = value_set_difference(cur, ref, "props").withColumn("op", F.lit("except"))
    b = value_set_intersection(cur, ref, "props").withColumn("op", F.lit("intersect"))
    return a.unionByName(b).select("op", "v")
