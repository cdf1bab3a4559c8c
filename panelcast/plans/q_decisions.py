"""Catalogue: promotion and retraining decisions as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions.scalar import fingerprint_agg
from panelcast.operators import decisions as D
from panelcast.operators import metrics as M
from panelcast.operators.drift import (REASON_PERSISTENT_DEGRADATION, REASON_PERSISTENT_DRIFT, drift_history,
                                       persistent_degradation, persistent_drift_by)
from panelcast.operators.joins import join_dimension
from panelcast.operators.splits import holdout_split
from panelcast.operators.validate import TRAIN_RULES, with_violations
from panelcast.plans.q_drift import _ks_sql
from panelcast.plans.registry import Inputs, query, rounded
from panelcast.plans.sql import with_ctes
from panelcast.schema import Roles
from panelcast.sources.adapters import raw_sales_rows
from panelcast.sources.files import scratch_dir

R = Roles()


def _r(x: str) -> str:
    return f"ROUND({x}, 4)"


_PROMO_SQL = with_ctes(f"""
SELECT StoreType, status, error, accepted,
       CASE WHEN status = 'ok' THEN {_r("overall_change")} END AS overall_change,
       CASE WHEN status = 'ok' THEN {_r("promo_change")} END AS promo_change,
       CASE WHEN status = 'ok' THEN {_r("non_promo_change")} END AS non_promo_change,
       CASE WHEN status = 'ok' THEN {_r("bias_regression")} END AS bias_regression, reasons
FROM (
  SELECT c.StoreType,
    CASE WHEN c.validation_rows < 1000 OR c.promo_rows < 100 OR c.non_promo_rows < 100 THEN 'invalid' ELSE 'ok' END AS status,
    CASE WHEN c.validation_rows < 1000 THEN 'Not enough validation rows for promotion: ' || c.validation_rows || '/1000'
         WHEN c.promo_rows < 100 THEN 'Not enough validation rows for segment ''promo'': ' || c.promo_rows || '/100'
         WHEN c.non_promo_rows < 100 THEN 'Not enough validation rows for segment ''non_promo'': ' || c.non_promo_rows || '/100' END AS error,
    (c.overall_rmse - h.overall_rmse) / ABS(h.overall_rmse) AS overall_change,
    (c.promo_rmse - h.promo_rmse) / ABS(h.promo_rmse) AS promo_change,
    (c.non_promo_rmse - h.non_promo_rmse) / ABS(h.non_promo_rmse) AS non_promo_change,
    ABS(c.overall_bias) - ABS(h.overall_bias) AS bias_regression,
    c.validation_rows >= 1000 AND c.promo_rows >= 100 AND c.non_promo_rows >= 100
      AND (c.overall_rmse - h.overall_rmse) / ABS(h.overall_rmse) <= -0.005
      AND (c.promo_rmse - h.promo_rmse) / ABS(h.promo_rmse) <= 0.02
      AND (c.non_promo_rmse - h.non_promo_rmse) / ABS(h.non_promo_rmse) <= 0.02
      AND ABS(c.overall_bias) - ABS(h.overall_bias) <= 100.0 AS accepted,
    CASE WHEN c.validation_rows < 1000 OR c.promo_rows < 100 OR c.non_promo_rows < 100 THEN []
      ELSE list_filter([
        CASE WHEN NOT ((c.overall_rmse - h.overall_rmse) / ABS(h.overall_rmse) <= -0.005) THEN '{D.REASON_OVERALL_BAD}' END,
        CASE WHEN NOT ((c.promo_rmse - h.promo_rmse) / ABS(h.promo_rmse) <= 0.02) THEN 'Segment ''promo'' exceeds the allowed RMSE regression.' END,
        CASE WHEN NOT ((c.non_promo_rmse - h.non_promo_rmse) / ABS(h.non_promo_rmse) <= 0.02) THEN 'Segment ''non_promo'' exceeds the allowed RMSE regression.' END,
        CASE WHEN NOT (ABS(c.overall_bias) - ABS(h.overall_bias) <= 100.0) THEN '{D.REASON_BIAS_BAD}' END], lambda x: x IS NOT NULL) END AS reasons
  FROM (SELECT * FROM pm WHERE model = 'challenger') c JOIN (SELECT * FROM pm WHERE model = 'champion') h USING (StoreType)) d
""", "naive_predictions", "store_dim", extra={
    "val": "SELECT p.*, d.StoreType FROM naive_predictions p JOIN store_dim d USING (Store) "
           "WHERE p.Date > (SELECT MAX(Date) FROM naive_predictions) - 365",
    "m": "SELECT 'champion' AS model, StoreType, Sales, Promo, prediction AS yhat FROM val "
         "UNION ALL SELECT 'challenger', StoreType, Sales, Promo, sales_lag_7 FROM val",
    "pm": """SELECT model, StoreType, SQRT(AVG((yhat - Sales) * (yhat - Sales))) AS overall_rmse,
       SQRT(AVG(CASE WHEN Promo = 1 THEN (yhat - Sales) * (yhat - Sales) END)) AS promo_rmse,
       SQRT(AVG(CASE WHEN Promo = 0 THEN (yhat - Sales) * (yhat - Sales) END)) AS non_promo_rmse,
       AVG(yhat - Sales) AS overall_bias, COUNT(*) AS validation_rows,
       COUNT(*) FILTER (WHERE Promo = 1) AS promo_rows, COUNT(*) FILTER (WHERE Promo = 0) AS non_promo_rows
       FROM m GROUP BY model, StoreType"""})


@query("dec_01_promotion_policy", _PROMO_SQL)
def dec_01_promotion_policy(spark, sf_dir):
    """Challenger vs champion per store type on the last 365 days."""
    i = Inputs(spark, sf_dir)
    p = join_dimension(i.predictions(), i.store().select("Store", "StoreType"), "Store")
    _, val = holdout_split(p, R, 365)
    cols = ["StoreType", "Sales", "Promo"]
    m = (val.select(F.lit("champion").alias("model"), *cols, F.col("prediction").alias("yhat"))
         .unionByName(val.select(F.lit("challenger").alias("model"), *cols, F.col("sales_lag_7").alias("yhat"))))
    pm = M.promotion_metrics(m, yhat="yhat", group_by=["model", "StoreType"])
    dec = D.promotion_decision(pm.filter("model = 'challenger'"), pm.filter("model = 'champion'"), ["StoreType"])
    return rounded(dec.select(
        "StoreType", "status", "error", "accepted",
        F.col("checks")["overall_rmse"]["change"].alias("overall_change"),
        F.col("checks")["promo_rmse"]["change"].alias("promo_change"),
        F.col("checks")["non_promo_rmse"]["change"].alias("non_promo_change"),
        F.col("checks")["overall_bias"]["change"].alias("bias_regression"), "reasons"))


NEW_DAYS = 90
#: Drift of a store: its last 365 days against all before, today and a week ago. The given
#: tables hold no drift, so its input has the last year's sales of every fifth store raised by half.
DRIFT_FEATURES, DRIFT_OFFSETS = ["Sales", "Customers", "Promo"], (0, 7)


def store_signals(i: Inputs, minimum_rows: int = 20):
    """DEC-04 per store: new rows and batch ids of the last 90 days, data
    quality of those rows, cooldown / schedule from the last promo day of
    the training period, persistent degradation of per-store rolling
    metrics, feature drift in both of the last two evaluations, budget. One row per store
    (a keyed plan of small aggregates)."""
    raw = raw_sales_rows(i.t.lineitem)
    last = raw.agg(F.max("Date")).scalar()
    new = with_violations(raw.filter(F.col("Date") > F.date_sub(last, NEW_DAYS)), TRAIN_RULES)
    per = new.groupBy("Store").agg(
        F.count(F.lit(1)).alias("new_training_rows"),
        F.count_if(F.size("violations") > 0).alias("bad_rows"),
        F.array_sort(F.collect_set("file")).alias("batch_ids"),
        fingerprint_agg("file").alias("dataset_version"))
    panel = i.keep_panel().panel()
    train, _ = holdout_split(panel, R, NEW_DAYS)
    lastpromo = train.groupBy("Store").agg(
        F.date_format(F.max(F.when(F.col("Promo") == 1, F.col("Date"))).cast("timestamp"),
                      "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("last_retrained_at_utc"),
        F.date_format(F.min("Date").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("release_created_at_utc"))
    hist = M.rolling_metrics(i.predictions(), group_by=["Store"])
    deg = persistent_degradation(hist, 2, order_col="window_end", group_by=["Store"]).select(
        "Store", F.col("triggered").alias("performance_degraded"),
        F.date_format("performance_window_end", "yyyy-MM-dd").alias("performance_window_end"),
        F.col("reason").alias("performance_reason"))
    raised = (F.col("Store") % 5 == 0) & (F.col("Date") > F.date_sub(last, 365))
    shifted = panel.withColumn("Sales", F.when(raised, F.col("Sales") * 1.5).otherwise(F.col("Sales")))
    history = drift_history(shifted, DRIFT_FEATURES, last, DRIFT_OFFSETS, group_cols=["Store"])
    drift = persistent_drift_by(history, last, ["Store"]).select(
        "Store", F.col("triggered").alias("feature_drift_persistent"),
        F.date_format("window_end", "yyyy-MM-dd").alias("drift_window_end"), F.col("reason").alias("drift_reason"))
    sig = per.join(lastpromo, "Store", "left").join(deg, "Store", "left").join(drift, "Store", "left")
    sig = D.cooldown_and_schedule(sig, F.date_add(F.lit(last), 1).cast("timestamp"))
    return sig.select(
        "Store", "dataset_version", "new_training_rows", F.lit(minimum_rows).alias("minimum_training_rows"),
        (F.col("bad_rows") == 0).alias("data_quality_ok"),
        F.coalesce("performance_degraded", F.lit(False)).alias("performance_degraded"),
        F.coalesce("feature_drift_persistent", F.lit(False)).alias("feature_drift_persistent"), "cooldown_active",
        (F.col("new_training_rows") <= D.RETRAINING_DEFAULTS["maximum_new_training_rows"]).alias("budget_available"),
        "batch_ids", "scheduled_retraining_due", "days_since_last_training", "performance_window_end",
        "drift_window_end", "performance_reason", "drift_reason", F.lit(None).cast("string").alias("data_quality_reason"))


_RAW = ("SELECT 'gt_' || CAST(l_suppkey + 1 AS VARCHAR) || '_' || strftime(CAST(l_shipdate AS DATE), '%Y%m%d') AS file, "
        "CAST(l_suppkey + 1 AS BIGINT) AS Store, CAST(l_shipdate AS DATE) AS Date, "
        "CASE WHEN l_discount >= 0.1 THEN 2 WHEN l_discount >= 0.06 THEN 1 ELSE 0 END AS Promo FROM lineitem")
_SIGNALS = {
    "raw": _RAW,
    "new": "SELECT * FROM raw WHERE Date > (SELECT MAX(Date) FROM raw) - 90",
    "per": "SELECT Store, COUNT(*) AS new_training_rows, COUNT(*) FILTER (WHERE Promo NOT IN (0, 1)) AS bad_rows, "
           "list_sort(list(DISTINCT file)) AS batch_ids, "
           "'batch-' || substr(sha256(array_to_string(list_sort(list(DISTINCT file)), '|')), 1, 16) AS dataset_version "
           "FROM new GROUP BY Store",
    "tr": "SELECT * FROM sales_panel WHERE Date <= (SELECT MAX(Date) FROM sales_panel) - 90",
    "lp": "SELECT Store, CAST(MAX(CASE WHEN Promo = 1 THEN Date END) AS TIMESTAMP) AS last_ts, "
          "CAST(MIN(Date) AS TIMESTAMP) AS rel_ts FROM tr GROUP BY Store",
    "daily": "SELECT Store, Date AS d, SUM((Sales - prediction) * (Sales - prediction)) AS s2, SUM(ABS(Sales - prediction)) AS sa, "
             "SUM(Sales - prediction) AS s1, COUNT(*) AS n FROM naive_predictions GROUP BY Store, Date",
    "roll": "SELECT Store, d AS window_end, SQRT(s2w / nw) AS rmse, saw / nw AS mae, s1w / nw AS bias FROM ("
            "SELECT Store, d, SUM(s2) OVER w AS s2w, SUM(sa) OVER w AS saw, SUM(s1) OVER w AS s1w, SUM(n) OVER w AS nw "
            "FROM daily WINDOW w AS (PARTITION BY Store ORDER BY d RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)) x",
    "deg": "SELECT Store, COUNT(*) = 2 AND COUNT(*) FILTER (WHERE (rmse > 1375.0 AND mae > 990.0) OR ABS(bias) > 900.0) = 2 AS degraded, "
           "strftime(MAX(window_end), '%Y-%m-%d') AS performance_window_end FROM ("
           "SELECT *, ROW_NUMBER() OVER (PARTITION BY Store ORDER BY window_end DESC) AS rk FROM roll) r WHERE rk <= 2 GROUP BY Store",
    "ends": "SELECT UNNEST([(SELECT MAX(Date) FROM sales_panel), (SELECT MAX(Date) FROM sales_panel) - 7]) AS drift_end",
    "shifted": "SELECT * REPLACE (CASE WHEN Store % 5 = 0 AND Date > (SELECT MAX(Date) FROM sales_panel) - 365 "
               "THEN Sales * CAST(1.5 AS DOUBLE) ELSE Sales END AS Sales) FROM sales_panel",
    "dref": "SELECT * FROM shifted, ends WHERE Date <= drift_end - 365",
    "dcur": "SELECT * FROM shifted, ends WHERE Date > drift_end - 365 AND Date <= drift_end",
    "dhist": _ks_sql(DRIFT_FEATURES, group="Store, drift_end", src_ref="dref", src_cur="dcur"),
    "dfeat": "SELECT Store, feature, COUNT(*) AS n, COUNT(*) FILTER (WHERE drift_detected) AS drifted, MAX(drift_end) AS drift_end "
             "FROM dhist GROUP BY Store, feature",
    "drift": "SELECT Store, strftime(MAX(drift_end), '%Y-%m-%d') AS drift_window_end, "
             "list_sort(list(feature) FILTER (WHERE n = 2 AND drifted = 2)) AS features FROM dfeat GROUP BY Store",
    "now": "SELECT CAST((SELECT MAX(Date) FROM raw) + 1 AS TIMESTAMP) AS now",
    "sig": f"""SELECT per.Store, dataset_version, new_training_rows, 20 AS minimum_training_rows, bad_rows = 0 AS data_quality_ok,
      COALESCE(deg.degraded, false) AS performance_degraded, COALESCE(len(drift.features), 0) > 0 AS feature_drift_persistent,
      '{REASON_PERSISTENT_DRIFT}[''' || array_to_string(drift.features, ''', ''') || '''].' AS drift_reason,
      COALESCE(now.now - lp.last_ts < INTERVAL 168 HOUR, false) AS cooldown_active,
      new_training_rows <= 1000000 AS budget_available, batch_ids,
      CASE WHEN COALESCE(lp.last_ts, lp.rel_ts) IS NOT NULL AND now.now >= COALESCE(lp.last_ts, lp.rel_ts)
           THEN now.now - COALESCE(lp.last_ts, lp.rel_ts) >= INTERVAL 168 HOUR ELSE false END AS scheduled_retraining_due,
      deg.performance_window_end, drift.drift_window_end
    FROM per LEFT JOIN lp USING (Store) LEFT JOIN deg USING (Store) LEFT JOIN drift USING (Store), now""",
}


_DECISION_ID_SQL = """'retrain-' || substr(sha256(to_json({'batch_ids': batch_ids, 'dataset_version': dataset_version,
  'drift_window_end': drift_window_end, 'feature_drift_persistent': feature_drift_persistent,
  'new_training_rows': new_training_rows, 'performance_degraded': performance_degraded,
  'performance_window_end': performance_window_end, 'scheduled_retraining_due': scheduled_retraining_due})), 1, 16)"""


@query("dec_04_signal_collection", with_ctes("""
SELECT Store, dataset_version, new_training_rows, data_quality_ok, performance_degraded, feature_drift_persistent,
       drift_window_end, CASE WHEN feature_drift_persistent THEN drift_reason END AS drift_reason, cooldown_active, budget_available, scheduled_retraining_due FROM sig""", "naive_predictions", extra=_SIGNALS))
def dec_04_signal_collection(spark, sf_dir):
    s = store_signals(Inputs(spark, sf_dir))
    reason = F.when(F.col("feature_drift_persistent"), F.col("drift_reason")).alias("drift_reason")
    return s.select("Store", "dataset_version", "new_training_rows", "data_quality_ok", "performance_degraded",
                    "feature_drift_persistent", "drift_window_end", reason, "cooldown_active", "budget_available", "scheduled_retraining_due")


@query("dec_03_retraining_policy", with_ctes(f"""
SELECT Store,
  CASE WHEN NOT data_quality_ok THEN 'block' WHEN NOT budget_available THEN 'block' WHEN cooldown_active THEN 'skip'
       WHEN new_training_rows < minimum_training_rows THEN 'skip'
       WHEN scheduled_retraining_due OR performance_degraded OR feature_drift_persistent THEN 'train_candidate'
       ELSE 'skip' END AS action,
  CASE WHEN NOT data_quality_ok THEN ['{D.REASON_QUALITY}'] WHEN NOT budget_available THEN ['{D.REASON_BUDGET}']
       WHEN cooldown_active THEN ['{D.REASON_COOLDOWN}']
       WHEN new_training_rows < minimum_training_rows THEN ['Insufficient new training rows: ' || new_training_rows || '/' || minimum_training_rows || '.']
       WHEN scheduled_retraining_due OR performance_degraded OR feature_drift_persistent THEN list_filter([
         CASE WHEN scheduled_retraining_due THEN '{D.REASON_SCHEDULED}' END,
         CASE WHEN performance_degraded THEN '{REASON_PERSISTENT_DEGRADATION.format(n=2)}' END,
         CASE WHEN feature_drift_persistent THEN drift_reason END], lambda x: x IS NOT NULL)
       ELSE ['{D.REASON_NOTHING}'] END AS reasons,
  CASE WHEN NOT data_quality_ok THEN ['data_quality'] WHEN NOT budget_available THEN ['budget']
       WHEN cooldown_active OR new_training_rows < minimum_training_rows THEN []
       ELSE list_filter([CASE WHEN scheduled_retraining_due THEN 'scheduled_refresh' END,
         CASE WHEN performance_degraded THEN 'performance_degradation' END,
         CASE WHEN feature_drift_persistent THEN 'feature_drift' END], lambda x: x IS NOT NULL) END AS trigger_types,
  {_DECISION_ID_SQL} AS decision_id
FROM sig""", "naive_predictions", extra=_SIGNALS))
def dec_03_retraining_policy(spark, sf_dir):
    """Retraining decision for every store's signals in one job."""
    dec = D.retraining_decision(store_signals(Inputs(spark, sf_dir)))
    return dec.select("Store", "action", "reasons", "trigger_types", "decision_id")


@query("dec_05_cooldown_schedule", with_ctes("""
SELECT o_orderpriority, last_ts,
  COALESCE(now - TRY_CAST(last_ts AS TIMESTAMP) < INTERVAL 168 HOUR, false) AS cooldown_active,
  CASE WHEN TRY_CAST(last_ts AS TIMESTAMP) IS NOT NULL AND now >= TRY_CAST(last_ts AS TIMESTAMP)
       THEN now - TRY_CAST(last_ts AS TIMESTAMP) >= INTERVAL 168 HOUR ELSE false END AS scheduled_retraining_due,
  CASE WHEN TRY_CAST(last_ts AS TIMESTAMP) IS NOT NULL AND now >= TRY_CAST(last_ts AS TIMESTAMP)
       THEN ROUND(epoch(now - TRY_CAST(last_ts AS TIMESTAMP)) / 3600.0 / 24.0, 4) END AS days_since_last_training
FROM (SELECT o_orderpriority, strftime(MAX(o_orderdate), '%Y-%m-%dT%H:%M:%S') AS last_ts,
             (SELECT MAX(o_orderdate) FROM orders) - INTERVAL 5 DAY AS now
      FROM orders GROUP BY o_orderpriority
      UNION ALL SELECT 'unparsable', 'not a time', (SELECT MAX(o_orderdate) FROM orders) - INTERVAL 5 DAY) t"""))
def dec_05_cooldown_schedule(spark, sf_dir):
    """Last 'training' time per priority class = its latest order; evaluated
    five days before the newest order (one future-dated row, one bad text)."""
    o = Inputs(spark, sf_dir).t.orders
    now = F.lit(o.agg(F.max("o_orderdate")).first()[0]).cast("timestamp") - F.expr("INTERVAL 5 DAYS")
    t = o.groupBy("o_orderpriority").agg(
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss").alias("last_ts"))
    t = t.unionByName(spark.createDataFrame([("unparsable", "not a time")], "o_orderpriority string, last_ts string"))
    out = D.cooldown_and_schedule(t, now, "last_ts", None)
    return rounded(out.select("o_orderpriority", "last_ts", "cooldown_active", "scheduled_retraining_due",
                              "days_since_last_training"))


@query("dec_06_duplicate_decision_guard", with_ctes(f"""
SELECT Store, {_DECISION_ID_SQL} AS decision_id, true AS recorded_once FROM sig WHERE data_quality_ok AND budget_available
""", "naive_predictions", extra=_SIGNALS))
def dec_06_duplicate_decision_guard(spark, sf_dir):
    """The blocked decisions are recorded, twice as after a retry; the guard then leaves the
    others. Ids are those of DEC-03."""
    base = scratch_dir(spark, "dec06")
    D.retraining_decision(store_signals(Inputs(spark, sf_dir))).select("Store", "decision_id", "action") \
        .write.parquet(f"{base}/decisions")
    decisions = spark.read.parquet(f"{base}/decisions")
    for _ in range(2):
        D.record_decisions(decisions, f"{base}/state", F.col("action") == "block")
    recorded = spark.read.parquet(f"{base}/state")
    once = recorded.agg((F.count("decision_id") == F.count_distinct("decision_id")).alias("u")).scalar()
    return D.unprocessed_decisions(decisions, recorded).select("Store", "decision_id", once.alias("recorded_once"))


def _dec07_sql() -> str:
    from panelcast.plans.q_drift import CATEGORICAL, EV, NUMERIC, _chi_sql, _ks_sql
    return with_ctes("""
SELECT feature, feature_type, drift_detected,
       CASE WHEN drift_detected THEN 'EMERGENCY' WHEN feature_type = 'categorical' THEN 'FORCED' ELSE 'STABLE' END AS strategy,
       NOT drift_detected AND NOT (feature_type = 'categorical') AS skip_training
FROM res""", extra={**EV, "res": f"SELECT * FROM ({_ks_sql(NUMERIC)}) a UNION ALL SELECT * FROM ({_chi_sql(CATEGORICAL)}) b"})


@query("dec_07_run_strategy", _dec07_sql())
def dec_07_run_strategy(spark, sf_dir):
    """Run strategy per drift-run result; categorical checks are forced runs."""
    from panelcast.operators.drift import drift_run
    from panelcast.plans.q_drift import CATEGORICAL, NUMERIC, _samples
    ref, cur = _samples(spark, sf_dir)
    res, _ = drift_run(ref, cur, NUMERIC, CATEGORICAL)
    force = F.col("feature_type") == "categorical"
    return res.select("feature", "feature_type", "drift_detected",
                      D.run_strategy(F.col("drift_detected"), force).alias("strategy"),
                      D.should_skip_training(F.col("drift_detected"), force).alias("skip_training"))
