"""Catalogue: request log (from ``events``), SLO rules, alerts, costs."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.operators import serving as S
from panelcast.plans.registry import Inputs, query, rounded
from panelcast.plans.sql import with_ctes

WIN = "make_timestamp(CAST(FLOOR(epoch(ts) / 900) * 900 * 1000000 AS BIGINT))"


@query("agg_23_request_summary", with_ctes(f"""
SELECT b.window_start, 900 AS window_seconds, requests_total, success_total, requests_total - success_total AS error_total,
  ROUND(success_total / requests_total, 4) AS success_rate, ROUND((requests_total - success_total) / requests_total, 4) AS error_rate,
  p.p50 AS latency_p50_ms, p.p95 AS latency_p95_ms, p.p99 AS latency_p99_ms, round_even(sum_h / requests_total, 0) / 100.0 AS latency_avg_ms, latency_max_ms
FROM (SELECT window_start, COUNT(*) AS requests_total, COUNT(*) FILTER (WHERE status_code >= 200 AND status_code < 300) AS success_total,
             SUM(CAST(ROUND(lat * 100) AS BIGINT)) AS sum_h, MAX(lat) AS latency_max_ms FROM ev GROUP BY window_start) b
JOIN (SELECT window_start, MIN(CASE WHEN cum > round_even((n - 1) * CAST(0.5 AS DOUBLE), 0) THEN lat END) AS p50,
             MIN(CASE WHEN cum > round_even((n - 1) * CAST(0.95 AS DOUBLE), 0) THEN lat END) AS p95,
             MIN(CASE WHEN cum > round_even((n - 1) * CAST(0.99 AS DOUBLE), 0) THEN lat END) AS p99
      FROM (SELECT window_start, lat, SUM(c) OVER (PARTITION BY window_start ORDER BY lat) AS cum,
                   SUM(c) OVER (PARTITION BY window_start) AS n
            FROM (SELECT window_start, lat, COUNT(*) AS c FROM ev GROUP BY ALL) c) x GROUP BY window_start) p
USING (window_start)""", "request_log", extra={
    "ev": f"SELECT *, {WIN} AS window_start, ROUND(latency_seconds * 1000.0, 2) AS lat FROM request_log"}))
def agg_23_request_summary(spark, sf_dir):
    """15-minute windows over the whole request log."""
    return S.request_summary(Inputs(spark, sf_dir).requests(), 900)


@query("agg_23_request_breakdown", with_ctes(f"""
SELECT window_start, status_codes, paths FROM (
  SELECT window_start, string_agg(k || '=' || c, ',' ORDER BY k) AS status_codes
  FROM (SELECT {WIN} AS window_start, CAST(status_code AS VARCHAR) AS k, COUNT(*) AS c FROM request_log GROUP BY ALL) a GROUP BY 1) s
JOIN (SELECT window_start, string_agg(k || '=' || c, ',' ORDER BY k) AS paths
  FROM (SELECT {WIN} AS window_start, path AS k, COUNT(*) AS c FROM request_log GROUP BY ALL) b GROUP BY 1) p USING (window_start)""",
                                             "request_log"))
def agg_23_request_breakdown(spark, sf_dir):
    """The count maps of each window, as sorted text."""
    def text(col):
        return F.array_join(F.transform(F.map_entries(col), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    out = S.request_breakdown(Inputs(spark, sf_dir).requests(), 900)
    return out.select("window_start", text("status_codes").alias("status_codes"), text("paths").alias("paths"))


def _hist_sql() -> str:
    b = S.LATENCY_BUCKETS_SECONDS
    idx = "CASE " + " ".join(f"WHEN latency_seconds <= {x!r} THEN {i}" for i, x in enumerate(b)) + f" ELSE {len(b)} END"
    labels = "[" + ", ".join(f"'{x}'" for x in S.bucket_labels()) + "]"
    return with_ctes(f"""
SELECT k.method, k.path, g.bucket, {labels}[g.bucket + 1] AS le,
       SUM(COALESCE(c.cnt, 0)) OVER (PARTITION BY k.method, k.path ORDER BY g.bucket) AS cumulative_count
FROM (SELECT DISTINCT method, path FROM request_log) k
CROSS JOIN (SELECT CAST(range AS INT) AS bucket FROM range(0, {len(b) + 1})) g
LEFT JOIN (SELECT method, path, {idx} AS bucket, COUNT(*) AS cnt FROM request_log GROUP BY ALL) c
  ON c.method = k.method AND c.path = k.path AND c.bucket = g.bucket""", "request_log")


@query("agg_24_latency_histogram", _hist_sql())
def agg_24_latency_histogram(spark, sf_dir):
    return S.latency_histogram(Inputs(spark, sf_dir).requests())


#: The stand-in request log of the SLO query runs at this multiple of the events' pace.
BUSY = 20


def _slo_sql() -> str:
    bl = [*S.LATENCY_BUCKETS_SECONDS, float("inf")]
    bcols = ", ".join(f"COUNT(*) FILTER (WHERE latency_seconds <= {x!r}) AS b{i}" if x != float("inf")
                      else f"COUNT(*) AS b{i}" for i, x in enumerate(bl))
    sums = ", ".join(f"SUM(COALESCE(b{i}, 0)) OVER w AS b{i}" for i in range(len(bl)))
    case = []
    for i, x in enumerate(bl):
        if x == float("inf"):
            val = f"{bl[-2]!r}"
        else:
            ple = repr(bl[i - 1]) if i > 0 else "0.0"
            pc = f"b{i - 1}" if i > 0 else "0"
            val = (f"CAST({ple} AS DOUBLE) + (CAST({x!r} AS DOUBLE) - CAST({ple} AS DOUBLE)) * "
                   f"(n * CAST(0.95 AS DOUBLE) - {pc}) / (b{i} - {pc})")
        case.append(f"WHEN b{i} >= n * CAST(0.95 AS DOUBLE) THEN {val}")
    p95 = "CASE WHEN n > 0 THEN CASE " + " ".join(case) + " END END"
    return with_ctes(f"""
SELECT make_timestamp(minute * 60 * 1000000) AS minute, n AS requests, e5 AS server_errors,
  ROUND(error_ratio, 6) AS error_ratio, ROUND(p95_seconds, 6) AS p95_seconds, error_condition, latency_condition,
  MIN(CAST(error_condition AS INT)) OVER h = 1 AS error_firing, MIN(CAST(latency_condition AS INT)) OVER h = 1 AS latency_firing
FROM (SELECT *, e5 / GREATEST(n, 1) AS error_ratio, {p95} AS p95_seconds,
             e5 / GREATEST(n, 1) > 0.01 AND n >= 20 AS error_condition,
             COALESCE({p95} > 1.0, false) AND n >= 20 AS latency_condition
      FROM (SELECT g.minute, SUM(COALESCE(n, 0)) OVER w AS n, SUM(COALESCE(e5, 0)) OVER w AS e5, {sums}
            FROM (SELECT range AS minute FROM range((SELECT MIN(minute) FROM per), (SELECT MAX(minute) FROM per) + 1)) g
            LEFT JOIN per USING (minute)
            WINDOW w AS (ORDER BY g.minute RANGE BETWEEN 9 PRECEDING AND CURRENT ROW)) r) s
WINDOW h AS (ORDER BY minute RANGE BETWEEN 5 PRECEDING AND CURRENT ROW)""", "request_log", extra={
        "busy_log": f"SELECT * REPLACE (make_timestamp(CAST(FLOOR(epoch(ts) / {BUSY}) AS BIGINT) * 1000000) AS ts) FROM request_log",
        "per": f"SELECT CAST(FLOOR(epoch(ts) / 60) AS BIGINT) AS minute, COUNT(*) AS n, "
               f"COUNT(*) FILTER (WHERE status_code >= 500) AS e5, {bcols} FROM busy_log WHERE path = '/predict' GROUP BY 1"})


@query("agg_25_slo_breach_rules", _slo_sql())
def agg_25_slo_breach_rules(spark, sf_dir):
    """5xx-ratio and p95 rules of /predict, evaluated every minute."""
    # 6 places: interpolated p95 values are short binary fractions (ties at 4 places)
    busy = Inputs(spark, sf_dir).requests().withColumn("ts", F.timestamp_seconds(F.floor(F.unix_timestamp("ts") / BUSY)))
    return rounded(S.slo_breaches(busy), 6)


@query("agg_25_readiness_rule", with_ctes("""
SELECT make_timestamp(minute * 60 * 1000000) AS minute, ready, condition,
       MIN(CAST(condition AS INT)) OVER (ORDER BY minute RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) = 1 AS firing
FROM (SELECT g.minute, p.ready, COALESCE(p.ready = 0, true) AS condition
      FROM (SELECT range AS minute FROM range((SELECT MIN(minute) FROM busy_log), (SELECT MAX(minute) FROM busy_log) + 1)) g
      LEFT JOIN (SELECT minute, CAST(max({'t': ts, 's': status_code}).s < 500 AS INT) AS ready
                 FROM busy_log WHERE path = '/health' GROUP BY minute) p USING (minute)) r""", "request_log", extra={
    "busy_log": f"""SELECT *, CAST(FLOOR(epoch(ts) / 60) AS BIGINT) AS minute FROM (
        SELECT * REPLACE (make_timestamp(CAST(FLOOR(epoch(ts) / {BUSY}) AS BIGINT) * 1000000) AS ts) FROM request_log) b"""}))
def agg_25_readiness_rule(spark, sf_dir):
    """Readiness of the service by its health probes, evaluated every minute."""
    busy = Inputs(spark, sf_dir).requests().withColumn("ts", F.timestamp_seconds(F.floor(F.unix_timestamp("ts") / BUSY)))
    return S.readiness_breaches(busy)


def _alerts(spark, sf_dir):
    from panelcast.operators.decisions import retraining_decision
    from panelcast.plans.q_decisions import store_signals
    i = Inputs(spark, sf_dir)
    dec = retraining_decision(store_signals(i)).join(i.store().select("Store", "StoreType"), "Store")
    sev = F.when(F.col("action") == "block", "critical").when(F.col("action") == "train_candidate", "warning") \
           .otherwise("info")
    return dec.select(F.concat(F.lit("stores-"), F.col("StoreType"), F.lit("-"), F.floor(F.col("Store") / 100).cast("string")).alias("group"),
                      F.concat(F.lit("Retrain_"), F.col("action"), F.lit("_"), F.col("Store").cast("string")).alias("alertname"),
                      F.lit("forecasting-api").alias("service"), sev.alias("severity"),
                      F.element_at("reasons", 1).alias("summary"))


def _alerts_sql() -> str:
    from panelcast.plans.q_decisions import _SIGNALS
    from panelcast.operators import decisions as D
    dec = f"""SELECT Store,
  CASE WHEN NOT data_quality_ok THEN 'block' WHEN NOT budget_available THEN 'block' WHEN cooldown_active THEN 'skip'
       WHEN new_training_rows < minimum_training_rows THEN 'skip'
       WHEN scheduled_retraining_due OR performance_degraded OR feature_drift_persistent THEN 'train_candidate' ELSE 'skip' END AS action,
  CASE WHEN NOT data_quality_ok THEN '{D.REASON_QUALITY}' WHEN NOT budget_available THEN '{D.REASON_BUDGET}'
       WHEN cooldown_active THEN '{D.REASON_COOLDOWN}'
       WHEN new_training_rows < minimum_training_rows THEN 'Insufficient new training rows: ' || new_training_rows || '/' || minimum_training_rows || '.'
       WHEN scheduled_retraining_due THEN '{D.REASON_SCHEDULED}' WHEN performance_degraded THEN '{D.REASON_DEGRADED}'
       WHEN feature_drift_persistent THEN '{D.REASON_DRIFT}' ELSE '{D.REASON_NOTHING}' END AS summary
FROM sig"""
    return with_ctes("""
SELECT "group", CASE MAX(rk) WHEN 2 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'info' END AS severity,
       '[FIRING] ' || "group" AS title,
       string_agg(line, chr(10) ORDER BY alertname, line) || chr(10) || 'Alert count: ' || COUNT(*) AS message,
       COUNT(*) AS alert_count
FROM (SELECT 'stores-' || s.StoreType || '-' || (d.Store // 100) AS "group", 'Retrain_' || d.action || '_' || d.Store AS alertname,
             CASE d.action WHEN 'block' THEN 2 WHEN 'train_candidate' THEN 1 ELSE 0 END AS rk,
             '- ' || 'Retrain_' || d.action || '_' || d.Store || ' | service=forecasting-api | ' || d.summary AS line
      FROM dec d JOIN store_dim s USING (Store)) a
GROUP BY "group" """, "naive_predictions", "store_dim", extra={**_SIGNALS, "dec": dec})


@query("agg_26_alert_grouping", _alerts_sql())
def agg_26_alert_grouping(spark, sf_dir):
    """Store retraining decisions as alerts, grouped per store type and hundred of
    stores (at most 100 alerts in a group)."""
    return S.group_alerts(_alerts(spark, sf_dir))


RUNS_SQL = """SELECT o_orderdate AS start_time, o_totalprice AS duration_seconds,
  ROUND(o_totalprice / 3600.0 * 0.35, 6) AS cost, 'EUR' AS currency FROM orders"""


def _runs(spark, sf_dir):
    o = Inputs(spark, sf_dir).t.orders
    return o.select(F.col("o_orderdate").cast("timestamp").alias("start_time"),
                    F.col("o_totalprice").alias("duration_seconds"),
                    S.run_cost(F.col("o_totalprice")).alias("cost"), F.lit("EUR").alias("currency"))


@query("agg_21_training_cost_window", with_ctes("""
SELECT 7 AS window_days, COUNT(*) AS run_count, ROUND(COALESCE(SUM(cost), 0.0), 6) AS total_training_cost,
       ROUND(COALESCE(SUM(duration_seconds), 0.0), 3) AS total_training_duration_seconds,
       ROUND(CASE WHEN COUNT(*) > 0 THEN SUM(cost) / COUNT(*) ELSE 0.0 END, 6) AS avg_training_cost,
       ROUND(CASE WHEN COUNT(*) > 0 THEN SUM(duration_seconds) / COUNT(*) ELSE 0.0 END, 3) AS avg_training_duration_seconds,
       COALESCE(arg_min(currency, start_time), 'EUR') AS currency
FROM runs WHERE start_time >= (SELECT MAX(start_time) FROM runs) - INTERVAL 7 DAY""", extra={"runs": RUNS_SQL}))
def agg_21_training_cost_window(spark, sf_dir):
    """Orders as training runs (duration = total price in seconds); the
    window ends at the newest run."""
    runs = _runs(spark, sf_dir)
    now = runs.agg(F.max("start_time")).scalar()
    return S.cost_summary(runs, now, 7)


@query("agg_22_monthly_cost_scenarios", with_ctes("""
SELECT scenario, runs_per_month, ROUND(avg_cost * runs_per_month, 6) AS estimated_monthly_cost
FROM (SELECT ROUND(SUM(cost) / COUNT(*), 6) AS avg_cost FROM runs WHERE start_time >= (SELECT MAX(start_time) FROM runs) - INTERVAL 7 DAY) a,
     (VALUES ('daily_retraining', 30), ('weekly_retraining', 4), ('drift_triggered_retraining', 8)) v(scenario, runs_per_month)""",
                                                    extra={"runs": RUNS_SQL}))
def agg_22_monthly_cost_scenarios(spark, sf_dir):
    runs = _runs(spark, sf_dir)
    now = runs.agg(F.max("start_time")).scalar()
    return S.monthly_scenarios(S.cost_summary(runs, now, 7))
