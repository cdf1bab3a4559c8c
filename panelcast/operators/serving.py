"""Request-log statistics: window summary, latency histogram, SLO rules,
alert grouping, training costs.

Percentiles are exact nearest-rank over latencies rounded to 0.01 ms (as
the reference stores them): counts per distinct latency value are summed
map-side, and the running count runs over distinct values of one window,
which is bounded by the rounding grid, not by the number of requests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Latency histogram bucket bounds in seconds.
LATENCY_BUCKETS_SECONDS = (0.005, 0.010, 0.025, 0.050, 0.100, 0.250, 0.500, 1.000, 3.000, 5.000)
PERCENTILES = {"p50": 0.50, "p95": 0.95, "p99": 0.99}
# Alert severities in rank order.
SEVERITY_RANK = {"info": 0, "warning": 1, "critical": 2}


def with_window(df: DataFrame, seconds: int, ts: str = "ts") -> DataFrame:
    """Tumbling window start of ``seconds`` (epoch aligned)."""
    start = F.timestamp_seconds(F.floor(F.unix_timestamp(F.col(ts)) / seconds) * seconds)
    return df.withColumn("window_start", start)


def request_summary(events: DataFrame, window_seconds: int = 900, ts: str = "ts") -> DataFrame:
    """AGG-23: per window: totals, successes (2xx), errors, rates (4 dp),
    p50/p95/p99 by nearest rank ``rint((n-1)*p)``, avg and max latency (ms)."""
    ev = with_window(events, window_seconds, ts).withColumn(
        "latency_ms", F.round(F.col("latency_seconds") * 1000.0, 2))
    ok = (F.col("status_code") >= 200) & (F.col("status_code") < 300)
    base = ev.groupBy("window_start").agg(
        F.count(F.lit(1)).alias("requests_total"), F.count_if(ok).alias("success_total"),
        # exact: sum of integer hundredths, then half-even to 2 dp
        F.sum(F.round(F.col("latency_ms") * 100).cast("long")).alias("_sum_h"), F.max("latency_ms").alias("latency_max_ms"))
    counts = ev.groupBy("window_start", "latency_ms").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("window_start").orderBy("latency_ms").rowsBetween(Window.unboundedPreceding, 0)
    cum = counts.withColumn("cum", F.sum("c").over(w)).join(base.select("window_start", "requests_total"), "window_start")
    pct = []
    for name, p in PERCENTILES.items():
        idx = F.bround((F.col("requests_total") - 1) * p, 0)
        # first distinct value whose running count passes the index
        pct.append(F.min(F.when(F.col("cum") > idx, F.col("latency_ms"))).alias(f"latency_{name}_ms"))
    perc = cum.groupBy("window_start").agg(*pct)
    out = base.join(perc, "window_start")
    return out.select(
        "window_start", F.lit(window_seconds).alias("window_seconds"), "requests_total", "success_total",
        (F.col("requests_total") - F.col("success_total")).alias("error_total"),
        F.round(F.col("success_total") / F.col("requests_total"), 4).alias("success_rate"),
        F.round((F.col("requests_total") - F.col("success_total")) / F.col("requests_total"), 4).alias("error_rate"),
        "latency_p50_ms", "latency_p95_ms", "latency_p99_ms",
        (F.bround(F.col("_sum_h") / F.col("requests_total"), 0) / 100.0).alias("latency_avg_ms"), "latency_max_ms")


def summary_of_counts(counts: DataFrame, window_seconds: int = 900) -> DataFrame:
    """AGG-23 from counts (window_start, status_code, path, latency_ms, n) of closed windows,
    as a stream writes them: the same columns as ``request_summary``."""
    ok = (F.col("status_code") >= 200) & (F.col("status_code") < 300)
    n = F.col("requests_total")
    base = counts.groupBy("window_start").agg(
        F.sum("n").alias("requests_total"), F.coalesce(F.sum(F.when(ok, F.col("n"))), F.lit(0)).alias("success_total"),
        F.sum(F.round(F.col("latency_ms") * 100).cast("long") * F.col("n")).alias("sum_h"),
        F.max("latency_ms").alias("latency_max_ms"))
    values = counts.groupBy("window_start", "latency_ms").agg(F.sum("n").alias("c"))
    w = Window.partitionBy("window_start").orderBy("latency_ms").rowsBetween(Window.unboundedPreceding, 0)
    running = values.withColumn("cum", F.sum("c").over(w)).join(base.select("window_start", "requests_total"), "window_start")
    ranks = running.groupBy("window_start").agg(*[
        F.min(F.when(F.col("cum") > F.bround((n - 1) * p, 0), F.col("latency_ms"))).alias(f"latency_{name}_ms")
        for name, p in PERCENTILES.items()])
    errors = n - F.col("success_total")
    return base.join(ranks, "window_start").select(
        "window_start", F.lit(window_seconds).alias("window_seconds"), "requests_total", "success_total",
        errors.alias("error_total"), F.round(F.col("success_total") / n, 4).alias("success_rate"),
        F.round(errors / n, 4).alias("error_rate"), *[f"latency_{name}_ms" for name in PERCENTILES],
        (F.bround(F.col("sum_h") / n, 0) / 100.0).alias("latency_avg_ms"), "latency_max_ms")


def request_breakdown(events: DataFrame, window_seconds: int = 900, ts: str = "ts") -> DataFrame:
    """AGG-23 maps: counts by status code and by path per window (bounded
    by the number of distinct codes / tracked paths)."""
    ev = with_window(events, window_seconds, ts)
    st = ev.groupBy("window_start", F.col("status_code").cast("string").alias("k")).count().groupBy("window_start").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "count")))).alias("status_codes"))
    pa = ev.groupBy("window_start", F.col("path").alias("k")).count().groupBy("window_start").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "count")))).alias("paths"))
    return st.join(pa, "window_start")


def bucket_of(lat: Column, buckets: Sequence[float] = LATENCY_BUCKETS_SECONDS) -> Column:
    """Smallest bucket bound >= latency (+Inf beyond the last)."""
    expr = F.when(lat <= buckets[0], F.lit(buckets[0]))
    for b in buckets[1:]:
        expr = expr.when(lat <= b, F.lit(b))
    return expr.otherwise(F.lit(float("inf")))


def bucket_labels(buckets: Sequence[float] = LATENCY_BUCKETS_SECONDS) -> list[str]:
    return [repr(float(b)) for b in buckets] + ["+Inf"]


def latency_histogram(events: DataFrame, keys: Sequence[str] = ("method", "path"),
                      buckets: Sequence[float] = LATENCY_BUCKETS_SECONDS) -> DataFrame:
    """AGG-24: cumulative bucket counts per (method, path).

    Each request is counted once in its own bucket (one aggregate, no row
    explosion), then made cumulative over the (at most 11) buckets of a key.
    Every bound appears, also with zero requests; ``le`` is the text label.
    """
    keys = list(keys)
    lat = F.col("latency_seconds")
    idx = F.when(lat <= buckets[0], F.lit(0))
    for i, b in enumerate(buckets[1:], start=1):
        idx = idx.when(lat <= b, F.lit(i))
    idx = idx.otherwise(F.lit(len(buckets)))
    per = events.groupBy(*keys, idx.alias("bucket")).count()
    grid = per.select(*keys).distinct().withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(len(buckets)))))
    full = grid.join(per, [*keys, "bucket"], "left").fillna(0, ["count"])
    w = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    labels = F.array(*[F.lit(x) for x in bucket_labels(buckets)])
    return full.select(*keys, "bucket", F.element_at(labels, F.col("bucket") + 1).alias("le"),
                       F.sum("count").over(w).alias("cumulative_count"))


def slo_breaches(events: DataFrame, path: str = "/predict", window_minutes: int = 10, hold_minutes: int = 5,
                 min_requests: int = 20, error_ratio: float = 0.01, p95_seconds: float = 1.0,
                 buckets: Sequence[float] = LATENCY_BUCKETS_SECONDS) -> DataFrame:
    """AGG-25: per evaluation minute, the 10-minute 5xx ratio and histogram
    p95 of one path; a rule fires when its condition held at every minute of
    the last ``hold_minutes`` (the ``for: 5m`` clause).

    Per-minute partial counts (one aggregate) are added to the minutes whose
    window holds them: the expansion is over minutes, not over requests.
    """
    ev = events.filter(F.col("path") == path).withColumn(
        "minute", F.floor(F.unix_timestamp("ts") / 60).cast("long"))
    b = bucket_of(F.col("latency_seconds"), buckets)
    bound_list = [*buckets, float("inf")]
    per = ev.groupBy("minute").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("status_code") >= 500).alias("e5"),
        *[F.count_if(b <= F.lit(x)).alias(f"b{i}") for i, x in enumerate(bound_list)])
    # The minutes of the span, day by day; every minute's counts go to the windows that
    # contain it, so no window or array spans the whole time.
    span = per.agg(F.floor(F.min("minute") / 1440).alias("d0"), F.floor(F.max("minute") / 1440).alias("d1"),
                   F.min("minute").alias("lo"), F.max("minute").alias("hi"))
    days = span.select("lo", "hi", F.explode(F.sequence("d0", "d1")).alias("day"))
    grid = days.select("lo", "hi", F.explode(F.sequence(F.col("day") * 1440, F.col("day") * 1440 + 1439)).alias("minute"))
    grid = grid.where(F.col("minute").between(F.col("lo"), F.col("hi"))).select("minute", "lo")
    cols = ["n", "e5", *[f"b{i}" for i in range(len(bound_list))]]
    into = per.withColumn("minute", F.explode(F.sequence(F.col("minute"), F.col("minute") + window_minutes - 1)))
    sums = into.groupBy("minute").agg(*[F.sum(c).alias(c) for c in cols])
    roll = grid.join(sums, "minute", "left").fillna(0, cols)
    ratio = F.col("e5") / F.greatest(F.col("n"), F.lit(1))
    # p95 over the cumulative buckets: inside the first bucket whose count reaches the rank.
    # The bucket is looked up once per minute; the rules below refer to the columns.
    rank = F.col("n") * 0.95
    counts = F.array(*[F.col(f"b{i}") for i in range(len(bound_list))])
    at = F.array_position(F.transform(counts, lambda c: c >= rank), True).cast("int")
    below = F.when(F.col("at") > 1, F.get("counts", F.col("at") - 2)).otherwise(F.lit(0))
    bounds = F.array(*[F.lit(float(x)) for x in (0.0, *buckets)])
    low, high = F.get(bounds, F.col("at") - 1), F.get(bounds, F.col("at"))
    inside = low + (high - low) * (rank - below) / (F.get("counts", F.col("at") - 1) - below)
    roll = roll.withColumns({"counts": counts, "at": at})
    p95 = F.when(F.col("at") == len(bound_list), F.lit(float(bound_list[-2]))).otherwise(inside)
    busy = F.col("n") >= min_requests
    roll = roll.select("minute", "lo", "n", "e5", ratio.alias("error_ratio"), F.when(F.col("n") > 0, p95).alias("p95_seconds"))
    roll = roll.withColumns({
        "error_condition": (F.col("error_ratio") > error_ratio) & busy,
        "latency_condition": F.coalesce(F.col("p95_seconds") > p95_seconds, F.lit(False)) & busy})
    # A rule fires when its condition held in all minutes of the hold time (as far as the
    # span goes): a minute goes to itself, and its conditions to the minutes that look back on it.
    reach = F.when(F.col("error_condition") | F.col("latency_condition"), F.lit(hold_minutes)).otherwise(F.lit(0))
    into = roll.withColumn("at", F.explode(F.sequence(F.col("minute"), F.col("minute") + reach)))
    own = ["lo", "n", "e5", "error_ratio", "p95_seconds", "error_condition", "latency_condition"]
    held = into.groupBy("at").agg(
        F.count_if("error_condition").alias("e_held"), F.count_if("latency_condition").alias("l_held"),
        F.max(F.when(F.col("at") == F.col("minute"), F.struct(*own))).alias("own")).where("own IS NOT NULL")
    need = F.least(F.lit(hold_minutes + 1), F.col("at") - F.col("own.lo") + 1)
    return held.select(F.timestamp_seconds(F.col("at") * 60).alias("minute"), F.col("own.n").alias("requests"),
                       F.col("own.e5").alias("server_errors"), "own.error_ratio", "own.p95_seconds", "own.error_condition",
                       "own.latency_condition", (F.col("e_held") == need).alias("error_firing"),
                       (F.col("l_held") == need).alias("latency_firing"))


def readiness_breaches(events: DataFrame, path: str = "/health", hold_minutes: int = 2) -> DataFrame:
    """AGG-25, readiness: per minute of the log, the newest probe's state (0 after a 5xx) and
    whether the service was not ready, or not probed at all, in that minute and the
    ``hold_minutes`` before it (as far as the log goes)."""
    minute = F.floor(F.unix_timestamp("ts") / 60).cast("long")
    probes = events.filter(F.col("path") == path).groupBy(minute.alias("minute")).agg(
        F.max(F.struct("ts", F.col("status_code"))).alias("newest"))
    state = probes.select("minute", (F.col("newest.status_code") < 500).cast("int").alias("ready"))
    span = events.agg(F.min(minute).alias("lo"), F.max(minute).alias("hi"))
    days = span.select("lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / 1440), F.floor(F.col("hi") / 1440))).alias("day"))
    grid = (days.select("lo", "hi", F.explode(F.sequence(F.col("day") * 1440, F.col("day") * 1440 + 1439)).alias("minute"))
            .where(F.col("minute").between(F.col("lo"), F.col("hi"))).select("minute", "lo"))
    rows = grid.join(state, "minute", "left").withColumn("condition", F.coalesce(F.col("ready") == 0, F.lit(True)))
    reach = F.when(F.col("condition"), F.lit(hold_minutes)).otherwise(F.lit(0))
    into = rows.withColumn("at", F.explode(F.sequence(F.col("minute"), F.col("minute") + reach)))
    held = into.groupBy("at").agg(
        F.count_if("condition").alias("held"),
        F.max(F.when(F.col("at") == F.col("minute"), F.struct("lo", "ready", "condition"))).alias("own")).where("own IS NOT NULL")
    need = F.least(F.lit(hold_minutes + 1), F.col("at") - F.col("own.lo") + 1)
    return held.select(F.timestamp_seconds(F.col("at") * 60).alias("minute"), "own.ready", F.col("own.condition"),
                       (F.col("held") == need).alias("firing"))


# Texts of the alert message.
DEFAULT_SEVERITY = "warning"
UNNAMED_ALERT, UNKNOWN_SERVICE, NO_SUMMARY = "UnnamedAlert", "unknown", "No summary provided."


def group_alerts(alerts: DataFrame, group_col: str = "group", status: str = "firing") -> DataFrame:
    """AGG-26: per alert group: max severity (critical > warning > info; a missing
    one is a warning), title, message lines (sorted by alert name, a description on
    its own line below), alert count. A group is one notification, so its lines meet
    in one row: group by a key with a bounded number of alerts."""
    severity = F.lower(F.coalesce("severity", F.lit(DEFAULT_SEVERITY)))
    rank = F.when(severity == "critical", 2).when(severity == "warning", 1).otherwise(0)
    line = F.concat(F.lit("- "), F.coalesce("alertname", F.lit(UNNAMED_ALERT)), F.lit(" | service="),
                    F.coalesce("service", F.lit(UNKNOWN_SERVICE)), F.lit(" | "),
                    F.coalesce("summary", F.lit(NO_SUMMARY)))
    if "description" in alerts.columns:
        line = F.concat(line, F.when(F.col("description") != "", F.concat(F.lit("\n  "), "description")).otherwise(""))
    g = alerts.groupBy(group_col).agg(
        F.max(rank).alias("_rk"), F.count(F.lit(1)).alias("alert_count"),
        F.array_sort(F.collect_list(F.struct(F.col("alertname"), line.alias("l")))).alias("_lines"))
    sev = F.when(F.col("_rk") == 2, "critical").when(F.col("_rk") == 1, "warning").otherwise("info")
    msg = F.concat(F.array_join(F.transform("_lines", lambda s: s["l"]), "\n"), F.lit("\nAlert count: "),
                   F.col("alert_count").cast("string"))
    return g.select(group_col, sev.alias("severity"),
                    F.concat(F.lit(f"[{status.upper()}] "), F.col(group_col)).alias("title"),
                    msg.alias("message"), "alert_count")


# Cost rate and monthly scenarios.
HOURLY_RATE_EUR = 0.35
SCENARIOS = (("daily_retraining", 30), ("weekly_retraining", 4), ("drift_triggered_retraining", 8))


def run_cost(duration_seconds: Column, hourly_rate: float = HOURLY_RATE_EUR, enabled: bool = True) -> Column:
    """AGG-22: cost = seconds / 3600 * hourly rate, 6 dp."""
    return F.round(duration_seconds / 3600.0 * hourly_rate, 6) if enabled else F.lit(0.0)


def cost_summary(runs: DataFrame, now: Column, window_days: int = 7, start_col: str = "start_time",
                 cost_col: str = "cost", duration_col: str = "duration_seconds",
                 currency_col: str = "currency") -> DataFrame:
    """AGG-21: runs since now - window: count, total / avg cost (6 dp),
    total / avg duration (3 dp), first currency (EUR when absent)."""
    r = runs.filter(F.col(start_col) >= now - F.expr(f"INTERVAL {window_days} DAYS"))
    cost = F.coalesce(F.col(cost_col).cast("string").try_cast("double"), F.lit(0.0)) if cost_col in runs.columns else F.lit(0.0)
    dur = F.coalesce(F.col(duration_col).cast("string").try_cast("double"), F.lit(0.0)) if duration_col in runs.columns else F.lit(0.0)
    cur = F.col(currency_col) if currency_col in runs.columns else F.lit("EUR")
    a = r.agg(F.count(F.lit(1)).alias("run_count"), F.sum(cost).alias("_c"), F.sum(dur).alias("_d"),
              F.min_by(cur, F.col(start_col)).alias("_cur"))
    n = F.col("run_count")
    return a.select(
        F.lit(window_days).alias("window_days"), "run_count",
        F.round(F.coalesce("_c", F.lit(0.0)), 6).alias("total_training_cost"),
        F.round(F.coalesce("_d", F.lit(0.0)), 3).alias("total_training_duration_seconds"),
        F.round(F.when(n > 0, F.col("_c") / n).otherwise(0.0), 6).alias("avg_training_cost"),
        F.round(F.when(n > 0, F.col("_d") / n).otherwise(0.0), 3).alias("avg_training_duration_seconds"),
        F.coalesce("_cur", F.lit("EUR")).alias("currency"))


def monthly_scenarios(summary: DataFrame) -> DataFrame:
    """AGG-22: monthly cost scenarios from the average run cost (stack)."""
    rows = ", ".join(f"'{name}', {n}" for name, n in SCENARIOS)
    return summary.selectExpr("avg_training_cost", f"stack({len(SCENARIOS)}, {rows}) AS (scenario, runs_per_month)") \
        .select("scenario", "runs_per_month",
                F.round(F.col("avg_training_cost") * F.col("runs_per_month"), 6).alias("estimated_monthly_cost"))
