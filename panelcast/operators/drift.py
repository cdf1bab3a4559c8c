"""Distribution drift: two-sample KS, chi-square, drift runs, persistence.

KS needs cumulative counts over the sorted distinct values of a feature.
A window ordered by value with the feature as its only key would put all
distinct values of a feature into one task, so instead:

1. counts per (feature, value) and sample side (partial aggregation: a hot
   value becomes one row per task);
2. ``repartitionByRange`` on (feature, value) -> balanced ordered slices,
   checkpointed so that slice ids are fixed for both consumers;
3. per-slice totals (one row per slice), prefix offsets by a window over
   that small table (slices x features rows), joined back (broadcast by the
   planner when under its size threshold);
4. slice-local running sums (``mapInPandas`` over the sorted slice), plus
   the offsets = global cumulative counts; D = max |F_ref - F_cur|.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.stats import chi2_sf, ks_pvalue
from panelcast.session import cut_lineage

# Drift settings of the reference configuration.
MIN_SAMPLES = 50
P_VALUE_THRESHOLD = 0.01
STAT_THRESHOLD = 0.10
EXPECTED_FLOOR = 1e-9
# Reasons of the persistence rules.
REASON_NO_DRIFT_HISTORY = "No feature drift history available."
REASON_FEW_DRIFT_WINDOWS = "Not enough recent feature drift windows: "
REASON_NO_DRIFT = "No feature drift persisted across {n} windows."
REASON_PERSISTENT_DRIFT = "Persistent feature drift detected for: "
REASON_FEW_WINDOWS = "Not enough performance windows: "
REASON_NOT_DEGRADED = "Performance degradation is not persistent across {n} windows."
REASON_PERSISTENT_DEGRADATION = "Persistent performance degradation detected across {n} windows."


def long_samples(reference: DataFrame, current: DataFrame, features: Sequence[str],
                 group_cols: Sequence[str] = (), numeric: bool = True) -> DataFrame:
    """(group..., feature, value, side) with side 0 = reference, 1 = current.
    Numeric: coerced to double, non-numeric dropped. Categorical: text with
    NULL -> 'nan' (the reference's ``astype(str)``)."""
    def one(df: DataFrame, side: int) -> DataFrame:
        if numeric:
            vals = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").try_cast("double").alias("value"))
                    for f in features]
        else:
            vals = [F.struct(F.lit(f).alias("feature"),
                             F.coalesce(F.col(f).cast("string"), F.lit("nan")).alias("value")) for f in features]
        out = df.select(*group_cols, F.explode(F.array(*vals)).alias("kv")).select(
            *group_cols, "kv.feature", "kv.value", F.lit(side).alias("side"))
        if numeric:
            out = out.filter(F.col("value").isNotNull() & ~F.isnan("value"))
        return out
    return one(reference, 0).unionByName(one(current, 1))


def _local_cumsum(keys: list[str]):
    """Running sums inside one sorted slice, vectorised per Arrow batch; the
    last key's totals carry over to the next batch of the same slice."""
    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry_key, carry = None, (0.0, 0.0)
        for pdf in batches:
            if pdf.empty:
                continue
            vals = pdf[["c_ref", "c_cur"]].astype("float64")
            cum = vals.groupby([pdf[k] for k in keys], sort=False).cumsum()
            first = tuple(pdf[keys].iloc[0])
            if carry_key is not None and first == carry_key:
                same = (pdf[keys] == pd.Series(first, index=keys)).all(axis=1).to_numpy()
                cum.loc[same, "c_ref"] += carry[0]
                cum.loc[same, "c_cur"] += carry[1]
            carry_key = tuple(pdf[keys].iloc[-1])
            carry = (float(cum["c_ref"].iloc[-1]), float(cum["c_cur"].iloc[-1]))
            yield pdf.assign(cum_ref=cum["c_ref"].to_numpy(), cum_cur=cum["c_cur"].to_numpy())
    return fn


def ks_statistic(long: DataFrame, keys: Sequence[str] = ("feature",), slices: int | None = None) -> DataFrame:
    """AGG-13 core: per key, D = max |F_ref(v) - F_cur(v)| and both sizes."""
    keys = list(keys)
    spark = long.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    counts = long.groupBy(*keys, "value").agg(
        F.sum(1 - F.col("side")).cast("double").alias("c_ref"), F.sum("side").cast("double").alias("c_cur"))
    ranged = counts.repartitionByRange(slices, *keys, "value").withColumn("slice", F.spark_partition_id())
    ranged = cut_lineage(ranged)
    totals = ranged.groupBy(*keys, "slice").agg(F.sum("c_ref").alias("t_ref"), F.sum("c_cur").alias("t_cur"))
    w = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "slice",
                            F.coalesce(F.sum("t_ref").over(w), F.lit(0.0)).alias("o_ref"),
                            F.coalesce(F.sum("t_cur").over(w), F.lit(0.0)).alias("o_cur"))
    sizes = totals.groupBy(*keys).agg(F.sum("t_ref").alias("n_ref"), F.sum("t_cur").alias("n_cur"))
    schema = T.StructType([*ranged.schema.fields, T.StructField("cum_ref", T.DoubleType()),
                           T.StructField("cum_cur", T.DoubleType())])
    local = ranged.sortWithinPartitions(*keys, "value").mapInPandas(_local_cumsum(keys), schema)
    # offsets / sizes: one row per (slice, key) / key. Without group keys
    # that is slices x features rows; the planner (and AQE at runtime)
    # broadcasts them when under the size threshold.
    g = local.join(offsets, [*keys, "slice"]).join(sizes, keys)
    f_ref = F.try_divide(F.col("o_ref") + F.col("cum_ref"), F.col("n_ref"))
    f_cur = F.try_divide(F.col("o_cur") + F.col("cum_cur"), F.col("n_cur"))
    d = g.groupBy(*keys).agg(F.max(F.abs(f_ref - f_cur)).alias("score"))
    return sizes.join(d, keys, "left").select(
        *keys, F.coalesce("score", F.lit(0.0)).alias("score"),
        F.col("n_ref").cast("long").alias("reference_n"), F.col("n_cur").cast("long").alias("current_n"))


def _keyed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``_key``: the group and feature as one text that is never NULL, so that NULL
    groups aggregate and join like any other."""
    parts = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in cols]
    return df.withColumn("_key", F.concat_ws("\u0001", *parts))


def numeric_drift(reference: DataFrame, current: DataFrame, features: Sequence[str],
                  group_cols: Sequence[str] = (), min_samples: int = MIN_SAMPLES,
                  p_threshold: float = P_VALUE_THRESHOLD, stat_threshold: float = STAT_THRESHOLD,
                  current_only_floor: bool = False) -> DataFrame:
    """AGG-13: KS per feature (and group); below ``min_samples`` ->
    insufficient; drift when p < 0.01 and D > 0.10."""
    long = _keyed(long_samples(reference, current, features, group_cols, numeric=True), [*group_cols, "feature"])
    base = _feature_frame(reference.sparkSession, features, group_cols, long)
    ks = ks_statistic(long, ["_key"])
    j = base.join(ks, "_key", "left").fillna(0, ["reference_n", "current_n"])
    short = (F.col("current_n") < min_samples) if current_only_floor else \
        ((F.col("reference_n") < min_samples) | (F.col("current_n") < min_samples))
    # the p-value of a short sample is never used: its recursion is not run
    p = ks_pvalue(F.when(~short, F.col("score")), F.col("reference_n"), F.col("current_n"))
    return j.select(
        *group_cols, "feature", F.lit("numeric").alias("feature_type"), F.lit("ks").alias("metric_type"),
        F.when(short, F.lit(0.0)).otherwise(F.col("score")).alias("score"),
        F.when(short, F.lit(1.0)).otherwise(p).alias("p_value"),
        F.lit(stat_threshold).alias("threshold"),
        F.when(short, F.lit(False)).otherwise((p < p_threshold) & (F.col("score") > stat_threshold)).alias("drift_detected"),
        "reference_n", "current_n",
        F.when(short, F.lit("insufficient_samples")).otherwise(F.lit("")).alias("reason"))


def _feature_frame(spark, features, group_cols, long: DataFrame) -> DataFrame:
    if group_cols:
        return long.select(*group_cols, "feature", "_key").distinct()
    return _keyed(spark.createDataFrame([(f,) for f in features], "feature string"), ["feature"])


def categorical_drift(reference: DataFrame, current: DataFrame, features: Sequence[str],
                      group_cols: Sequence[str] = (), min_samples: int = MIN_SAMPLES,
                      p_threshold: float = P_VALUE_THRESHOLD) -> DataFrame:
    """AGG-15: chi-square of current counts against reference shares scaled
    to the current total (expected floored at 1e-9), over the union of
    categories (JON-14, absent = 0); dof = categories - 1."""
    long = _keyed(long_samples(reference, current, features, group_cols, numeric=False), [*group_cols, "feature"])
    keys = ["_key"]
    counts = long.groupBy(*keys, "value").agg(
        F.sum(1 - F.col("side")).alias("c_ref"), F.sum("side").alias("c_cur"))
    # Sample sizes per feature: a small aggregate (one row per feature and
    # group) joined back -- no window over all categories. The planner
    # broadcasts it when its size is under the threshold (AQE at runtime).
    sizes = counts.groupBy(*keys).agg(F.sum("c_ref").alias("n_ref"), F.sum("c_cur").alias("n_cur"))
    per = counts.join(sizes, keys)
    expected = F.greatest(F.col("c_ref") / F.col("n_ref") * F.col("n_cur"), F.lit(EXPECTED_FLOOR))
    stat = per.groupBy(*keys).agg(
        F.sum((F.col("c_cur") - expected) ** 2 / expected).alias("score"),
        F.count(F.lit(1)).alias("categories"),
        F.first("n_ref").cast("long").alias("reference_n"), F.first("n_cur").cast("long").alias("current_n"))
    base = _feature_frame(reference.sparkSession, features, group_cols, long)
    j = base.join(stat, keys, "left").fillna(0, ["reference_n", "current_n", "categories"])
    short = (F.col("reference_n") < min_samples) | (F.col("current_n") < min_samples)
    p = chi2_sf(F.col("score"), F.col("categories") - 1)
    return j.select(
        *group_cols, "feature", F.lit("categorical").alias("feature_type"), F.lit("chisquare").alias("metric_type"),
        F.when(short, F.lit(0.0)).otherwise(F.col("score")).alias("score"),
        F.when(short, F.lit(1.0)).otherwise(p).alias("p_value"),
        F.lit(p_threshold).alias("threshold"),
        F.when(short, F.lit(False)).otherwise(p < p_threshold).alias("drift_detected"),
        "reference_n", "current_n",
        F.when(short, F.lit("insufficient_samples")).otherwise(F.lit("")).alias("reason"))


def target_drift(reference: DataFrame, current: DataFrame, target: str, p_threshold: float = 0.05,
                 stat_threshold: float = 0.1, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """AGG-14: KS on target values > 0 only; only the current side has the
    50-row floor."""
    ref = reference.filter(F.col(target).cast("double") > 0)
    cur = current.filter(F.col(target).cast("double") > 0)
    return numeric_drift(ref, cur, [target], min_samples=min_samples, p_threshold=p_threshold,
                         stat_threshold=stat_threshold, current_only_floor=True)


def drift_run(reference: DataFrame, current: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
              run_ts=None, group_cols: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """AGG-16: all configured features present on both sides, one stamped
    result table; returns (results, skipped feature names)."""
    both = set(reference.columns) & set(current.columns)
    num = [f for f in numeric if f in both]
    cat = [f for f in categorical if f in both]
    skipped = [f for f in [*numeric, *categorical] if f not in both]
    parts = []
    if num:
        parts.append(numeric_drift(reference, current, num, group_cols))
    if cat:
        parts.append(categorical_drift(reference, current, cat, group_cols))
    if not parts:
        raise ValueError("no drift features present")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if run_ts is not None:
        out = out.withColumn("timestamp", F.lit(run_ts).cast("timestamp"))
    return out, skipped


def drift_summary(results: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Summary: checked, drifted, sorted drifted names."""
    return results.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("checked_features"),
        F.count_if("drift_detected").alias("drifted_features"),
        F.array_sort(F.collect_list(F.when(F.col("drift_detected"), F.col("feature")))).alias("drifted_feature_names"))


def persistent_drift(history: DataFrame, at, lookback_days: int = 14, windows: int = 2,
                     ts_col: str = "timestamp") -> DataFrame:
    """AGG-17: in (at - lookback, at], take the last N distinct timestamps;
    a feature persists when it appears in all N with drift each time and
    exactly one row per window (count == N). Fewer than N windows -> not
    triggered. One row: triggered, windows_found, window_end, features, reason."""
    at_c = (at if isinstance(at, Column) else F.lit(at)).cast("timestamp")
    ts = F.col(ts_col).cast("timestamp")
    recent = history.filter((ts >= at_c - F.expr(f"INTERVAL {lookback_days} DAYS")) & (ts <= at_c)) \
                    .withColumn("_ts", ts)
    last = recent.select("_ts").distinct().orderBy(F.col("_ts").desc()).limit(windows)
    inwin = recent.join(last, "_ts", "left_semi")
    per = inwin.groupBy("feature").agg(F.count(F.lit(1)).alias("n"),
                                       F.count_if(F.col("drift_detected")).alias("drifted"))
    feats = per.filter((F.col("n") == windows) & (F.col("drifted") == windows)).agg(
        F.array_sort(F.collect_list("feature")).alias("features"))
    found = last.agg(F.count(F.lit(1)).alias("windows_found"), F.max("_ts").alias("window_end"))
    none = F.array().cast("array<string>")
    out = found.select("windows_found", "window_end", F.when(F.col("windows_found") >= windows, F.coalesce(
        feats.scalar(), none)).otherwise(none).alias("features"))
    reason = (F.when(F.col("windows_found") == 0, F.lit(REASON_NO_DRIFT_HISTORY))
              .when(F.col("windows_found") < windows, F.concat(
                  F.lit(REASON_FEW_DRIFT_WINDOWS), F.col("windows_found").cast("string"), F.lit(f"/{windows}.")))
              .when(F.size("features") == 0, F.lit(REASON_NO_DRIFT.format(n=windows)))
              .otherwise(F.concat(F.lit(REASON_PERSISTENT_DRIFT + "['"), F.array_join("features", "', '"), F.lit("']."))))
    return out.select((F.size("features") > 0).alias("triggered"), "windows_found", "window_end", "features",
                      reason.alias("reason"))


def drift_history(df: DataFrame, features: Sequence[str], at: Column, offsets: Sequence[int], days: int = 365,
                  group_cols: Sequence[str] = (), time: str = "Date", min_samples: int = MIN_SAMPLES) -> DataFrame:
    """AGG-16 repeated: numeric drift at ``at`` minus each of ``offsets`` days, the last
    ``days`` days against all before them, in one job; ``timestamp`` is the window end. A
    row is read once and goes to the evaluations that had seen it."""
    ends = F.explode(F.array(*[F.date_sub(at, n) for n in offsets])).alias("timestamp")
    seen = df.select(*group_cols, time, *features, ends).filter(F.col(time) <= F.col("timestamp"))
    current = F.col(time) > F.date_sub("timestamp", days)
    return numeric_drift(seen.filter(~current), seen.filter(current), features, [*group_cols, "timestamp"],
                         min_samples=min_samples)


def persistent_drift_by(history: DataFrame, at: Column, group_by: Sequence[str], lookback_days: int = 14,
                        windows: int = 2, ts_col: str = "timestamp") -> DataFrame:
    """AGG-17 for every key of ``group_by`` in one job: one rank over a key's evaluations
    and two aggregates. Keys without a window in the look-back have no row."""
    keys, ts, at_c = list(group_by), F.col(ts_col).cast("timestamp"), at.cast("timestamp")
    recent = history.filter((ts >= at_c - F.expr(f"INTERVAL {lookback_days} DAYS")) & (ts <= at_c)).withColumn("_ts", ts)
    rank = F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.col("_ts").desc()))
    per = recent.withColumn("_rank", rank).filter(F.col("_rank") <= windows).groupBy(*keys, "feature").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("drift_detected").alias("drifted"), F.max("_rank").alias("_rank"),
        F.max("_ts").alias("_ts"))
    held = F.when((F.col("n") == windows) & (F.col("drifted") == windows), F.col("feature"))
    out = per.groupBy(*keys).agg(F.max("_rank").alias("windows_found"), F.max("_ts").alias("window_end"),
                                 F.array_sort(F.collect_list(held)).alias("features"))
    reason = (F.when(F.col("windows_found") < windows, F.concat(
        F.lit(REASON_FEW_DRIFT_WINDOWS), F.col("windows_found").cast("string"), F.lit(f"/{windows}.")))
        .when(F.size("features") == 0, F.lit(REASON_NO_DRIFT.format(n=windows)))
        .otherwise(F.concat(F.lit(REASON_PERSISTENT_DRIFT + "['"), F.array_join("features", "', '"), F.lit("']."))))
    return out.select(*keys, (F.size("features") > 0).alias("triggered"), "windows_found", "window_end", "features",
                      reason.alias("reason"))


def persistent_degradation(history: DataFrame, windows: int = 2, rmse_limit: float = 1375.0,
                           mae_limit: float = 990.0, bias_limit: float = 900.0,
                           end_col: str = "window_end", *, order_col: str,
                           group_by: Sequence[str] = ()) -> DataFrame:
    """AGG-18: the last N distinct window ends (the last row per end by
    ``order_col``, which the caller names); bad = (rmse > lim and mae > lim) or
    |bias| > lim; triggered when N windows exist and all are bad."""
    from panelcast.operators.dedup import dedup_last
    keys = list(group_by)
    h = dedup_last(history, [*keys, end_col], order_col)
    # Last N window ends per key: a rank filter (Spark applies it as a
    # per-partition group limit before the shuffle).
    rk = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(end_col).desc()))
    last = h.withColumn("_rk", rk).filter(F.col("_rk") <= windows)
    bad = ((F.col("rmse") > rmse_limit) & (F.col("mae") > mae_limit)) | (F.abs(F.col("bias")) > bias_limit)
    return last.groupBy(*keys).agg(F.count(F.lit(1)).alias("windows_found"), F.count_if(bad).alias("bad_windows"),
                                   F.max(end_col).alias("performance_window_end")).select(
        *keys, ((F.col("windows_found") == windows) & (F.col("bad_windows") == windows)).alias("triggered"),
        "windows_found", "bad_windows", "performance_window_end",
        F.when(F.col("windows_found") < windows, F.concat(
            F.lit(REASON_FEW_WINDOWS), F.col("windows_found").cast("string"), F.lit(f"/{windows}.")))
        .when(F.col("bad_windows") < windows, F.lit(REASON_NOT_DEGRADED.format(n=windows)))
        .otherwise(F.lit(REASON_PERSISTENT_DEGRADATION.format(n=windows))).alias("reason"))
