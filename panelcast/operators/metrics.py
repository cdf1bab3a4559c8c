"""Error metrics, segment metrics and time-window metrics.

All metrics are one-pass algebraic aggregates (partial per task, final
after the shuffle), so a hot group costs one row per task, never a
collected list. "NaN" results of the reference are NULL here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def error(y: str, yhat: str, sign: str = "actual_minus_pred") -> Column:
    """T1: one helper, explicit sign. ``actual_minus_pred`` (monitoring,
    back-tests) or ``pred_minus_actual`` (promotion, comparisons)."""
    if sign == "actual_minus_pred":
        return F.col(y).cast("double") - F.col(yhat).cast("double")
    if sign == "pred_minus_actual":
        return F.col(yhat).cast("double") - F.col(y).cast("double")
    raise ValueError(f"Unknown bias sign: {sign}")


def _metric_exprs(e: Column, y: Column | None = None, prefix: str = "",
                  extended: bool = False, cond: Column | None = None) -> list[Column]:
    """rmse, mae, bias, n over the rows where ``cond`` holds (all when None)."""
    def only(x: Column) -> Column:
        return x if cond is None else F.when(cond, x)

    out = [
        F.sqrt(F.avg(only(e * e))).alias(f"{prefix}rmse"),
        F.avg(only(F.abs(e))).alias(f"{prefix}mae"),
        F.avg(only(e)).alias(f"{prefix}bias"),
        F.count(only(e)).alias(f"{prefix}n_samples"),
    ]
    if extended:
        if y is None:
            raise ValueError("extended metrics need the actual column")
        abs_y = F.sum(only(F.abs(y)))
        out.append(F.when(abs_y > 0, F.sum(only(F.abs(e))) / abs_y).alias(f"{prefix}wmape"))
        ratio = F.when(y != 0, e / y)
        out.append(F.sqrt(F.avg(only(ratio * ratio))).alias(f"{prefix}rmspe"))
    return out


def clean_pairs(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """PRJ-07 for metrics: drop rows with a null or NaN actual / prediction."""
    return df.dropna(subset=[y, yhat]).filter(~F.isnan(F.col(y).cast("double"))
                                               & ~F.isnan(F.col(yhat).cast("double")))


def regression_metrics(df: DataFrame, y: str = "Sales", yhat: str = "prediction",
                       group_by: Sequence[str] = (), sign: str = "actual_minus_pred",
                       extended: bool = False, fail_if_empty: bool = True) -> DataFrame:
    """AGG-01 / AGG-02: rmse, mae, bias, n_samples (+ wmape, rmspe).

    Empty input is an error, raised inside the plan (no extra pass).
    """
    clean = clean_pairs(df, y, yhat)
    e = error(y, yhat, sign)
    res = clean.groupBy(*group_by).agg(*_metric_exprs(e, F.col(y).cast("double"), extended=extended))
    if fail_if_empty and not group_by:
        res = res.withColumn("n_samples", F.when(F.col("n_samples") > 0, F.col("n_samples")).otherwise(
            F.raise_error(F.lit("No rows available after dropping missing values.")).cast("long")))
    return res


def comparison_metrics(df: DataFrame, y: str = "Sales", yhat: str = "prediction",
                       group_by: Sequence[str] = ()) -> DataFrame:
    """AGG-03: rows, rmse, mae, wmape in percent, bias = mean(pred - actual); empty -> NULL."""
    e = error(y, yhat, "pred_minus_actual")
    abs_y = F.sum(F.abs(F.col(y)))
    return df.groupBy(*group_by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        F.when(abs_y > 0, F.sum(F.abs(e)) / abs_y * 100.0).alias("wmape"),
        F.avg(e).alias("bias"),
    )


# Two named segment rules (T16): Promo == 0 vs Promo != 1 (nulls go in).
SEGMENT_RULES = {
    "strict": lambda p: F.col(p) == 0,
    "not_promo": lambda p: F.col(p).isNull() | (F.col(p) != 1),
}


def segment_metrics(df: DataFrame, y: str = "Sales", yhat: str = "prediction", promo: str = "Promo",
                    group_by: Sequence[str] = (), non_promo_rule: str = "not_promo") -> DataFrame:
    """AGG-04: all / promo / non_promo comparison metrics in long form.

    Each row is tagged with its segments by an ``explode`` of a literal
    array (no self-union, one scan) and one ``groupBy`` computes all.
    """
    seg = F.filter(F.array(
        F.lit("all"),
        F.when(F.col(promo) == 1, F.lit("promo")),
        F.when(SEGMENT_RULES[non_promo_rule](promo), F.lit("non_promo")),
    ), lambda s: s.isNotNull())
    tagged = df.withColumn("segment", F.explode(seg))
    return comparison_metrics(tagged, y, yhat, [*group_by, "segment"])


def promotion_metrics(df: DataFrame, y: str = "Sales", yhat: str = "prediction", promo: str = "Promo",
                      group_by: Sequence[str] = ()) -> DataFrame:
    """AGG-05: overall / promo / non-promo RMSE, overall bias = mean(pred - actual)
    and rows per segment in one pass. A null or non-0/1 Promo, or an empty
    segment, makes the row ``status = 'invalid'`` with a reason."""
    e = error(y, yhat, "pred_minus_actual")
    p = F.col(promo)
    is_p, is_np = p == 1, p == 0
    res = df.groupBy(*group_by).agg(
        F.sqrt(F.avg(e * e)).alias("overall_rmse"),
        F.sqrt(F.avg(F.when(is_p, e * e))).alias("promo_rmse"),
        F.sqrt(F.avg(F.when(is_np, e * e))).alias("non_promo_rmse"),
        F.avg(e).alias("overall_bias"),
        F.count(F.lit(1)).alias("validation_rows"),
        F.count_if(is_p).alias("promo_rows"),
        F.count_if(is_np).alias("non_promo_rows"),
        F.count_if(p.isNull() | ~p.isin(0, 1)).alias("invalid_promo_rows"),
    )
    reason = (F.when(F.col("invalid_promo_rows") > 0, F.lit("missing or invalid promo values"))
              .when(F.col("promo_rows") == 0, F.lit("empty promo segment"))
              .when(F.col("non_promo_rows") == 0, F.lit("empty non_promo segment")))
    return res.withColumn("status", F.when(reason.isNull(), F.lit("ok")).otherwise(F.lit("invalid"))) \
              .withColumn("reason", reason)


def daily_diagnostics(df: DataFrame, fold_col: str = "fold", time: str = "Date", y: str = "Sales",
                      yhat: str = "prediction") -> DataFrame:
    """AGG-06: per fold and date: rows, means, sums, five metrics, store counts."""
    from panelcast.functions.scalar import is_state_holiday
    e = error(y, yhat)
    ycol, pcol = F.col(y).cast("double"), F.col(yhat).cast("double")
    cols = [
        F.count(F.lit(1)).alias("rows"),
        F.avg(ycol).alias("actual_mean"), F.avg(pcol).alias("prediction_mean"),
        F.sum(ycol).alias("actual_sum"), F.sum(pcol).alias("prediction_sum"),
        *_metric_exprs(e, ycol, extended=True)[:3], *_metric_exprs(e, ycol, extended=True)[4:],
    ]
    names = set(df.columns)
    if "Open" in names:
        cols += [F.count_if(F.col("Open") == 1).alias("open_stores"),
                 F.count_if(F.col("Open") == 0).alias("closed_stores")]
    if "Promo" in names:
        cols.append(F.count_if(F.col("Promo") == 1).alias("promo_stores"))
    if "SchoolHoliday" in names:
        cols.append(F.count_if(F.col("SchoolHoliday") == 1).alias("school_holiday_stores"))
    if "StateHoliday" in names:
        cols.append(F.count_if(is_state_holiday("StateHoliday")).alias("state_holiday_stores"))
    return df.groupBy(fold_col, F.col(time).cast("date").alias("date")).agg(*cols)


def fold_summary(fold_metrics: DataFrame, metrics: Sequence[str] = ("rmse", "mae", "wmape", "rmspe", "bias"),
                 fold_col: str = "fold") -> DataFrame:
    """AGG-07: per metric mean, population std, min, max in long form."""
    long = fold_metrics.unpivot([fold_col], list(metrics), "metric", "value")
    return long.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))


def relative_change(candidate: Column, baseline: Column, percent: bool = True) -> Column:
    """AGG-08 / DEC-01: (candidate - baseline) / baseline; NULL when baseline is 0."""
    ch = F.try_divide(candidate - baseline, baseline)
    return ch * 100.0 if percent else ch


def rolling_metrics(df: DataFrame, time: str = "Date", y: str = "Sales", yhat: str = "prediction",
                    days: int = 7, min_samples: int = 1, group_by: Sequence[str] = ()) -> DataFrame:
    """WIN-09: for every distinct day T, metrics over (T - days, T].

    Daily partial sums first (one aggregate; a hot day is combined map-side),
    then a RANGE frame over the distinct days: the window sees one row per
    day, never the fact rows, and there is no row self-join. Without group
    keys the window is global, which is bounded by the number of days.
    """
    clean = clean_pairs(df, y, yhat).withColumn("_d", F.col(time).cast("date"))
    e = error(y, yhat)
    daily = clean.groupBy(*group_by, "_d").agg(
        F.sum(e * e).alias("_s2"), F.sum(F.abs(e)).alias("_sa"), F.sum(e).alias("_s1"),
        F.count(F.lit(1)).alias("_n"))
    w = (Window.partitionBy(*group_by) if group_by else Window.partitionBy()).orderBy(
        F.unix_date("_d")).rangeBetween(-(days - 1), 0)
    rolled = daily.select(
        *group_by,
        F.date_sub("_d", days).alias("window_start"),
        F.col("_d").alias("window_end"),
        F.sum("_s2").over(w).alias("_s2"), F.sum("_sa").over(w).alias("_sa"),
        F.sum("_s1").over(w).alias("_s1"), F.sum("_n").over(w).alias("n_samples"))
    return rolled.filter(F.col("n_samples") >= min_samples).select(
        *group_by, "window_start", "window_end",
        F.sqrt(F.col("_s2") / F.col("n_samples")).alias("rmse"),
        (F.col("_sa") / F.col("n_samples")).alias("mae"),
        (F.col("_s1") / F.col("n_samples")).alias("bias"),
        "n_samples")


def latest_window(df: DataFrame, time: str = "Date", y: str = "Sales", yhat: str = "prediction",
                  days: int = 7, group_by: Sequence[str] = ()) -> DataFrame:
    """WIN-10: metrics for the window ending at max(date) only (scalar filter)."""
    clean = clean_pairs(df, y, yhat).withColumn("_d", F.col(time).cast("date"))
    # max(date) as a scalar subquery: one small job, then a pushed-down filter.
    last = clean.agg(F.max("_d")).scalar()
    sel = clean.filter((F.col("_d") > F.date_sub(last, days)) & (F.col("_d") <= last))
    e = error(y, yhat)
    return sel.groupBy(*group_by).agg(F.date_sub(F.max("_d"), days).alias("window_start"),
                                   F.max("_d").alias("window_end"), *_metric_exprs(e))


def filter_open(df: DataFrame, open_col: str = "Open", y: str = "Sales", yhat: str = "prediction") -> DataFrame:
    """PRJ-14: open stores with a non-null actual and prediction."""
    return df.filter((F.col(open_col) == 1) & F.col(y).isNotNull() & F.col(yhat).isNotNull())


def metrics_upsert(history: DataFrame, new_rows: DataFrame, key: str = "window_end") -> DataFrame:
    """WIN-11: append, keep the last row per ``key`` (new rows win over old
    ones; within a side the later ``_order`` wins when present)."""
    from panelcast.operators.dedup import union_keep_last
    return union_keep_last([history, new_rows], [key]).orderBy(key)


def retrain_signal(history: DataFrame, run_col: str | None = None, day_col: str = "day",
                   min_points: int = 14, min_samples_latest: int = 1500, consecutive_bad_points: int = 3,
                   rmse_baseline: float = 1300.0, mae_baseline: float = 900.0, bias_limit: float = 900.0,
                   rmse_rel_increase: float = 0.30, mae_rel_increase: float = 0.25,
                   rmse_step_threshold: float = 250.0, bias_step_threshold: float = 200.0) -> DataFrame:
    """WIN-12 (without cooldown): the trend-based retrain test evaluated for
    every day at once with ROWS frames over the metric history of a run.

    bad = (rmse > base*(1+r) and mae > base*(1+m)) or |bias| > limit;
    trigger = history >= min_points, latest n_samples >= floor, the last k
    points all bad, and mean(last 3) - mean(previous 3) above a step for
    rmse or |bias|. The window is per run over days (bounded by days).
    """
    keys = [run_col] if run_col else []
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(day_col)
    rmse_limit = rmse_baseline * (1.0 + rmse_rel_increase)
    mae_limit = mae_baseline * (1.0 + mae_rel_increase)
    bad = ((F.col("rmse") > rmse_limit) & (F.col("mae") > mae_limit)) | (F.abs(F.col("bias")) > bias_limit)
    h = history.withColumn("is_bad", bad)
    k = consecutive_bad_points
    last3 = w.rowsBetween(-2, 0)
    prev3 = w.rowsBetween(-5, -3)
    h = h.withColumns({
        "points": F.row_number().over(w),
        "bad_run": F.min(F.col("is_bad").cast("int")).over(w.rowsBetween(-(k - 1), 0)) == 1,
        "rmse_step": F.avg("rmse").over(last3) - F.avg("rmse").over(prev3),
        "bias_step": F.avg(F.abs(F.col("bias"))).over(last3) - F.avg(F.abs(F.col("bias"))).over(prev3),
    })
    enough = (F.col("points") >= min_points) & (F.coalesce(F.col("n_samples"), F.lit(0)) >= min_samples_latest)
    steps = (F.col("rmse_step") > rmse_step_threshold) | (F.col("bias_step") > bias_step_threshold)
    return h.withColumn("should_retrain", enough & F.col("bad_run") & F.col("points").__ge__(6) & steps)


def apply_cooldown(signals: DataFrame, run_col: str, day_col: str = "day", cooldown_days: int = 14) -> DataFrame:
    """WIN-12 cooldown: a retrain blocks further retrains for ``cooldown_days``.

    Each retrain depends on the previous accepted one (a sequential scan),
    so it runs per run with ``applyInPandas``; a group holds one row per day
    of one run (bounded by days, never by fact rows).
    """
    from pyspark.sql import types as T
    schema = T.StructType([*signals.schema.fields, T.StructField("retrain", T.BooleanType())])

    def scan(pdf):
        pdf = pdf.sort_values(day_col)
        last = None
        out = []
        for d, s in zip(pdf[day_col].tolist(), pdf["should_retrain"].tolist()):
            ok = bool(s) and (last is None or d - last >= cooldown_days)
            if ok:
                last = d
            out.append(ok)
        return pdf.assign(retrain=out)
    return signals.groupBy(run_col).applyInPandas(scan, schema)


def post_promotion_mean(lifecycle: DataFrame, run_col: str = "run", day_col: str = "day",
                        metric: str = "rmse", window: int = 7) -> DataFrame:
    """AGG-09: promotion day = first promoted retrain day (else the first
    retrain day) of the adaptive runs; mean rolling metric per run from
    promotion day + window onward. The day is a scalar subquery."""
    retr = lifecycle.filter(F.col("event") == "retrain")
    promoted = retr.filter(F.coalesce(F.col("champion_promoted"), F.lit(False)))
    first = F.coalesce(promoted.agg(F.min(day_col)).scalar(), retr.agg(F.min(day_col)).scalar())
    post = lifecycle.filter(F.col(day_col) >= first + window)
    return post.groupBy(run_col).agg(F.avg(metric).alias(f"post_promotion_mean_{metric}"),
                                     F.count(F.lit(1)).alias("days"))


def run_summary(lifecycle: DataFrame, run_col: str = "run", day_col: str = "day") -> DataFrame:
    """AGG-27: per run: scenario, last non-null retraining flag, days, retrain
    and promotion counts, latest metrics (``max_by`` on the day)."""
    last_flag = F.max_by(F.col("retraining_enabled"), F.when(F.col("retraining_enabled").isNotNull(), F.col(day_col)))
    return lifecycle.groupBy(run_col).agg(
        F.first("scenario", ignorenulls=True).alias("scenario"),
        last_flag.alias("retraining_enabled"),
        F.count_distinct(day_col).alias("days"),
        F.count_if(F.col("event") == "retrain").alias("retrain_count"),
        F.count_if(F.coalesce(F.col("champion_promoted"), F.lit(False))).alias("promoted_count"),
        F.max_by("rmse", day_col).alias("latest_rmse"),
        F.max_by("mae", day_col).alias("latest_mae"),
        F.max_by("bias", day_col).alias("latest_bias"))
