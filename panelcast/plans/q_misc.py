"""Catalogue: validation, coercion, scalar functions, sort / de-dup / set
operators, scenario uplift and user-function surface."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelcast.functions import scalar as S
from panelcast.operators import dedup as Dd
from panelcast.operators import validate as V
from panelcast.operators.metrics import rolling_metrics
from panelcast.operators.scenario import apply_scenario, sample_requests
from panelcast.operators.splits import holdout_split
from panelcast.plans.q_calendar import RAW_ROWS_SQL
from panelcast.plans.registry import Inputs, query, rounded
from panelcast.plans.sql import with_ctes
from panelcast.schema import Roles
from panelcast.sources.adapters import raw_sales_rows

R = Roles()


@query("prj_01_coercing_casts", """
SELECT o_orderkey, TRY_CAST(o_orderpriority AS INT) AS priority_as_int,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS INT) AS priority_rank,
       CAST(o_orderdate AS DATE) AS order_date, TRY_CAST(o_orderstatus AS DOUBLE) AS status_as_double
FROM orders""")
def prj_01_coercing_casts(spark, sf_dir):
    """Bad values become NULL (``try_cast``), good ones are converted."""
    o = Inputs(spark, sf_dir).t.orders.select(
        "o_orderkey", F.col("o_orderpriority").alias("priority_as_int"),
        F.substring("o_orderpriority", 1, 1).alias("priority_rank"),
        F.col("o_orderdate").cast("string").alias("order_date"), F.col("o_orderstatus").alias("status_as_double"))
    return V.coerce(o, {"priority_as_int": "int", "priority_rank": "int", "order_date": "date",
                        "status_as_double": "double"})


@query("prj_02_strict_casts")
def prj_02_strict_casts(spark, sf_dir):
    """Strict casts (ANSI): valid input converts; one bad value fails the job."""
    o = Inputs(spark, sf_dir).t.orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("rank"))
    return V.strict_cast(o, {"rank": "int"})


def _violation_sql(src: str, rules: list[tuple[str, str]]) -> str:
    parts = [f"SELECT '{name}' AS rule, (SELECT COUNT(*) FROM {src}) AS rows_checked, "
             f"COUNT(*) FILTER (WHERE NOT COALESCE({cond}, false)) AS failures FROM {src}" for name, cond in rules]
    return " UNION ALL ".join(parts)


_TRAIN_RULES_SQL = [
    ("Store>0", "Store IS NOT NULL AND (Store > 0)"),
    ("Date", "Date IS NOT NULL"),
    ("Sales>=0", "Sales IS NULL OR Sales >= 0"),
    ("Customers>=0", "Customers IS NULL OR Customers >= 0"),
    ("Open in {0,1}", "Open IS NOT NULL AND Open IN (0, 1)"),
    ("Promo in {0,1}", "Promo IS NOT NULL AND Promo IN (0, 1)"),
    ("StateHoliday in {0,a,b,c}", "StateHoliday IS NOT NULL AND StateHoliday IN ('0', 'a', 'b', 'c')"),
    ("SchoolHoliday in {0,1}", "SchoolHoliday IS NOT NULL AND SchoolHoliday IN (0, 1)"),
    ("DayOfWeek in 1..7", "DayOfWeek IS NULL OR DayOfWeek BETWEEN 1 AND 7"),
]


@query("prj_03_training_row_validation", with_ctes(_violation_sql("raw", _TRAIN_RULES_SQL), extra={"raw": RAW_ROWS_SQL}))
def prj_03_training_row_validation(spark, sf_dir):
    """Rule failures over all raw rows (one aggregate for all rules)."""
    return V.violation_summary(raw_sales_rows(Inputs(spark, sf_dir).t.lineitem), V.TRAIN_RULES)


@query("prj_04_dimension_validation", with_ctes(_violation_sql("store_dim", [
    ("Store>0", "Store IS NOT NULL AND Store > 0"),
    ("StoreType in a..d", "StoreType IS NOT NULL AND StoreType IN ('a', 'b', 'c', 'd')"),
    ("Assortment in a..c", "Assortment IS NOT NULL AND Assortment IN ('a', 'b', 'c')"),
    ("CompetitionDistance>=0", "CompetitionDistance IS NULL OR CompetitionDistance >= 0")]), "store_dim"))
def prj_04_dimension_validation(spark, sf_dir):
    return V.violation_summary(Inputs(spark, sf_dir).store(), V.STORE_RULES)


@query("prj_05_scoring_input_validation", with_ctes("""
SELECT Store, Date, list_filter([CASE WHEN NOT COALESCE(Promo IS NULL OR Promo IN (0, 1), false) THEN 'Promo in {0,1}' END],
                                lambda x: x IS NOT NULL) AS violations
FROM raw""", extra={"raw": RAW_ROWS_SQL}))
def prj_05_scoring_input_validation(spark, sf_dir):
    """Scoring payloads (raw rows without the target) checked row by row."""
    raw = raw_sales_rows(Inputs(spark, sf_dir).t.lineitem).select("Store", "Date", "Open", "Promo", "StateHoliday",
                                                                  "SchoolHoliday")
    return V.validate_inference(raw).select("Store", "Date", "violations")


@query("prj_06_batch_quarantine", with_ctes("""
SELECT file, COUNT(*) AS rows, COUNT(*) FILTER (WHERE Promo NOT IN (0, 1)) AS bad_rows,
       COUNT(*) FILTER (WHERE Promo NOT IN (0, 1)) = 0 AS accepted
FROM raw GROUP BY file""", extra={"raw": RAW_ROWS_SQL}))
def prj_06_batch_quarantine(spark, sf_dir):
    """Per-file verdicts: a file with any bad row is quarantined whole."""
    _acc, _quar, verdict = V.route_batches(raw_sales_rows(Inputs(spark, sf_dir).t.lineitem), V.TRAIN_RULES)
    return verdict


@query("prj_06_accepted_rows", with_ctes("""
SELECT file, line, Store, Date, Promo FROM raw WHERE file NOT IN (SELECT file FROM raw WHERE Promo NOT IN (0, 1))""",
                                         extra={"raw": RAW_ROWS_SQL}))
def prj_06_accepted_rows(spark, sf_dir):
    acc, _quar, _ = V.route_batches(raw_sales_rows(Inputs(spark, sf_dir).t.lineitem), V.TRAIN_RULES)
    return acc.select("file", "line", "Store", "Date", "Promo")


@query("prj_07_null_key_drop", with_ctes(
    "SELECT Store, CompetitionDistance FROM store_dim WHERE Store IS NOT NULL AND CompetitionDistance IS NOT NULL "
    "AND NOT isnan(CompetitionDistance)", "store_dim"))
def prj_07_null_key_drop(spark, sf_dir):
    from panelcast.operators.metrics import clean_pairs
    return clean_pairs(Inputs(spark, sf_dir).store().select("Store", "CompetitionDistance"), "Store", "CompetitionDistance")


@query("prj_15_request_sample")
def prj_15_request_sample(spark, sf_dir):
    """1000 requests chosen by a seeded hash order (deterministic top-k)."""
    p = Inputs(spark, sf_dir).panel()
    return sample_requests(p, ["Store", "DayOfWeek", "Date", "Customers", "Open", "Promo", "StateHoliday",
                               "SchoolHoliday", "Sales"], n=1000, seed=42)


@query("prj_16_scenario_uplift", with_ctes("""
SELECT Store, Date, day, ROUND(progress, 4) AS progress, ROUND(1.0 + 0.1 * progress, 4) AS base_multiplier,
       ROUND(1.0 + 0.35 * progress, 4) AS promo_multiplier,
       CAST(round_even(Sales * CASE WHEN Promo = 1 THEN 1.0 + 0.35 * progress ELSE 1.0 + 0.1 * progress END, 0) AS BIGINT) AS Sales
FROM (SELECT *, CASE WHEN day < 46 THEN 0.0 ELSE LEAST((day - 46 + 1) / 14.0, 1.0) END AS progress
      FROM (SELECT *, DENSE_RANK() OVER (ORDER BY Date) AS day FROM va) d) x""", "sales_panel", extra={
    "va": "SELECT Store, Date, Sales, Promo FROM sales_panel WHERE Date > (SELECT MAX(Date) FROM sales_panel) - 90"}))
def prj_16_scenario_uplift(spark, sf_dir):
    """Gradual promo shift over the last 90 days (day index = date rank)."""
    p = Inputs(spark, sf_dir).panel().select("Store", "Date", "Sales", "Promo")
    _, va = holdout_split(p, R, 90)
    days = va.select("Date").distinct().withColumn("day", F.dense_rank().over(Window.orderBy("Date")))
    v = va.join(days, "Date")
    out = apply_scenario(v, F.col("day"))
    return rounded(out.select("Store", "Date", "day", "progress", "base_multiplier", "promo_multiplier", "Sales"))


@query("fun_04_state_holiday_flag", with_ctes("""
SELECT Store, Date, StateHoliday, lower(trim(COALESCE(StateHoliday, 'nan'))) NOT IN ('0', '0.0', '', 'nan', 'none') AS is_holiday
FROM sales_panel""", "sales_panel"))
def fun_04_state_holiday_flag(spark, sf_dir):
    p = Inputs(spark, sf_dir).panel()
    return p.select("Store", "Date", "StateHoliday", S.is_state_holiday("StateHoliday").alias("is_holiday"))


@query("fun_05_binary_flag", """
SELECT o_orderkey, CAST(TRUNC(COALESCE(TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE), 0)) AS BIGINT) = 1 AS is_urgent
FROM orders""")
def fun_05_binary_flag(spark, sf_dir):
    o = Inputs(spark, sf_dir).t.orders
    return o.select("o_orderkey", S.is_one(F.substring("o_orderpriority", 1, 1)).alias("is_urgent"))


@query("fun_06_boolean_text_parse", """
SELECT o_orderkey, COALESCE(lower(trim(CASE o_orderstatus WHEN 'O' THEN 'True' WHEN 'F' THEN '0' ELSE 'P' END)) IN ('true', '1'), false) AS is_open
FROM orders""")
def fun_06_boolean_text_parse(spark, sf_dir):
    o = Inputs(spark, sf_dir).t.orders
    txt = F.when(F.col("o_orderstatus") == "O", "True").when(F.col("o_orderstatus") == "F", "0").otherwise("P")
    return o.select("o_orderkey", S.parse_bool(txt).alias("is_open"))


@query("fun_07_target_transform", with_ctes("""
SELECT Store, Date, ROUND(LN(1 + Sales), 4) AS label, ROUND(EXP(LN(1 + Sales)) - 1, 4) AS restored FROM sales_panel""",
                                            "sales_panel"))
def fun_07_target_transform(spark, sf_dir):
    p = Inputs(spark, sf_dir).panel()
    t = p.select("Store", "Date", S.target_transform(F.col("Sales"), "log1p").alias("label"))
    return t.select("Store", "Date", F.round("label", 4).alias("label"),
                    F.round(S.inverse_target_transform(F.col("label"), "log1p"), 4).alias("restored"))


@query("fun_08_business_rule", with_ctes("""
SELECT Store, Date, round_even(CASE WHEN Open = 0 THEN 0.0 ELSE GREATEST(prediction - 1000.0, 0.0) END, 2) AS final_prediction
FROM naive_predictions""", "naive_predictions"))
def fun_08_business_rule(spark, sf_dir):
    """Closed -> 0, negatives clipped, half-even 2 dp (shifted forecasts)."""
    p = Inputs(spark, sf_dir).predictions()
    return p.select("Store", "Date", S.business_rule(F.col("prediction") - 1000.0, "Open").alias("final_prediction"))


@query("fun_10_content_batch_id", """
SELECT doc_id, 'gt-' || substr(sha256(text), 1, 20) AS batch_id FROM documents""")
def fun_10_content_batch_id(spark, sf_dir):
    """Content id of each whole document text."""
    d = Inputs(spark, sf_dir).t.documents
    return d.select("doc_id", S.content_batch_id(F.col("text")).alias("batch_id"))


@query("fun_11_dataset_fingerprint", with_ctes("""
SELECT Store, year(Date) AS year,
       'batch-' || substr(sha256(array_to_string(list_sort(list(DISTINCT file)), '|')), 1, 16) AS fingerprint
FROM raw GROUP BY Store, year(Date)""", extra={"raw": RAW_ROWS_SQL}))
def fun_11_dataset_fingerprint(spark, sf_dir):
    """Fingerprint of the batch ids (store-day files) per store and year:
    the id set of a group is bounded by its days."""
    raw = raw_sales_rows(Inputs(spark, sf_dir).t.lineitem)
    return raw.groupBy("Store", F.year("Date").alias("year")).agg(S.fingerprint_agg("file").alias("fingerprint"))


@query("fun_13_name_normalise", with_ctes("""
SELECT DISTINCT lower(replace(trim(p_type), ' ', '_')) || '_lag_1' AS feature_name FROM part""", extra={}))
def fun_13_name_normalise(spark, sf_dir):
    """Feature prefixes from part types (distinct names, normalised)."""
    p = Inputs(spark, sf_dir).t.part.select("p_type").distinct()
    return p.select(F.concat(F.lower(F.regexp_replace(F.trim("p_type"), " ", "_")), F.lit("_lag_1")).alias("feature_name")) \
        .distinct()


@query("fun_14_value_formatting", with_ctes("""
SELECT Store, COALESCE(printf('%.2f', CompetitionDistance), 'n/a') AS competition_text,
       CASE WHEN PromoInterval IS NULL THEN NULL ELSE 'Gradual Promo Shift' END AS scenario_title
FROM store_dim""", "store_dim"))
def fun_14_value_formatting(spark, sf_dir):
    s = Inputs(spark, sf_dir).store()
    return s.select("Store", S.format_value("CompetitionDistance").alias("competition_text"),
                    F.when(F.col("PromoInterval").isNotNull(), S.title_name(F.lit("gradual_promo_shift")))
                    .alias("scenario_title"))


@query("srt_01_entity_date_sort", with_ctes("SELECT Store, Date, Sales FROM sales_panel ORDER BY Store, Date", "sales_panel"))
def srt_01_entity_date_sort(spark, sf_dir):
    from panelcast.operators.features import sort_frame
    return sort_frame(Inputs(spark, sf_dir).panel().select("Store", "Date", "Sales"), R)


@query("srt_02_keep_last_dedup", with_ctes("""
SELECT Store, Date, line, Sales FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY Store, Date ORDER BY line DESC) AS rk FROM raw) r
WHERE rk = 1""", extra={"raw": RAW_ROWS_SQL}))
def srt_02_keep_last_dedup(spark, sf_dir):
    raw = raw_sales_rows(Inputs(spark, sf_dir).t.lineitem)
    return Dd.dedup_last(raw, ["Store", "Date"], "line").select("Store", "Date", "line", "Sales")


@query("srt_03_probe_row", with_ctes("""
SELECT Store, Date, Customers FROM sales_panel WHERE Open = 1 AND Customers > 0 AND Sales IS NOT NULL AND Promo IS NOT NULL
ORDER BY Date DESC, Store LIMIT 1""", "sales_panel"))
def srt_03_probe_row(spark, sf_dir):
    """Newest complete open row, then the lowest store (top-1 report)."""
    p = Inputs(spark, sf_dir).panel()
    ok = p.filter((F.col("Open") == 1) & (F.col("Customers") > 0)).dropna(subset=["Sales", "Promo"])
    return Dd.top_n(ok, 1, [F.col("Date").desc(), F.col("Store").asc()]).select("Store", "Date", "Customers")


@query("srt_04_tail_n", with_ctes("""
SELECT window_end, n_samples FROM (SELECT d AS window_end, SUM(n) OVER (ORDER BY d RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS n_samples
FROM (SELECT Date AS d, COUNT(*) AS n FROM naive_predictions GROUP BY Date) x) y ORDER BY window_end DESC LIMIT 20""",
                                  "naive_predictions"))
def srt_04_tail_n(spark, sf_dir):
    """Last 20 rows of the rolling-metric history (a tail report)."""
    h = rolling_metrics(Inputs(spark, sf_dir).predictions())
    return Dd.top_n(h, 20, [F.col("window_end").desc()]).select("window_end", "n_samples")


@query("set_01_batch_union", with_ctes("""
SELECT Store, Date, Sales, CAST(NULL AS VARCHAR) AS file FROM sales_panel WHERE Date <= (SELECT MAX(Date) FROM sales_panel) - 14
UNION ALL SELECT Store, Date, Sales, file FROM raw WHERE Date > (SELECT MAX(Date) FROM raw) - 14
  AND file NOT IN (SELECT file FROM raw WHERE Promo NOT IN (0, 1))""", "sales_panel", extra={"raw": RAW_ROWS_SQL}))
def set_01_batch_union(spark, sf_dir):
    """Training base + accepted new batch rows (schemas differ: filled with NULL)."""
    i = Inputs(spark, sf_dir)
    base, _ = holdout_split(i.panel().select("Store", "Date", "Sales"), R, 14)
    raw = raw_sales_rows(i.t.lineitem)
    _, new = holdout_split(raw, R, 14)
    acc, _q, _v = V.route_batches(new, V.TRAIN_RULES)
    return Dd.union_batches(base, acc.select("Store", "Date", "Sales", "file"))


@query("set_02_cumulative_truth_rebuild", with_ctes("""
SELECT Store, Date, Sales FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY Store, Date ORDER BY src DESC, line DESC) AS rk
  FROM (SELECT Store, Date, Sales, 0 AS src, line FROM raw WHERE Store IS NOT NULL AND Date IS NOT NULL AND Promo = 0
        UNION ALL SELECT Store, Date, Sales, 1 AS src, line FROM raw WHERE Store IS NOT NULL AND Date IS NOT NULL AND Promo <> 0) u) x
WHERE rk = 1""", extra={"raw": RAW_ROWS_SQL}))
def set_02_cumulative_truth_rebuild(spark, sf_dir):
    """Two truth deliveries (non-promo lines, then promo lines that correct
    them); keep last per (Store, Date); idempotent."""
    raw = raw_sales_rows(Inputs(spark, sf_dir).t.lineitem).select("Store", "Date", "Sales", "Promo", F.col("line").alias("_line"))
    b1 = raw.filter(F.col("Promo") == 0).drop("Promo")
    b2 = raw.filter(F.col("Promo") != 0).drop("Promo")
    return Dd.union_keep_last([b1, b2], ["Store", "Date"]).select("Store", "Date", "Sales")


@query("set_03_incremental_truth_upsert", with_ctes("""
SELECT Store, Date, Sales FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY Store, Date ORDER BY src DESC) AS rk
  FROM (SELECT Store, Date, Sales, 0 AS src FROM sales_panel WHERE Date <= (SELECT MAX(Date) FROM sales_panel) - 1
        UNION ALL SELECT Store, Date, Sales * 2, 1 FROM sales_panel WHERE Date > (SELECT MAX(Date) FROM sales_panel) - 7) u) x
WHERE rk = 1""", "sales_panel"))
def set_03_incremental_truth_upsert(spark, sf_dir):
    """Existing truth (all but the last day) + the newest batch (last 7 days,
    re-delivered with corrected values): the batch wins."""
    p = Inputs(spark, sf_dir).panel().select("Store", "Date", "Sales")
    existing, _ = holdout_split(p, R, 1)
    _, newest = holdout_split(p, R, 7)
    return Dd.union_keep_last([existing, newest.withColumn("Sales", F.col("Sales") * 2)], ["Store", "Date"])


@query("udf_01_row_lambda", with_ctes("""
SELECT Store, Date, CASE WHEN Sales - 20000 > 0 THEN Sales - 20000 ELSE 0 END AS excess FROM sales_panel""", "sales_panel"))
def udf_01_row_lambda(spark, sf_dir):
    """``x if x > 0 else 0`` as a JVM expression."""
    p = Inputs(spark, sf_dir).panel()
    x = F.col("Sales") - 20000
    return p.select("Store", "Date", F.when(x > 0, x).otherwise(F.lit(0.0)).alias("excess"))


@query("udf_03_group_frame_function", with_ctes("""
SELECT Store, Date, CAST(ROW_NUMBER() OVER (PARTITION BY Store ORDER BY Date) - 1 AS BIGINT) AS position,
       ROUND(SUM(Sales) OVER (PARTITION BY Store ORDER BY Date ROWS UNBOUNDED PRECEDING), 2) AS running_sales
FROM sales_panel""", "sales_panel"))
def udf_03_group_frame_function(spark, sf_dir):
    """Extension point: a user pandas function per entity (``applyInPandas``).
    After the panel aggregate a group is one row per day of one store."""
    def per_store(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("Date")
        return pd.DataFrame({"Store": pdf["Store"], "Date": pdf["Date"],
                             "position": range(len(pdf)), "running_sales": pdf["Sales"].cumsum().round(2)})
    p = Inputs(spark, sf_dir).panel().select("Store", "Date", "Sales")
    return p.groupBy("Store").applyInPandas(per_store, "Store long, Date date, position long, running_sales double")


@query("udf_04_dict_map", with_ctes("""
SELECT Store, CASE StoreType WHEN 'a' THEN 'standard' WHEN 'b' THEN 'extra' WHEN 'c' THEN 'extended' ELSE 'unknown' END AS type_name
FROM store_dim""", "store_dim"))
def udf_04_dict_map(spark, sf_dir):
    """``Series.map(dict)`` as a literal map lookup (unknown -> default)."""
    m = F.create_map(F.lit("a"), F.lit("standard"), F.lit("b"), F.lit("extra"), F.lit("c"), F.lit("extended"))
    s = Inputs(spark, sf_dir).store()
    return s.select("Store", F.coalesce(F.element_at(m, F.col("StoreType")), F.lit("unknown")).alias("type_name"))


@query("jon_02_required_match_join", with_ctes("""
SELECT p.Store, p.Date, d.Promo2, d.StoreType FROM sales_panel p LEFT JOIN store_dim d ON p.Store = d.Store""",
                                               "sales_panel", "store_dim"))
def jon_02_required_match_join(spark, sf_dir):
    """Every panel row must find its store (a miss raises inside the plan)."""
    from panelcast.operators.joins import join_dimension_required
    i = Inputs(spark, sf_dir)
    return join_dimension_required(i.panel().select("Store", "Date"), i.store().select("Store", "Promo2", "StoreType"),
                                   "Store", "Promo2")


@query("fun_12_decision_id", """
SELECT o_orderpriority, 'retrain-' || substr(sha256(to_json({'batch_ids': list_sort(list(DISTINCT o_orderstatus)),
  'dataset_version': 'v-' || o_orderpriority, 'drift_window_end': CAST(NULL AS VARCHAR),
  'feature_drift_persistent': false, 'new_training_rows': COUNT(*), 'performance_degraded': SUM(o_totalprice) > 1e6,
  'performance_window_end': strftime(MAX(o_orderdate), '%Y-%m-%d'), 'scheduled_retraining_due': true})), 1, 16) AS decision_id
FROM orders GROUP BY o_orderpriority""")
def fun_12_decision_id(spark, sf_dir):
    """Stable decision ids from per-priority signal rows (canonical JSON)."""
    from panelcast.operators.decisions import decision_id
    o = Inputs(spark, sf_dir).t.orders
    sig = o.groupBy("o_orderpriority").agg(
        F.array_sort(F.collect_set("o_orderstatus")).alias("batch_ids"),
        F.count(F.lit(1)).alias("new_training_rows"),
        (F.sum("o_totalprice") > 1e6).alias("performance_degraded"),
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("performance_window_end"))
    sig = sig.withColumns({"dataset_version": F.concat(F.lit("v-"), F.col("o_orderpriority")),
                           "drift_window_end": F.lit(None).cast("string"),
                           "feature_drift_persistent": F.lit(False), "scheduled_retraining_due": F.lit(True)})
    return sig.select("o_orderpriority", decision_id().alias("decision_id"))


@query("udf_02_group_transform", with_ctes("""
SELECT Store, Date, ROUND(CASE WHEN COUNT(Sales) OVER w = 7 THEN AVG(Sales) OVER w ELSE 0 END, 4) AS sales_rolling_mean_7
FROM sales_panel WINDOW w AS (PARTITION BY Store ORDER BY Date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""", "sales_panel"))
def udf_02_group_transform(spark, sf_dir):
    """``groupby.transform(lambda x: x.shift(1).rolling(7).mean())`` as a window."""
    from panelcast.operators.features import add_rolling_means
    p = Inputs(spark, sf_dir).panel().select("Store", "Date", "Sales")
    return rounded(add_rolling_means(p, R, [7]).drop("Sales"))


@query("udf_05_collect_list_aggregate", with_ctes("""
SELECT Store, list(Promo ORDER BY Date) AS promo_history FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY Store ORDER BY Date DESC) AS rn FROM sales_panel) t WHERE rn <= 28 GROUP BY Store""",
                                                  "sales_panel"))
def udf_05_collect_list_aggregate(spark, sf_dir):
    """``groupby.apply(list)`` bounded to the last 28 values per entity."""
    from panelcast.operators.state import create_state
    p = Inputs(spark, sf_dir).panel()
    st = create_state(p, Roles(target="Promo"), 28)
    return st.select(F.col("entity").alias("Store"), F.transform("history", lambda x: x.cast("int")).alias("promo_history"))


def _tails_sql() -> str:
    from panelcast.plans.q_drift import _erfc_sql
    h = "(x / 2.0)"
    return f"""
SELECT x, dof, ROUND(CASE WHEN dof % 2 = 0
    THEN (SELECT SUM(EXP(i * LN({h}) - lgamma(i + 1) - {h})) FROM generate_series(0, CAST(dof / 2 - 1 AS BIGINT)) g(i))
    ELSE {_erfc_sql(f'SQRT({h})')} + COALESCE((SELECT SUM(EXP((i - 0.5) * LN({h}) - lgamma(i + 0.5) - {h}))
         FROM generate_series(1, CAST((dof - 1) / 2 AS BIGINT)) g(i)), 0) END, 4) AS p_value
FROM (SELECT CAST(p_size AS DOUBLE) AS x, CAST(1 + p_partkey % 23 AS INT) AS dof FROM part
      UNION ALL SELECT CAST(1400 + p_partkey % 400 AS DOUBLE), CAST(1500 + p_size AS INT) FROM part) t"""


@query("udf_06_statistical_tails", _tails_sql())
def udf_06_statistical_tails(spark, sf_dir):
    """Chi-square upper tails as JVM expressions, odd, even and large degrees of freedom
    (checked against independent lgamma sums)."""
    from panelcast.functions.stats import chi2_sf
    part = Inputs(spark, sf_dir).t.part
    small = part.select(F.col("p_size").cast("double").alias("x"), (1 + F.col("p_partkey") % 23).cast("int").alias("dof"))
    large = part.select((1400 + F.col("p_partkey") % 400).cast("double").alias("x"), (1500 + F.col("p_size")).cast("int").alias("dof"))
    # hundreds of terms a row: spread evenly, as a file of few bytes would be one task's
    both = small.unionByName(large).repartition(8 * spark.sparkContext.defaultParallelism)
    return rounded(both.select("x", "dof", chi2_sf(F.col("x"), F.col("dof")).alias("p_value")))
