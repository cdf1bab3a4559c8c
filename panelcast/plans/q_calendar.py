"""Catalogue: calendar, run-length and as-of features, feature pipeline."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelcast.functions.scalar import calendar_parts, competition_age, is_one, promo2_age
from panelcast.operators.calendar import (add_known_calendar, build_known_calendar, distance_to_next,
                                          distance_to_previous, merge_calendar, run_boundaries)
from panelcast.operators.features import add_promo_features, build_features
from panelcast.operators.joins import join_dimension
from panelcast.operators.splits import holdout_split
from panelcast.plans.registry import Inputs, query, rounded
from panelcast.plans.sql import with_ctes
from panelcast.schema import CALENDAR_FEATURE_COLUMNS, Roles
from panelcast.sources.adapters import raw_sales_rows

R = Roles()

RAW_ROWS_SQL = """
SELECT 'gt_' || CAST(l_suppkey + 1 AS VARCHAR) || '_' || strftime(CAST(l_shipdate AS DATE), '%Y%m%d') AS file,
       CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS line,
       CAST(l_suppkey + 1 AS BIGINT) AS Store, CAST(l_shipdate AS DATE) AS Date,
       l_extendedprice AS Sales, CAST(l_quantity AS BIGINT) AS Customers,
       CASE WHEN l_linestatus = 'O' OR l_returnflag <> 'R' THEN 1 ELSE 0 END AS Open,
       CASE WHEN l_discount >= 0.1 THEN 2 WHEN l_discount >= 0.06 THEN 1 ELSE 0 END AS Promo,
       CASE WHEN EXTRACT(month FROM l_shipdate) = 1  AND EXTRACT(day FROM l_shipdate) = 1         THEN 'a'
            WHEN EXTRACT(month FROM l_shipdate) = 4  AND EXTRACT(day FROM l_shipdate) IN (10, 11) THEN 'b'
            WHEN EXTRACT(month FROM l_shipdate) = 12 AND EXTRACT(day FROM l_shipdate) IN (25, 26) THEN 'c'
            ELSE '0' END AS StateHoliday,
       CASE WHEN EXTRACT(month FROM l_shipdate) = 7 + (l_suppkey + 1) % 2 THEN 1 ELSE 0 END AS SchoolHoliday,
       CAST(isodow(CAST(l_shipdate AS DATE)) AS INT) AS DayOfWeek
FROM lineitem
"""


def _cal_sql(src: str) -> str:
    """SQL of the ten calendar columns over ``src`` (one row per key)."""
    nxt = "(PARTITION BY Store ORDER BY Date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    prv = "(PARTITION BY Store ORDER BY Date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

    def dist(expr: str) -> str:
        return f"CAST(LEAST(GREATEST(COALESCE({expr}, 31), 0), 31) AS INT)"
    return f"""
SELECT Store, Date,
  {dist(f"MIN(CASE WHEN sh THEN Date END) OVER {nxt} - Date")} AS days_until_state_holiday,
  {dist(f"Date - MAX(CASE WHEN sh THEN Date END) OVER {prv}")} AS days_since_state_holiday,
  {dist(f"MIN(CASE WHEN ss THEN Date END) OVER {nxt} - Date")} AS days_until_school_holiday_start,
  {dist(f"Date - MAX(CASE WHEN ss THEN Date END) OVER {prv}")} AS days_since_school_holiday_start,
  {dist(f"MIN(CASE WHEN se THEN Date END) OVER {nxt} - Date")} AS days_until_school_holiday_end,
  {dist(f"Date - MAX(CASE WHEN se THEN Date END) OVER {prv}")} AS days_since_school_holiday_end,
  CAST(ss AS INT) AS is_school_holiday_start, CAST(se AS INT) AS is_school_holiday_end
FROM (
  SELECT Store, Date, sh, sc AND NOT COALESCE(LAG(sc) OVER w, false) AS ss,
         sc AND NOT COALESCE(LEAD(sc) OVER w, false) AS se
  FROM (SELECT Store, Date,
               lower(trim(COALESCE(CAST(StateHoliday AS VARCHAR), 'nan'))) NOT IN ('0', '0.0', '', 'nan', 'none') AS sh,
               CAST(TRUNC(COALESCE(TRY_CAST(CAST(SchoolHoliday AS VARCHAR) AS DOUBLE), 0)) AS BIGINT) = 1 AS sc
        FROM {src}) s
  WINDOW w AS (PARTITION BY Store ORDER BY Date)
) e"""


def _cal_full_sql(src: str) -> str:
    return f"""SELECT *, CAST(days_until_state_holiday = 1 AS INT) AS is_day_before_state_holiday,
       CAST(days_since_state_holiday = 1 AS INT) AS is_day_after_state_holiday FROM ({_cal_sql(src)}) c"""


CAL_COLS = ", ".join(f"c.{c}" for c in CALENDAR_FEATURE_COLUMNS)


@query("win_05_holiday_run_boundaries", with_ctes("""
SELECT Store, Date, SchoolHoliday, sc AND NOT COALESCE(LAG(sc) OVER w, false) AS school_start,
       sc AND NOT COALESCE(LEAD(sc) OVER w, false) AS school_end
FROM (SELECT *, SchoolHoliday = 1 AS sc FROM sales_panel) s WINDOW w AS (PARTITION BY Store ORDER BY Date)
""", "sales_panel"))
def win_05_holiday_run_boundaries(spark, sf_dir):
    p = Inputs(spark, sf_dir).panel().select("Store", "Date", "SchoolHoliday")
    w = Window.partitionBy("Store").orderBy("Date")
    start, end = run_boundaries(is_one("SchoolHoliday"), w)
    return p.withColumns({"school_start": start, "school_end": end})


@query("jon_09_asof_next_event", with_ctes("""
SELECT Store, Date, CAST(LEAST(GREATEST(COALESCE(MIN(CASE WHEN Promo = 1 THEN Date END) OVER
   (PARTITION BY Store ORDER BY Date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - Date, 31), 0), 31) AS INT)
   AS days_until_promo
FROM sales_panel""", "sales_panel"))
def jon_09_asof_next_event(spark, sf_dir):
    """As-of distance to the next promo day (>= today) per store, clipped at 31."""
    p = Inputs(spark, sf_dir).panel()
    w = Window.partitionBy("Store").orderBy(F.col("Date").desc())
    return p.select("Store", "Date", distance_to_next(F.col("Promo") == 1, F.col("Date"), w, 30)
                    .alias("days_until_promo"))


@query("jon_10_asof_previous_event", with_ctes("""
SELECT Store, Date, CAST(LEAST(GREATEST(COALESCE(Date - MAX(CASE WHEN Promo = 1 THEN Date END) OVER
   (PARTITION BY Store ORDER BY Date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 31), 0), 31) AS INT)
   AS days_since_promo
FROM sales_panel""", "sales_panel"))
def jon_10_asof_previous_event(spark, sf_dir):
    p = Inputs(spark, sf_dir).panel()
    w = Window.partitionBy("Store").orderBy("Date")
    return p.select("Store", "Date", distance_to_previous(F.col("Promo") == 1, F.col("Date"), w, 30)
                    .alias("days_since_promo"))


@query("win_06_known_calendar", with_ctes(_cal_full_sql("sales_panel"), "sales_panel"))
def win_06_known_calendar(spark, sf_dir):
    return build_known_calendar(Inputs(spark, sf_dir).panel(), R, 30)


@query("jon_03_calendar_join_strict", with_ctes(f"""
SELECT p.Store, p.Date, p.Sales, {CAL_COLS} FROM sales_panel p LEFT JOIN cal c ON p.Store = c.Store AND p.Date = c.Date
""", "sales_panel", extra={"cal": _cal_full_sql("sales_panel")}))
def jon_03_calendar_join_strict(spark, sf_dir):
    p = Inputs(spark, sf_dir).panel()
    cal = build_known_calendar(p, R, 30)
    return merge_calendar(p.select("Store", "Date", "Sales"), cal, R, strict=True)


_HOLDOUT_TRAIN = "SELECT * FROM sales_panel WHERE Date <= (SELECT MAX(Date) FROM sales_panel) - 14"


@query("jon_04_calendar_join_lenient", with_ctes(f"""
SELECT p.Store, p.Date, p.Sales,
  {", ".join(f"COALESCE(c.{c}, {0 if c.startswith('is_') else 31}) AS {c}" for c in CALENDAR_FEATURE_COLUMNS)}
FROM sales_panel p LEFT JOIN cal c ON p.Store = c.Store AND p.Date = c.Date
""", "sales_panel", extra={"hist": _HOLDOUT_TRAIN, "cal": _cal_full_sql("hist")}))
def jon_04_calendar_join_lenient(spark, sf_dir):
    """Calendar known for the training period only; holdout rows are unmatched
    and get distance 31 / flag 0."""
    p = Inputs(spark, sf_dir).panel()
    train, _val = holdout_split(p, R, days=14)
    cal = build_known_calendar(train, R, 30)
    return merge_calendar(p.select("Store", "Date", "Sales"), cal, R, strict=False)


@query("jon_05_keyed_calendar_lookup", with_ctes(f"""
SELECT p.Store, p.Date, p.Sales, {CAL_COLS} FROM sales_panel p LEFT JOIN cal c ON p.Store = c.Store AND p.Date = c.Date
""", "sales_panel", extra={
    "raw": RAW_ROWS_SQL,
    "dedup": "SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY Store, Date ORDER BY line DESC) AS rk FROM raw) WHERE rk = 1",
    "cal": _cal_full_sql("dedup")}))
def jon_05_keyed_calendar_lookup(spark, sf_dir):
    """Calendar from raw rows (duplicate keys, keep-last by line), then a
    keyed lookup join onto the panel."""
    i = Inputs(spark, sf_dir)
    cal = build_known_calendar(raw_sales_rows(i.t.lineitem), R, 30, order_col="line")
    return merge_calendar(i.panel().select("Store", "Date", "Sales"), cal, R, strict=False, check_unique=False)


_FEAT_BASE = """
SELECT p.*, d.StoreType, d.Assortment, d.CompetitionDistance, d.CompetitionOpenSinceMonth,
       d.CompetitionOpenSinceYear, d.Promo2, d.Promo2SinceWeek, d.Promo2SinceYear, d.PromoInterval
FROM sales_panel p LEFT JOIN store_dim d ON p.Store = d.Store"""


@query("fun_02_competition_age", with_ctes("""
SELECT Store, Date, CAST(CASE WHEN 12 * (year(Date) - CompetitionOpenSinceYear) + (month(Date) - CompetitionOpenSinceMonth) > 0
  THEN 12 * (year(Date) - CompetitionOpenSinceYear) + (month(Date) - CompetitionOpenSinceMonth) ELSE 0 END AS DOUBLE) AS CompetitionOpen
FROM base""", "sales_panel", "store_dim", extra={"base": _FEAT_BASE}))
def fun_02_competition_age(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    f = calendar_parts(join_dimension(i.panel(), i.store(), "Store"), "Date")
    return f.select("Store", "Date", competition_age().alias("CompetitionOpen"))


@query("fun_03_promo2_age", with_ctes("""
SELECT Store, Date, ROUND(CASE WHEN 12 * (year(Date) - Promo2SinceYear) + (week(Date) - Promo2SinceWeek) / 4.0 < 0 THEN 0.0
  ELSE 12 * (year(Date) - Promo2SinceYear) + (week(Date) - Promo2SinceWeek) / 4.0 END, 4) AS PromoOpen
FROM base""", "sales_panel", "store_dim", extra={"base": _FEAT_BASE}))
def fun_03_promo2_age(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    f = calendar_parts(join_dimension(i.panel(), i.store(), "Store"), "Date")
    return rounded(f.select("Store", "Date", promo2_age().alias("PromoOpen")))


_PROMO_RUNS = """
SELECT Store, Date, Promo, promo_change, promo_group,
       CAST(ROW_NUMBER() OVER (PARTITION BY Store, promo_group ORDER BY Date) - 1 AS BIGINT) AS days_since_promo_start
FROM (SELECT *, CAST(SUM(CAST(promo_change AS BIGINT)) OVER (PARTITION BY Store ORDER BY Date
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS promo_group
      FROM (SELECT Store, Date, Promo,
                   (LAG(Promo) OVER w IS NULL OR LAG(Promo) OVER w <> Promo) AS promo_change
            FROM sales_panel WINDOW w AS (PARTITION BY Store ORDER BY Date)) a) b"""


@query("win_04_promo_run_islands", with_ctes(_PROMO_RUNS, "sales_panel"))
def win_04_promo_run_islands(spark, sf_dir):
    p = Inputs(spark, sf_dir).panel().select("Store", "Date", "Promo")
    return add_promo_features(p, R).drop("PromoOpen")


# The complete feature plan (PRJ-13): sort, temporal, lags, competition,
# promo, cast categoricals, technical drops.
_FEATURE_PLAN_SQL = with_ctes(f"""
SELECT b.Store, b.Date, b.Sales, b.Customers, b.Open, b.Promo, b.StateHoliday, b.SchoolHoliday,
       b.StoreType, b.Assortment, b.CompetitionDistance, b.Promo2,
       COALESCE(b.PromoInterval, 'nan') AS PromoInterval,
       CAST(isodow(b.Date) AS INT) AS DayOfWeek, CAST(week(b.Date) AS INT) AS WeekOfYear,
       CAST(day(b.Date) AS INT) AS day, CAST(month(b.Date) AS INT) AS month, CAST(year(b.Date) AS INT) AS year,
       CAST(day(b.Date) = 1 AS INT) AS is_month_start, CAST(b.Date = last_day(b.Date) AS INT) AS is_month_end,
       CAST(day(b.Date) AS INT) AS day_of_month,
       COALESCE(LAG(b.Sales, 1) OVER w, 0) AS sales_lag_1, COALESCE(LAG(b.Sales, 7) OVER w, 0) AS sales_lag_7,
       COALESCE(LAG(b.Sales, 14) OVER w, 0) AS sales_lag_14, COALESCE(LAG(b.Sales, 28) OVER w, 0) AS sales_lag_28,
       ROUND(CASE WHEN COUNT(b.Sales) OVER w7 = 7 THEN AVG(b.Sales) OVER w7 ELSE 0 END, 4) AS sales_rolling_mean_7,
       ROUND(CASE WHEN COUNT(b.Sales) OVER w14 = 14 THEN AVG(b.Sales) OVER w14 ELSE 0 END, 4) AS sales_rolling_mean_14,
       ROUND(CASE WHEN COUNT(b.Sales) OVER w28 = 28 THEN AVG(b.Sales) OVER w28 ELSE 0 END, 4) AS sales_rolling_mean_28,
       CAST(CASE WHEN 12 * (year(b.Date) - b.CompetitionOpenSinceYear) + (month(b.Date) - b.CompetitionOpenSinceMonth) > 0
         THEN 12 * (year(b.Date) - b.CompetitionOpenSinceYear) + (month(b.Date) - b.CompetitionOpenSinceMonth) ELSE 0 END AS DOUBLE) AS CompetitionOpen,
       ROUND(CASE WHEN 12 * (year(b.Date) - b.Promo2SinceYear) + (week(b.Date) - b.Promo2SinceWeek) / 4.0 < 0 THEN 0.0
         ELSE 12 * (year(b.Date) - b.Promo2SinceYear) + (week(b.Date) - b.Promo2SinceWeek) / 4.0 END, 4) AS PromoOpen,
       r.promo_change, r.promo_group, r.days_since_promo_start
FROM base b JOIN runs r ON b.Store = r.Store AND b.Date = r.Date
WINDOW w AS (PARTITION BY b.Store ORDER BY b.Date),
       w7 AS (PARTITION BY b.Store ORDER BY b.Date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
       w14 AS (PARTITION BY b.Store ORDER BY b.Date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING),
       w28 AS (PARTITION BY b.Store ORDER BY b.Date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)
""", "sales_panel", "store_dim", extra={"base": _FEAT_BASE, "runs": _PROMO_RUNS})


@query("prj_13_feature_pipeline", _FEATURE_PLAN_SQL)
def prj_13_feature_pipeline(spark, sf_dir):
    """The whole config-driven feature plan in train mode: one lazy plan with
    a single exchange by entity for all windows."""
    i = Inputs(spark, sf_dir)
    joined = join_dimension(i.panel(), i.store(), "Store")
    return rounded(build_features(joined, R))


@query("prj_08_drop_if_present", with_ctes("""
SELECT Store, Date, Sales, StoreType, Assortment, CompetitionDistance, Promo2, PromoInterval FROM (""" + _FEAT_BASE + ") b",
                                           "sales_panel", "store_dim"))
def prj_08_drop_if_present(spark, sf_dir):
    """Technical drops + names that do not exist (ignored)."""
    from panelcast.operators.features import drop_if_present
    from panelcast.schema import TECHNICAL_DROP_COLUMNS
    i = Inputs(spark, sf_dir)
    j = join_dimension(i.panel(), i.store(), "Store")
    return drop_if_present(j, [*TECHNICAL_DROP_COLUMNS, "not_a_column", "Customers", "Open", "Promo",
                               "StateHoliday", "SchoolHoliday"])


_MODEL_FEATURES = ["Store", "DayOfWeek", "Promo", "StateHoliday", "SchoolHoliday", "StoreType", "Assortment",
                   "CompetitionDistance", "Promo2", "WeekOfYear", "month", "year", "sales_lag_1", "sales_lag_7",
                   "sales_rolling_mean_7", "CompetitionOpen", "PromoOpen", "days_since_promo_start"]


@query("prj_09_drop_list_builder", "SELECT * FROM (" + _FEATURE_PLAN_SQL.replace(
    "SELECT b.Store, b.Date, b.Sales, b.Customers,", "SELECT b.Store,", 1) + ") x")
def prj_09_drop_list_builder(spark, sf_dir):
    """Configured drops + known targets + target + time, de-duplicated."""
    from panelcast.operators.features import build_drop_columns, drop_if_present
    i = Inputs(spark, sf_dir)
    feats = build_features(join_dimension(i.panel(), i.store(), "Store"), R)
    return rounded(drop_if_present(feats, build_drop_columns(["Sales"], R)))


@query("prj_10_feature_alignment", "SELECT " + ", ".join(_MODEL_FEATURES) + " FROM (" + _FEATURE_PLAN_SQL + ") x")
def prj_10_feature_alignment(spark, sf_dir):
    from panelcast.operators.ml import align_features
    i = Inputs(spark, sf_dir)
    feats = build_features(join_dimension(i.panel(), i.store(), "Store"), R)
    return rounded(align_features(feats, _MODEL_FEATURES))


@query("prj_11_column_alias_resolve", with_ctes(
    "SELECT Store, Date AS date, prediction AS y_pred, Sales FROM naive_predictions", "naive_predictions"))
def prj_11_column_alias_resolve(spark, sf_dir):
    from panelcast.operators.ml import resolve_columns
    p = Inputs(spark, sf_dir).predictions().select("Store", "Date", "prediction", "Sales")
    return resolve_columns(p, {"date": ["date", "Date"], "y_pred": ["y_pred", "prediction", "Prediction"]})


@query("prj_14_open_store_filter", with_ctes(
    "SELECT Store, Date, Sales, prediction FROM naive_predictions WHERE Open = 1 AND Sales IS NOT NULL AND prediction IS NOT NULL",
    "naive_predictions"))
def prj_14_open_store_filter(spark, sf_dir):
    from panelcast.operators.metrics import filter_open
    p = Inputs(spark, sf_dir).predictions()
    return filter_open(p).select("Store", "Date", "Sales", "prediction")


@query("win_03_inference_placeholders", with_ctes("""
SELECT Store, Date, Promo, 0.0 AS sales_lag_1, 0.0 AS sales_lag_7, 0.0 AS sales_lag_14, 0.0 AS sales_lag_28,
       0.0 AS sales_rolling_mean_7, 0.0 AS sales_rolling_mean_14, 0.0 AS sales_rolling_mean_28
FROM sales_panel""", "sales_panel"))
def win_03_inference_placeholders(spark, sf_dir):
    """Inference mode: the target is absent, so lag / rolling columns are 0.0."""
    from panelcast.operators.features import init_placeholders
    p = Inputs(spark, sf_dir).panel().select("Store", "Date", "Promo")
    return init_placeholders(p, R)


@query("prj_12_categorical_cast", with_ctes("""
SELECT Store, StoreType, Assortment, COALESCE(PromoInterval, 'nan') AS PromoInterval FROM store_dim""", "store_dim"))
def prj_12_categorical_cast(spark, sf_dir):
    from panelcast.operators.features import cast_categoricals
    return cast_categoricals(Inputs(spark, sf_dir).store().select("Store", "StoreType", "Assortment", "PromoInterval"))
