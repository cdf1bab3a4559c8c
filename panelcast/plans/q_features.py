"""Catalogue: sources, feature plan, calendar, joins of the feature plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions.scalar import calendar_parts
from panelcast.operators.features import add_lag_features, add_lags, add_rolling_means
from panelcast.operators.metrics import regression_metrics, rolling_metrics
from panelcast.plans.registry import Inputs, query, rounded
from panelcast.plans.sql import with_ctes
from panelcast.schema import Roles

R = Roles()


@query("src_03_parquet_scan", with_ctes("SELECT * FROM sales_panel", "sales_panel"))
def src_03_parquet_scan(spark, sf_dir):
    """Parquet scan of lineitem adapted to the sales panel (column-pruned scan)."""
    return Inputs(spark, sf_dir).panel()


@query("jon_01_fact_dim_join", with_ctes("""
SELECT p.Store, p.Date, p.Sales, d.StoreType, d.Assortment, d.CompetitionDistance, d.Promo2
FROM sales_panel p LEFT JOIN store_dim d ON p.Store = d.Store""", "sales_panel", "store_dim"))
def jon_01_fact_dim_join(spark, sf_dir):
    """Fact x dimension left join; the dimension is broadcast (one row per store)."""
    i = Inputs(spark, sf_dir)
    from panelcast.operators.joins import join_dimension
    out = join_dimension(i.panel(), i.store(), R.entity)
    return out.select("Store", "Date", "Sales", "StoreType", "Assortment", "CompetitionDistance", "Promo2")


@query("fun_01_calendar_parts", with_ctes("""
SELECT Store, Date, CAST(isodow(Date) AS INT) AS DayOfWeek, CAST(week(Date) AS INT) AS WeekOfYear,
       CAST(day(Date) AS INT) AS day, CAST(month(Date) AS INT) AS month, CAST(year(Date) AS INT) AS year,
       CAST(day(Date) = 1 AS INT) AS is_month_start, CAST(Date = last_day(Date) AS INT) AS is_month_end,
       CAST(day(Date) AS INT) AS day_of_month
FROM sales_panel""", "sales_panel"))
def fun_01_calendar_parts(spark, sf_dir):
    p = Inputs(spark, sf_dir).panel().select("Store", "Date")
    return calendar_parts(p, "Date")


@query("win_01_grouped_lags", with_ctes("""
SELECT Store, Date, Sales,
  COALESCE(LAG(Sales, 1) OVER w, 0) AS sales_lag_1, COALESCE(LAG(Sales, 7) OVER w, 0) AS sales_lag_7,
  COALESCE(LAG(Sales, 14) OVER w, 0) AS sales_lag_14, COALESCE(LAG(Sales, 28) OVER w, 0) AS sales_lag_28
FROM sales_panel WINDOW w AS (PARTITION BY Store ORDER BY Date)""", "sales_panel"))
def win_01_grouped_lags(spark, sf_dir):
    p = Inputs(spark, sf_dir).panel().select("Store", "Date", "Sales")
    return add_lags(p, R)


def _rolling_sql(n: int) -> str:
    frame = f"(PARTITION BY Store ORDER BY Date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return (f"ROUND(CASE WHEN COUNT(Sales) OVER {frame} = {n} THEN AVG(Sales) OVER {frame} ELSE 0 END, 4)"
            f" AS sales_rolling_mean_{n}")


@query("win_02_shifted_rolling_mean", with_ctes(f"""
SELECT Store, Date, Sales, {_rolling_sql(7)}, {_rolling_sql(14)}, {_rolling_sql(28)}
FROM sales_panel""", "sales_panel"))
def win_02_shifted_rolling_mean(spark, sf_dir):
    p = Inputs(spark, sf_dir).panel().select("Store", "Date", "Sales")
    return rounded(add_rolling_means(p, R))


@query("win_09_rolling_metrics", with_ctes("""
SELECT window_start, window_end, ROUND(SQRT(s2 / n), 4) AS rmse, ROUND(sa / n, 4) AS mae,
       ROUND(s1 / n, 4) AS bias, n AS n_samples
FROM (
  SELECT CAST(d - 7 AS DATE) AS window_start, d AS window_end,
         SUM(s2) OVER w AS s2, SUM(sa) OVER w AS sa, SUM(s1) OVER w AS s1, SUM(n) OVER w AS n
  FROM (SELECT Date AS d, SUM((Sales - prediction) * (Sales - prediction)) AS s2,
               SUM(ABS(Sales - prediction)) AS sa, SUM(Sales - prediction) AS s1, COUNT(*) AS n
        FROM naive_predictions WHERE Sales IS NOT NULL AND prediction IS NOT NULL GROUP BY Date) daily
  WINDOW w AS (ORDER BY d RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)
) r WHERE n >= 1""", "naive_predictions"))
def win_09_rolling_metrics(spark, sf_dir):
    """Rolling 7-day RMSE/MAE/bias of the naive forecast, one row per date."""
    return rounded(rolling_metrics(Inputs(spark, sf_dir).predictions(), days=7, min_samples=1))


@query("agg_01_regression_metrics", with_ctes("""
SELECT ROUND(SQRT(AVG((Sales - prediction) * (Sales - prediction))), 4) AS rmse,
       ROUND(AVG(ABS(Sales - prediction)), 4) AS mae, ROUND(AVG(Sales - prediction), 4) AS bias,
       COUNT(*) AS n_samples
FROM naive_predictions WHERE Sales IS NOT NULL AND prediction IS NOT NULL""", "naive_predictions"))
def agg_01_regression_metrics(spark, sf_dir):
    return rounded(regression_metrics(Inputs(spark, sf_dir).predictions()))


def flagship(spark, sf_dir):
    """Minimum slice: panel -> validate -> store join -> calendar parts ->
    lags / rolling -> rolling 7-day RMSE of ``sales_rolling_mean_7`` as a
    naive forecast, per date."""
    from panelcast.operators.joins import join_dimension
    from panelcast.operators.validate import split_valid, TRAIN_RULES
    i = Inputs(spark, sf_dir)
    good, _bad = split_valid(i.panel(), TRAIN_RULES)
    feats = add_lag_features(calendar_parts(join_dimension(good, i.store(), R.entity), R.time), R)
    scored = feats.filter(F.col("sales_rolling_mean_7") > 0)
    return rounded(rolling_metrics(scored, y="Sales", yhat="sales_rolling_mean_7", days=7, min_samples=1))
