"""Adapters that put the forecasting data model on the driver's tables.

The driver ships no store-sales data, so the panel, the store dimension,
naive predictions and a request log are derived from TPC-H-like tables.
Each adapter has a SQL twin in ``panelcast.plans.sql`` and the two agree
row for row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _state_holiday(date: Column) -> Column:
    m, d = F.month(date), F.dayofmonth(date)
    return (F.when((m == 1) & (d == 1), "a")
            .when((m == 4) & d.isin(10, 11), "b")
            .when((m == 12) & d.isin(25, 26), "c")
            .otherwise("0"))


def sales_panel(lineitem: DataFrame) -> DataFrame:
    """One row per (Store, Date): daily revenue of a supplier = store sales.

    Distinct orders are counted in two aggregation levels instead of a
    ``count(distinct)`` (which Spark plans with an Expand that doubles the
    rows): first per (Store, Date, order), then per (Store, Date). Both
    levels aggregate partially before their shuffle, so a hot store-day is
    spread over its orders in level one and combined map-side in level two.
    Money is summed as integer cents (exact, and a long sum stays in
    codegen, unlike a wide DECIMAL sum), so addition order cannot change it.
    """
    per_order = (lineitem
                 .groupBy((F.col("l_suppkey") + 1).cast("bigint").alias("Store"),
                          F.col("l_shipdate").cast("date").alias("Date"), "l_orderkey")
                 .agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("s"),
                      F.max(F.when((F.col("l_linestatus") == "O") | (F.col("l_returnflag") != "R"), 1)
                            .otherwise(0)).alias("o"),
                      F.max(F.when(F.col("l_discount") >= 0.06, 1).otherwise(0)).alias("p")))
    daily = per_order.groupBy("Store", "Date").agg(
        (F.sum("s") / 100.0).alias("Sales"),
        F.count(F.lit(1)).alias("Customers"),
        F.max("o").alias("Open"),
        F.max("p").alias("Promo"))
    return daily.select(
        "Store", "Date", "Sales", "Customers", "Open", "Promo",
        _state_holiday(F.col("Date")).alias("StateHoliday"),
        F.when(F.month("Date") == 7 + F.col("Store") % 2, 1).otherwise(0).alias("SchoolHoliday"),
    )


def store_dim(supplier: DataFrame) -> DataFrame:
    """Store dimension, one row per supplier (small; broadcast at join time)."""
    k = F.col("s_suppkey")
    nk = F.col("s_nationkey")
    odd = k % 2 == 1
    return supplier.select(
        (k + 1).cast("bigint").alias("Store"),
        F.when(nk % 4 == 0, "a").when(nk % 4 == 1, "b").when(nk % 4 == 2, "c").otherwise("d").alias("StoreType"),
        F.when(nk % 3 == 0, "a").when(nk % 3 == 1, "b").otherwise("c").alias("Assortment"),
        F.when(F.col("s_acctbal") < 0, F.lit(None)).otherwise(F.col("s_acctbal")).alias("CompetitionDistance"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(1 + k % 12).alias("CompetitionOpenSinceMonth"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(1993 + k % 8).alias("CompetitionOpenSinceYear"),
        (k % 2).cast("int").alias("Promo2"),
        F.when(odd, 1 + k % 52).alias("Promo2SinceWeek"),
        F.when(odd, 1994 + k % 5).alias("Promo2SinceYear"),
        F.when(odd, F.lit("Jan,Apr,Jul,Oct")).alias("PromoInterval"),
    )


def naive_predictions(panel: DataFrame, entity: str = "Store", time: str = "Date",
                      target: str = "Sales") -> DataFrame:
    """Panel + two naive forecasts: the shifted 7-row mean (``prediction``)
    and the 7-row lag (``sales_lag_7``, the challenger model).

    All windows share one ``partitionBy(entity).orderBy(time)`` spec, so the
    plan has one exchange by entity.
    """
    w = Window.partitionBy(entity).orderBy(time)
    prev7 = w.rowsBetween(-7, -1)
    return panel.select(
        "*",
        F.coalesce(F.lag(target, 1).over(w), F.lit(0.0)).alias("sales_lag_1"),
        F.coalesce(F.lag(target, 7).over(w), F.lit(0.0)).alias("sales_lag_7"),
        F.when(F.count(target).over(prev7) == 7, F.avg(target).over(prev7)).otherwise(F.lit(0.0)).alias("prediction"),
    )


def request_log(events: DataFrame) -> DataFrame:
    """Serving request events derived from ``events`` (ts cast to TIMESTAMP)."""
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit("POST").alias("method"),
        F.when(F.col("user_id") % 10 == 0, "/health").otherwise("/predict").alias("path"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
        (F.col("value") / 100.0).alias("latency_seconds"),
    )


DRIFT_SPLIT_TS = "2024-01-16 00:00:00"


def drift_samples(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reference / current samples for drift: events before / from 2024-01-16."""
    ts = F.col("ts").cast("timestamp")
    cut = F.lit(DRIFT_SPLIT_TS).cast("timestamp")
    return events.filter(ts < cut), events.filter(ts >= cut)


def raw_sales_rows(lineitem: DataFrame) -> DataFrame:
    """Raw batch rows in the training-row schema, one per lineitem.

    ``file`` = one batch per (store, day), ``line`` = source order. Promo is
    coded 0 / 1 / 2 from the discount; 2 is outside the contract, so some
    batches fail validation (quarantine input).
    """
    d = F.col("l_shipdate").cast("date")
    store = (F.col("l_suppkey") + 1).cast("bigint")
    return lineitem.select(
        F.concat(F.lit("gt_"), store.cast("string"), F.lit("_"), F.date_format(d, "yyyyMMdd")).alias("file"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("line"),
        store.alias("Store"), d.alias("Date"),
        F.col("l_extendedprice").alias("Sales"),
        F.col("l_quantity").cast("bigint").alias("Customers"),
        F.when((F.col("l_linestatus") == "O") | (F.col("l_returnflag") != "R"), 1).otherwise(0).alias("Open"),
        F.when(F.col("l_discount") >= 0.1, 2).when(F.col("l_discount") >= 0.06, 1).otherwise(0).alias("Promo"),
        _state_holiday(d).alias("StateHoliday"),
        F.when(F.month(d) == 7 + store % 2, 1).otherwise(0).alias("SchoolHoliday"),
        (F.weekday(d) + 1).cast("int").alias("DayOfWeek"),
    )
