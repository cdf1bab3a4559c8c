"""Column roles and the declared schemas of the data model."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Roles:
    """Column roles; every operator takes them as arguments (no globals)."""

    entity: str = "Store"
    time: str = "Date"
    target: str = "Sales"
    known_targets: tuple[str, ...] = ("Sales", "Customers")
    promo: str = "Promo"

    @property
    def keys(self) -> list[str]:
        return [self.entity, self.time]


DEFAULT_ROLES = Roles()

# Fixed values from the reference configuration (training / monitoring settings).
LAGS = (1, 7, 14, 28)
ROLLING_WINDOWS = (7, 14, 28)
STATE_LENGTH = 28
TECHNICAL_DROP_COLUMNS = (
    "CompetitionOpenSinceMonth",
    "CompetitionOpenSinceYear",
    "Promo2SinceWeek",
    "Promo2SinceYear",
)
CALENDAR_FEATURE_COLUMNS = (
    "days_until_state_holiday",
    "days_since_state_holiday",
    "is_day_before_state_holiday",
    "is_day_after_state_holiday",
    "days_until_school_holiday_start",
    "days_since_school_holiday_start",
    "days_until_school_holiday_end",
    "days_since_school_holiday_end",
    "is_school_holiday_start",
    "is_school_holiday_end",
)

SALES_SCHEMA = T.StructType([
    T.StructField("Store", T.LongType()),
    T.StructField("DayOfWeek", T.IntegerType()),
    T.StructField("Date", T.DateType()),
    T.StructField("Sales", T.DoubleType()),
    T.StructField("Customers", T.LongType()),
    T.StructField("Open", T.IntegerType()),
    T.StructField("Promo", T.IntegerType()),
    T.StructField("StateHoliday", T.StringType()),
    T.StructField("SchoolHoliday", T.IntegerType()),
])

STORE_SCHEMA = T.StructType([
    T.StructField("Store", T.LongType()),
    T.StructField("StoreType", T.StringType()),
    T.StructField("Assortment", T.StringType()),
    T.StructField("CompetitionDistance", T.DoubleType()),
    T.StructField("CompetitionOpenSinceMonth", T.LongType()),
    T.StructField("CompetitionOpenSinceYear", T.LongType()),
    T.StructField("Promo2", T.IntegerType()),
    T.StructField("Promo2SinceWeek", T.LongType()),
    T.StructField("Promo2SinceYear", T.LongType()),
    T.StructField("PromoInterval", T.StringType()),
])

STATE_SCHEMA = T.StructType([
    T.StructField("entity", T.LongType()),
    T.StructField("history", T.ArrayType(T.DoubleType())),
])

DRIFT_HISTORY_SCHEMA = T.StructType([
    T.StructField("feature", T.StringType()),
    T.StructField("feature_type", T.StringType()),
    T.StructField("metric_type", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("p_value", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("drift_detected", T.BooleanType()),
    T.StructField("reference_n", T.LongType()),
    T.StructField("current_n", T.LongType()),
    T.StructField("reason", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])

PERFORMANCE_HISTORY_SCHEMA = T.StructType([
    T.StructField("rmse", T.DoubleType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("bias", T.DoubleType()),
    T.StructField("n_samples", T.LongType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
])
