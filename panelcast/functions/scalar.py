"""Scalar column functions (JVM-side expressions, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that mean "no state holiday".
NO_HOLIDAY_TEXTS = ("0", "0.0", "", "nan", "none")
# Texts parsed as true / false.
TRUE_TEXTS = ("true", "1")


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_name(name: str) -> str:
    """FUN-13: strip, lower, spaces to underscores (plan-time)."""
    return name.strip().lower().replace(" ", "_")


def lag_feature_names(target: str, lags, windows) -> dict[str, str]:
    prefix = normalize_name(target)
    names = {f"lag_{k}": f"{prefix}_lag_{k}" for k in lags}
    names.update({f"rolling_mean_{w}": f"{prefix}_rolling_mean_{w}" for w in windows})
    return names


def calendar_parts(df: DataFrame, time: str = "Date") -> DataFrame:
    """FUN-01: DayOfWeek (Mon=1), ISO week, day, month, year, month start/end."""
    if time not in df.columns:
        return df
    d = F.col(time).cast("date")
    return df.withColumns({
        "DayOfWeek": (F.weekday(d) + 1).cast("int"),
        "WeekOfYear": F.weekofyear(d).cast("int"),
        "day": F.dayofmonth(d).cast("int"),
        "month": F.month(d).cast("int"),
        "year": F.year(d).cast("int"),
        "is_month_start": (F.dayofmonth(d) == 1).cast("int"),
        "is_month_end": (d == F.last_day(d)).cast("int"),
        "day_of_month": F.dayofmonth(d).cast("int"),
    })


def competition_age(year: str | Column = "year", month: str | Column = "month",
                    since_year: str | Column = "CompetitionOpenSinceYear",
                    since_month: str | Column = "CompetitionOpenSinceMonth") -> Column:
    """FUN-02: months since the competitor opened; <=0 or null -> 0."""
    raw = 12 * (_c(year) - _c(since_year)) + (_c(month) - _c(since_month))
    return F.when(raw > 0, raw).otherwise(F.lit(0)).cast("double")


def promo2_age(year: str | Column = "year", week: str | Column = "WeekOfYear",
               since_year: str | Column = "Promo2SinceYear",
               since_week: str | Column = "Promo2SinceWeek") -> Column:
    """FUN-03: 12*years + weeks/4 (mixed units kept as specified); floored at 0,
    null stays null (``greatest`` would skip the null, so ``when`` is used)."""
    raw = 12 * (_c(year) - _c(since_year)) + (_c(week) - _c(since_week)) / 4.0
    return F.when(raw < 0, F.lit(0.0)).otherwise(raw.cast("double"))


def is_state_holiday(c: str | Column) -> Column:
    """FUN-04: lower/trim text is not one of the no-holiday texts (null -> 'nan')."""
    text = F.lower(F.trim(F.coalesce(_c(c).cast("string"), F.lit("nan"))))
    return ~text.isin(*NO_HOLIDAY_TEXTS)


def is_one(c: str | Column) -> Column:
    """FUN-05: numeric coercion, null -> 0, truncated to int, equals 1."""
    num = F.coalesce(_c(c).cast("string").try_cast("double"), F.lit(0.0))
    return num.cast("long") == 1


def parse_bool(c: str | Column) -> Column:
    """FUN-06: 'true'/'1' (any case) -> true, anything else -> false."""
    return F.coalesce(F.lower(F.trim(_c(c).cast("string"))).isin(*TRUE_TEXTS), F.lit(False))


def target_transform(c: str | Column, kind: str | None) -> Column:
    """FUN-07 forward: none or log1p."""
    if kind in (None, "none"):
        return _c(c)
    if kind == "log1p":
        return F.log1p(_c(c))
    raise ValueError(f"Unsupported target transform: {kind}")


def inverse_target_transform(c: str | Column, kind: str | None) -> Column:
    """FUN-07 inverse: none or expm1."""
    if kind in (None, "none"):
        return _c(c)
    if kind == "log1p":
        return F.expm1(_c(c))
    raise ValueError(f"Unsupported target transform: {kind}")


def business_rule(pred: str | Column, open_col: str | Column | None = "Open", decimals: int = 2) -> Column:
    """FUN-08: closed -> 0.0 else max(0, pred); rounded half-even to 2 dp."""
    p = _c(pred).cast("double")
    if open_col is not None:
        p = F.when(_c(open_col) == 0, F.lit(0.0)).otherwise(F.greatest(p, F.lit(0.0)))
    return F.bround(p, decimals)


def content_batch_id(content: str | Column) -> Column:
    """FUN-10: 'gt-' + first 20 hex chars of SHA-256 of the file bytes."""
    return F.concat(F.lit("gt-"), F.substring(F.sha2(_c(content), 256), 1, 20))


def fingerprint_agg(id_col: str | Column) -> Column:
    """FUN-11 (aggregate): 'batch-' + 16 hex of SHA-256 of sorted distinct ids joined by '|'."""
    joined = F.array_join(F.array_sort(F.collect_set(_c(id_col).cast("string"))), "|")
    return F.concat(F.lit("batch-"), F.substring(F.sha2(joined, 256), 1, 16))


def format_value(c: str | Column, decimals: int = 2) -> Column:
    """FUN-14: 'n/a' for null, else fixed decimals."""
    v = _c(c).cast("double")
    return F.when(v.isNull(), F.lit("n/a")).otherwise(F.format_string(f"%.{decimals}f", v))


def title_name(c: str | Column) -> Column:
    """FUN-14: scenario names such as 'promo_decay' -> 'Promo Decay'."""
    return F.initcap(F.regexp_replace(_c(c), "[_-]", " "))


def config_hash(config: dict) -> str:
    """FUN-12 (plan-time): SHA-256 hex of the key-sorted JSON of a config
    with the default spaced separators."""
    import hashlib
    import json
    return hashlib.sha256(json.dumps(config, sort_keys=True).encode("utf-8")).hexdigest()


def integral_key(df, col: str) -> Column:
    """An entity key as a long; values that are none become NULL. Integral columns stay
    as they are, and texts are read as integers first: only what is no integer text
    goes through double (which cannot hold every long)."""
    if df.schema[col].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint"):
        return F.col(col).cast("long")
    text = F.col(col).cast("string")
    return F.coalesce(text.try_cast("long"), text.try_cast("double").try_cast("long"))
