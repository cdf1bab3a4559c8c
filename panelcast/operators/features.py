"""Per-entity feature operators (lags, rolling means, run lengths).

Every window here uses ``partitionBy(entity).orderBy(time)`` so that
Catalyst plans a single hash exchange by entity for the whole feature
plan. After the panel aggregate there is at most one row per (entity, day),
so one entity partition is bounded by the number of days, even when an
entity holds a large share of all raw rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.scalar import (calendar_parts, competition_age, lag_feature_names,
                                        promo2_age)
from panelcast.schema import LAGS, ROLLING_WINDOWS, TECHNICAL_DROP_COLUMNS, Roles


def entity_window(roles: Roles) -> Window:
    return Window.partitionBy(roles.entity).orderBy(roles.time)


def add_lags(df: DataFrame, roles: Roles = Roles(), lags: Sequence[int] = LAGS) -> DataFrame:
    """WIN-01: target shifted k ROWS (not days) per entity; null -> 0."""
    if roles.target not in df.columns:
        return df
    names = lag_feature_names(roles.target, lags, [])
    w = entity_window(roles)
    return df.withColumns({
        names[f"lag_{k}"]: F.coalesce(F.lag(roles.target, k).over(w).cast("double"), F.lit(0.0))
        for k in lags
    })


def add_rolling_means(df: DataFrame, roles: Roles = Roles(),
                      windows: Sequence[int] = ROLLING_WINDOWS) -> DataFrame:
    """WIN-02: mean of the previous w rows when all w exist and are non-null, else 0."""
    if roles.target not in df.columns:
        return df
    names = lag_feature_names(roles.target, [], windows)
    w = entity_window(roles)
    out = {}
    for n in windows:
        frame = w.rowsBetween(-n, -1)
        out[names[f"rolling_mean_{n}"]] = F.when(
            F.count(roles.target).over(frame) == n, F.avg(roles.target).over(frame)
        ).otherwise(F.lit(0.0))
    return df.withColumns(out)


def add_lag_features(df: DataFrame, roles: Roles = Roles(), lags: Sequence[int] = LAGS,
                     windows: Sequence[int] = ROLLING_WINDOWS) -> DataFrame:
    """WIN-01 + WIN-02 in one projection (one window spec, one exchange)."""
    return add_rolling_means(add_lags(df, roles, lags), roles, windows)


def init_placeholders(df: DataFrame, roles: Roles = Roles(), lags: Sequence[int] = LAGS,
                      windows: Sequence[int] = ROLLING_WINDOWS) -> DataFrame:
    """WIN-03: lag / rolling columns set to 0.0 where absent (inference mode)."""
    names = lag_feature_names(roles.target, lags, windows)
    return df.withColumns({n: F.lit(0.0) for n in names.values() if n not in df.columns})


def add_competition_features(df: DataFrame) -> DataFrame:
    """FUN-02 applied: ``CompetitionOpen`` when its source columns exist."""
    need = {"CompetitionOpenSinceYear", "CompetitionOpenSinceMonth", "year", "month"}
    if not need.issubset(df.columns):
        return df
    return df.withColumn("CompetitionOpen", competition_age())


def add_promo_features(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """FUN-03 + WIN-04: ``PromoOpen`` and promo run-length islands.

    change = promo differs from the previous row of the entity (the first row
    counts as a change); the running sum of changes is the run id and the
    position inside the run is ``days_since_promo_start``. Every run counts,
    also Promo=0 runs, and the helper columns stay (as in the reference).
    """
    need = {"Promo2SinceYear", "Promo2SinceWeek", "year", "WeekOfYear"}
    if need.issubset(df.columns):
        df = df.withColumn("PromoOpen", promo2_age())
    elif "PromoOpen" not in df.columns:
        df = df.withColumn("PromoOpen", F.lit(0))
    if not {roles.entity, roles.time, roles.promo}.issubset(df.columns):
        if "days_since_promo_start" not in df.columns:
            df = df.withColumn("days_since_promo_start", F.lit(0))
        return df
    w = entity_window(roles)
    prev = F.lag(roles.promo, 1).over(w)
    df = df.withColumn("promo_change", prev.isNull() | (F.col(roles.promo) != prev)
                       | (F.col(roles.promo).isNull() & prev.isNotNull()))
    df = df.withColumn("promo_group", F.sum(F.col("promo_change").cast("long")).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    # Position in the run: rows since the run's first row, on the same window
    # spec (no second exchange): row_number - row_number at the run start.
    rn = F.row_number().over(w)
    df = df.withColumn("_rn", rn)
    start = F.max(F.when(F.col("promo_change"), F.col("_rn"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("days_since_promo_start", (F.col("_rn") - start).cast("long")).drop("_rn")


def drop_if_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PRJ-08: drop columns; absent names are ignored."""
    present = [c for c in columns if c in df.columns]
    return df.drop(*present) if present else df


def build_drop_columns(configured: Sequence[str], roles: Roles = Roles()) -> list[str]:
    """PRJ-09: configured drops + known targets + target + time, de-duplicated in order."""
    out: list[str] = []
    for c in [*configured, *roles.known_targets, roles.target, roles.time]:
        if c not in out:
            out.append(c)
    return out


def cast_categoricals(df: DataFrame) -> DataFrame:
    """PRJ-12: string columns stay string with null -> 'nan' (the pandas
    ``astype(str)`` rule); indexing happens inside the ML pipeline."""
    strings = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit("nan")) for c in strings}) if strings else df


def sort_frame(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """SRT-01: order by entity, time when both exist (only for output)."""
    if roles.entity in df.columns and roles.time in df.columns:
        return df.orderBy(roles.entity, roles.time)
    return df


STEP_ORDER = ("sort", "temporal", "lags", "competition", "promo", "cast_categoricals",
              "drop_technical", "drop_configured")


def build_features(df: DataFrame, roles: Roles = Roles(), steps: Sequence[str] = STEP_ORDER,
                   mode: str = "auto", lags: Sequence[int] = LAGS,
                   windows: Sequence[int] = ROLLING_WINDOWS,
                   technical_drops: Sequence[str] = TECHNICAL_DROP_COLUMNS,
                   configured_drops: Sequence[str] = (), sort_output: bool = False) -> DataFrame:
    """PRJ-13: ordered, config-driven feature steps folded into one lazy plan.

    mode auto -> train when the target column is present, else inference
    (placeholders 0.0). An unknown step is an error. ``sort`` only orders
    the output when ``sort_output`` is set: windows carry their own order.
    """
    if mode == "auto":
        mode = "train" if roles.target in df.columns else "inference"
    if mode not in ("train", "inference"):
        raise ValueError(f"Unknown feature mode: {mode}")

    def lag_step(d: DataFrame) -> DataFrame:
        if mode == "train":
            return add_lag_features(d, roles, lags, windows)
        return init_placeholders(d, roles, lags, windows)

    table: dict[str, Callable[[DataFrame], DataFrame]] = {
        "sort": lambda d: sort_frame(d, roles) if sort_output else d,
        "temporal": lambda d: calendar_parts(d, roles.time),
        "lags": lag_step,
        "competition": add_competition_features,
        "promo": lambda d: add_promo_features(d, roles),
        "cast_categoricals": cast_categoricals,
        "drop_technical": lambda d: drop_if_present(d, technical_drops),
        "drop_configured": lambda d: drop_if_present(d, configured_drops),
    }
    for step in steps:
        if step not in table:
            raise ValueError(f"Unknown feature step: {step}")
        df = df.transform(table[step])
    return df
