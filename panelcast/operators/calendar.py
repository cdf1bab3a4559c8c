"""Known-calendar features: holiday run edges and as-of day distances.

The reference loops over entities and binary-searches event dates; here the
"next event on or after today" and "last event on or before today" are
running ``min``/``max`` windows on the per-entity spec: one sort per entity,
linear, no loop and no range join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.scalar import integral_key, is_one, is_state_holiday
from panelcast.operators.dedup import dedup_last
from panelcast.schema import CALENDAR_FEATURE_COLUMNS, Roles

# The lenient join fills unmatched rows with this distance.
UNMATCHED_DISTANCE = 31


def run_boundaries(flag: Column, w: Window) -> tuple[Column, Column]:
    """WIN-05: start = on and previous row off; end = on and next row off.
    Edges count as off; adjacency is by row, not by day."""
    prev = F.lag(flag, 1, False).over(w)
    nxt = F.lead(flag, 1, False).over(w)
    return flag & ~prev, flag & ~nxt


def distance_to_next(event: Column, date: Column, w_desc: Window, maximum: int) -> Column:
    """JON-09: days to the next event date >= date; none -> max+1; clipped to [0, max+1].

    ``w_desc`` orders the entity by time DESCENDING: the next event is a
    running min from the end (a frame ending at the current row is
    incremental; a frame running to the partition end would be recomputed
    for every row, which is quadratic)."""
    nxt = F.min(F.when(event, date)).over(w_desc.rowsBetween(Window.unboundedPreceding, 0))
    return _clip(F.datediff(nxt, date), maximum)


def distance_to_previous(event: Column, date: Column, w: Window, maximum: int) -> Column:
    """JON-10: days since the last event date <= date; none -> max+1; clipped."""
    prv = F.max(F.when(event, date)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return _clip(F.datediff(date, prv), maximum)


def _clip(days: Column, maximum: int) -> Column:
    missing = maximum + 1
    return F.least(F.greatest(F.coalesce(days, F.lit(missing)), F.lit(0)), F.lit(missing)).cast("int")


def add_known_calendar(df: DataFrame, roles: Roles = Roles(), maximum_distance: int = 30,
                       state_col: str = "StateHoliday", school_col: str = "SchoolHoliday") -> DataFrame:
    """WIN-06 columns added in place on the per-entity window spec.

    Uses only entity, time and the two holiday columns (never the target).
    Expects one row per (entity, time); see ``build_known_calendar``.
    """
    w = Window.partitionBy(roles.entity).orderBy(roles.time)
    wd = Window.partitionBy(roles.entity).orderBy(F.col(roles.time).desc())
    date = F.col(roles.time).cast("date")
    state = is_state_holiday(state_col)
    school = is_one(school_col)
    start, end = run_boundaries(school, w)
    df = df.withColumns({"_sh": state, "_ss": start, "_se": end})
    sh, ss, se = F.col("_sh"), F.col("_ss"), F.col("_se")
    df = df.withColumns({
        "days_until_state_holiday": distance_to_next(sh, date, wd, maximum_distance),
        "days_since_state_holiday": distance_to_previous(sh, date, w, maximum_distance),
        "days_until_school_holiday_start": distance_to_next(ss, date, wd, maximum_distance),
        "days_since_school_holiday_start": distance_to_previous(ss, date, w, maximum_distance),
        "days_until_school_holiday_end": distance_to_next(se, date, wd, maximum_distance),
        "days_since_school_holiday_end": distance_to_previous(se, date, w, maximum_distance),
        "is_school_holiday_start": ss.cast("int"),
        "is_school_holiday_end": se.cast("int"),
    })
    df = df.withColumns({
        "is_day_before_state_holiday": (F.col("days_until_state_holiday") == 1).cast("int"),
        "is_day_after_state_holiday": (F.col("days_since_state_holiday") == 1).cast("int"),
    })
    return df.drop("_sh", "_ss", "_se")


def build_known_calendar(source: DataFrame, roles: Roles = Roles(), maximum_distance: int = 30,
                         order_col: str | None = None) -> DataFrame:
    """WIN-06: the ten calendar columns per (entity, time).

    Keys are coerced (bad values dropped), duplicate keys keep the last row
    by ``order_col`` (explicit source order), then the columns are computed.
    """
    cols = [roles.entity, roles.time, "StateHoliday", "SchoolHoliday"]
    missing = [c for c in cols if c not in source.columns]
    if missing:
        raise ValueError(f"Calendar source is missing columns: {missing}")
    # integral keys are used as they are (keeps an existing partitioning by the entity)
    entity = integral_key(source, roles.entity)
    src = source.select(
        entity.alias(roles.entity),
        F.col(roles.time).cast("date").alias(roles.time),
        "StateHoliday", "SchoolHoliday",
        *([order_col] if order_col else []),
    ).dropna(subset=[roles.entity, roles.time])
    if order_col:
        src = dedup_last(src, [roles.entity, roles.time], order_col).drop(order_col)
    cal = add_known_calendar(src, roles, maximum_distance)
    return cal.select(roles.entity, roles.time, *CALENDAR_FEATURE_COLUMNS)


def assert_unique(df: DataFrame, entity: str, time: str, message: str = "Duplicate key ") -> DataFrame:
    """The same rows; a second row of an (entity, time) fails the job that reads them.

    A row whose predecessor in its entity has the same time is a duplicate: the window has
    the entity's usual partitioning and order, so a table that was built by such windows is
    neither shuffled nor sorted again. No job runs while the plan is built. Rows without a
    key are never duplicates (they join with nothing)."""
    before = F.lag(time).over(Window.partitionBy(entity).orderBy(time))
    repeated = F.col(entity).isNotNull() & F.col("_before").eqNullSafe(F.col(time)) & F.col(time).isNotNull()
    check = F.when(~repeated, F.lit(True)).otherwise(F.raise_error(F.concat(
        F.lit(message), F.col(entity).cast("string"), F.lit(" "), F.col(time).cast("string"))).cast("boolean"))
    return df.withColumn("_before", before).filter(check).drop("_before")


def merge_calendar(df: DataFrame, calendar: DataFrame, roles: Roles = Roles(), strict: bool = True,
                   check_unique: bool = True) -> DataFrame:
    """JON-03 / JON-04: many-to-one left join of features onto (entity, time).

    A duplicate calendar key raises at execution, matched or not; with strict any unmatched
    row does too (``raise_error`` inside the plan, no extra pass and no job before it).
    lenient: unmatched rows get the literal distance 31 and flags 0.
    """
    keys = roles.keys
    if check_unique:
        calendar = assert_unique(calendar, *keys, message="Calendar has duplicate key ")
    cal = calendar.select(*keys, *CALENDAR_FEATURE_COLUMNS).withColumn("_cal_hit", F.lit(True))
    base = df.drop(*[c for c in CALENDAR_FEATURE_COLUMNS if c in df.columns])
    joined = base.join(cal, keys, "left")
    hit = F.col("_cal_hit").isNotNull()
    if strict:
        # A filter predicate is always evaluated (a dropped helper column would
        # be pruned by the optimizer together with its check).
        check = F.when(hit, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("Calendar has no row for key "),
                                   F.col(roles.entity).cast("string"), F.lit(" "),
                                   F.col(roles.time).cast("string"))).cast("boolean"))
        return joined.filter(check).drop("_cal_hit")
    fills = {c: F.when(hit, F.col(c)).otherwise(
        F.lit(0 if c.startswith("is_") else UNMATCHED_DISTANCE)) for c in CALENDAR_FEATURE_COLUMNS}
    return joined.withColumns(fills).drop("_cal_hit")
