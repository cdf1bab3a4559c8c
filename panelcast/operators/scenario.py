"""What-if scenario uplift (PRJ-16) and request sampling (PRJ-15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scenario_progress(day: Column, start: int, duration: int) -> Column:
    """0 before the start day, then min((day - start + 1) / duration, 1)."""
    return F.when(day < start, F.lit(0.0)).otherwise(F.least((day - start + 1) / float(duration), F.lit(1.0)))


def apply_scenario(df: DataFrame, day: Column, scenario: str = "gradual_promo_shift", start: int = 46,
                   duration: int = 14, base_uplift: float = 0.10, promo_uplift: float = 0.35,
                   target: str = "Sales", promo: str = "Promo") -> DataFrame:
    """PRJ-16: Sales * (1 + base * progress), or (1 + promo * progress) on
    promo rows, rounded half-even to an integer; all days in one projection.
    ``stable`` leaves sales unchanged; other names are an error."""
    if scenario == "stable":
        return df.withColumns({"progress": F.lit(0.0), "base_multiplier": F.lit(1.0), "promo_multiplier": F.lit(1.0)})
    if scenario != "gradual_promo_shift":
        raise ValueError(f"Unsupported drift scenario: {scenario}")
    prog = scenario_progress(day, start, duration)
    is_promo = F.coalesce(F.col(promo).cast("string").try_cast("double"), F.lit(0.0)) == 1
    df = df.withColumns({"progress": prog, "base_multiplier": 1.0 + base_uplift * prog,
                         "promo_multiplier": 1.0 + promo_uplift * prog})
    mult = F.when(is_promo, F.col("promo_multiplier")).otherwise(F.col("base_multiplier"))
    return df.withColumn(target, F.rint(F.col(target).cast("double") * mult).cast("long"))


def sample_requests(df: DataFrame, columns: Sequence[str], n: int | None = None, seed: int = 42,
                    target: str = "Sales", keys: Sequence[str] = ("Store", "Date")) -> DataFrame:
    """PRJ-15: fixed request columns, target dropped, all rows or n rows
    chosen by a seeded hash order (deterministic, distributed top-k)."""
    out = df.select(*[c for c in columns if c != target and c in df.columns])
    if n is None:
        return out
    h = F.xxhash64(*[F.col(k) for k in keys], F.lit(seed))
    return out.orderBy(h, *keys).limit(n)
