"""Declarative row validation, coercion and batch quarantine.

A rule table maps a rule name to a boolean Column; the violations of a row
are ``array_compact(array(when(~rule, name) ...))``. A NULL rule result
counts as a failure (nullable columns say so in their rule), so validation
is one projection, planned inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    check: object | None        # coerced Column -> Column; None = only "present and coercible"
    nullable: bool = False
    optional: bool = False      # column may be absent
    dtype: str | None = None    # coercion target


def _coerced(r: Rule, types: dict[str, str]) -> Column:
    """The column coerced to the rule's type: a plain (try) cast from
    numeric / date sources, a parse only when the source is text."""
    raw = F.col(r.column)
    if not r.dtype or types.get(r.column) == r.dtype:
        return raw
    return raw.try_cast(r.dtype)


def _rule_col(r: Rule, types: dict[str, str]) -> Column:
    raw = F.col(r.column)
    coerced = _coerced(r, types)
    ok = F.lit(True) if r.check is None else r.check(coerced)
    coerce_ok = raw.isNull() | coerced.isNotNull() if r.dtype and types.get(r.column) != r.dtype else F.lit(True)
    null_ok = F.lit(True) if r.nullable else raw.isNotNull()
    return F.coalesce(coerce_ok & null_ok & (raw.isNull() | ok), F.lit(False))


def _types(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


# The training-row contract of the sales panel.
TRAIN_RULES: tuple[Rule, ...] = (
    Rule("Store>0", "Store", lambda c: c > 0, dtype="bigint"),
    Rule("Date", "Date", None, dtype="date"),
    Rule("Sales>=0", "Sales", lambda c: c >= 0, nullable=True, optional=True, dtype="double"),
    Rule("Customers>=0", "Customers", lambda c: c >= 0, nullable=True, dtype="bigint"),
    Rule("Open in {0,1}", "Open", lambda c: c.isin(0, 1), dtype="int"),
    Rule("Promo in {0,1}", "Promo", lambda c: c.isin(0, 1), dtype="int"),
    Rule("StateHoliday in {0,a,b,c}", "StateHoliday", lambda c: c.cast("string").isin("0", "a", "b", "c")),
    Rule("SchoolHoliday in {0,1}", "SchoolHoliday", lambda c: c.isin(0, 1), dtype="int"),
    Rule("DayOfWeek in 1..7", "DayOfWeek", lambda c: c.between(1, 7), nullable=True, optional=True,
         dtype="int"),
)

# The store-dimension contract.
STORE_RULES: tuple[Rule, ...] = (
    Rule("Store>0", "Store", lambda c: c > 0, dtype="bigint"),
    Rule("StoreType in a..d", "StoreType", lambda c: c.isin("a", "b", "c", "d")),
    Rule("Assortment in a..c", "Assortment", lambda c: c.isin("a", "b", "c")),
    Rule("CompetitionDistance>=0", "CompetitionDistance", lambda c: c >= 0,
         nullable=True, dtype="double"),
)

# The scoring-input contract.
INFERENCE_RULES: tuple[Rule, ...] = (
    Rule("Store>=1", "Store", lambda c: c >= 1, dtype="bigint"),
    Rule("Date", "Date", None, dtype="date"),
    Rule("Open in {0,1}", "Open", lambda c: c.isin(0, 1), nullable=True, dtype="int"),
    Rule("Promo in {0,1}", "Promo", lambda c: c.isin(0, 1), nullable=True, dtype="int"),
    Rule("StateHoliday", "StateHoliday", None, nullable=True),
    Rule("SchoolHoliday in {0,1}", "SchoolHoliday", lambda c: c.isin(0, 1), nullable=True,
         dtype="int"),
)


def violations(df: DataFrame, rules: Sequence[Rule]) -> Column:
    """Array of failed rule names for each row (a missing required column
    is a plan-time error, like a schema check)."""
    cols = set(df.columns)
    types = _types(df)
    checks = []
    for r in rules:
        if r.column not in cols:
            if r.optional:
                continue
            raise ValueError(f"column '{r.column}' not in dataframe")
        checks.append(F.when(~_rule_col(r, types), F.lit(r.name)))
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def with_violations(df: DataFrame, rules: Sequence[Rule], name: str = "violations") -> DataFrame:
    """PRJ-03 / PRJ-04: add the per-row violations column."""
    return df.withColumn(name, violations(df, rules))


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Good rows and bad rows (with their violations) of one lazy plan."""
    tagged = with_violations(df, rules)
    good = tagged.filter(F.size("violations") == 0).drop("violations")
    bad = tagged.filter(F.size("violations") > 0)
    return good, bad


def violation_summary(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows checked and failures per rule, one aggregate for all rules."""
    cols = set(df.columns)
    present = [r for r in rules if r.column in cols or not r.optional]
    types = _types(df)
    aggs = [F.count_if(~_rule_col(r, types)).alias(f"_r{i}") for i, r in enumerate(present)]
    wide = df.agg(F.count(F.lit(1)).alias("rows_checked"), *aggs)
    pairs = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(f"_r{i}").alias("failures"))
                      for i, r in enumerate(present)])
    return wide.select("rows_checked", F.explode(pairs).alias("p")).select("p.rule", "rows_checked", "p.failures")


def validate_inference(df: DataFrame, rules: Sequence[Rule] = INFERENCE_RULES, target: str = "Sales") -> DataFrame:
    """PRJ-05: the target column must be absent (plan-time check); rows are tagged with
    violations; an empty input raises when the plan runs. For that a branch without rows is
    added, which looks for one input row (a limit, not a count of all)."""
    if target in df.columns:
        raise ValueError(f"Inference input must not contain target column '{target}'")
    tagged = with_violations(df, rules)
    found = df.select(F.lit(1).alias("_row")).limit(1).agg(F.count("_row").alias("_found"))
    stop = F.when(F.col("_found") > 0, F.lit(False)).otherwise(
        F.raise_error(F.lit("Inference input is empty")).cast("boolean"))
    none = found.filter(stop).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in tagged.schema.fields])
    return tagged.unionByName(none)


def coerce(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """PRJ-01: coercing casts; a bad value becomes NULL (``try_cast``)."""
    out = {}
    for c, t in types.items():
        if c in df.columns:
            if t in ("date", "timestamp"):
                src = F.col(c).cast("string")
                ts = F.coalesce(F.try_to_timestamp(src), F.try_to_timestamp(src, F.lit("yyyy-MM-dd")))
                out[c] = ts.cast(t)
            else:
                out[c] = F.col(c).cast("string").try_cast(t)
    return df.withColumns(out)


def strict_cast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """PRJ-02: strict casts; under ANSI mode one bad value fails the job."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items() if c in df.columns})


def route_batches(df: DataFrame, rules: Sequence[Rule], file_col: str = "file") -> tuple[DataFrame, DataFrame, DataFrame]:
    """PRJ-06: each batch file is validated alone and rejected whole.

    One aggregate gives a per-file verdict (one row per file); accepted and
    quarantined rows are a left-semi / left-anti join on the bad-file list,
    which Spark broadcasts only when its size estimate is under the
    threshold. Returns (accepted rows, quarantined rows, per-file verdicts).
    """
    tagged = with_violations(df, rules)
    verdict = tagged.groupBy(file_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.size("violations") > 0).alias("bad_rows"),
    ).withColumn("accepted", F.col("bad_rows") == 0)
    bad_files = verdict.filter(~F.col("accepted")).select(file_col)
    accepted = tagged.drop("violations").join(bad_files, file_col, "left_anti")
    quarantined = tagged.drop("violations").join(bad_files, file_col, "left_semi")
    return accepted, quarantined, verdict
