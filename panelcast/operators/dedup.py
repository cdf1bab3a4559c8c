"""Sort, keep-last de-duplication, top-k and set operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: Sequence[str | Column] | str | Column, descending: bool = True) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    out = []
    for c in cols:
        c = F.col(c) if isinstance(c, str) else c
        out.append(c.desc_nulls_last() if descending else c.asc_nulls_first())
    return out


def dedup_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | str | Column) -> DataFrame:
    """SRT-02: keep the last row per key by an explicit, total ``order``
    (source order such as file + line), so results are reproducible.

    ``max_by`` over a struct would also work; a row_number window keeps all
    columns without naming them and is planned as one exchange on the keys.
    """
    w = Window.partitionBy(*keys).orderBy(*_order(order, descending=True))
    return df.withColumn("_rk", F.row_number().over(w)).filter("_rk = 1").drop("_rk")


def top_n(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """SRT-03 / SRT-04: first n rows by an order (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def union_batches(base: DataFrame, *batches: DataFrame) -> DataFrame:
    """SET-01: base + accepted batches, missing columns filled with null."""
    out = base
    for b in batches:
        out = out.unionByName(b, allowMissingColumns=True)
    return out


def union_keep_last(frames: Sequence[DataFrame], keys: Sequence[str],
                    source_order: str = "_src_order") -> DataFrame:
    """SET-02/03/04: union all frames tagged with their position, drop null
    keys, keep the last row per key (later frames win; within a frame the
    ``_line`` column, if present, breaks ties)."""
    tagged = None
    for i, f in enumerate(frames):
        t = f.withColumn(source_order, F.lit(i))
        tagged = t if tagged is None else tagged.unionByName(t, allowMissingColumns=True)
    tagged = tagged.dropna(subset=list(keys))
    order = [source_order] + (["_line"] if "_line" in tagged.columns else [])
    return dedup_last(tagged, keys, order).drop(source_order)


def value_set_difference(current: DataFrame, reference: DataFrame, col: str, out: str = "v") -> DataFrame:
    """SET-05: distinct values of current not in reference (EXCEPT)."""
    return current.select(F.col(col).alias(out)).subtract(reference.select(F.col(col).alias(out)))


def value_set_intersection(current: DataFrame, reference: DataFrame, col: str, out: str = "v") -> DataFrame:
    """SET-05: distinct values present on both sides (INTERSECT)."""
    return current.select(F.col(col).alias(out)).intersect(reference.select(F.col(col).alias(out)))
