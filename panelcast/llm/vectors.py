"""Vector tables: which rows take part, and unit vectors as bytes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vec: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & ~bad & F.exists(vec, lambda x: x != 0)


def usable_rows(df: DataFrame, id_col: str, vec_col: str, *extra: str) -> DataFrame:
    """(id, vec as array<double>, *extra) of the rows that take part: usable vectors of
    the most common length; of rows that repeat an id, the smallest vector; no null id."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), *extra)
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vec")))
    lengths = rows.groupBy(F.size("vec").alias("size")).agg(F.count("*").alias("n"))
    best = lengths.agg(F.max(F.struct("n", "size")).alias("s")).select("s.size").scalar()
    rows = rows.where(F.size("vec") == best)
    return rows.groupBy("id").agg(F.min(F.struct("vec", *extra)).alias("s")).select("id", "s.*")


def matrix(column) -> np.ndarray:
    """Rows of an Arrow list column of one length, as doubles, each scaled by a power of
    two (which is exact and leaves cosines alone) so that squares neither overflow nor vanish."""
    x = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)
    if not x.size:
        return x
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1."""
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
