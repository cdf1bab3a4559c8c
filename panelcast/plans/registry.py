"""Named catalogue queries and their SQL oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the driver's tables
(whole tables, no row caps); each ``O`` query has a DuckDB SQL twin with
the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.sources.adapters import naive_predictions, request_log, sales_panel, store_dim
from panelcast.sources.files import kept
from panelcast.sources.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


class Inputs:
    """The adapter tables for one scale-factor folder, all lazy plans over the
    driver's Parquet tables: column pruning and filters reach the scan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.t = Tables(spark, sf_dir)
        self.spark = spark
        self._panel = None

    def keep_panel(self) -> Inputs:
        """The panel aggregated once into a scratch table, for jobs that read it several times."""
        if self._panel is None:
            self._panel = kept(self.panel(), "panel")
        return self

    def panel(self) -> DataFrame:
        return sales_panel(self.t.lineitem) if self._panel is None else self._panel

    def store(self) -> DataFrame:
        return store_dim(self.t.supplier)

    def predictions(self) -> DataFrame:
        return naive_predictions(self.panel())

    def requests(self) -> DataFrame:
        return request_log(self.t.events)


def round_half_away(c, digits: int):
    """Round a double by scaling, rounding to an integer and scaling back.

    ``round(x, d)`` in Spark rounds the decimal text of the double, while
    most engines (DuckDB included) round the binary value; on short decimal
    ties (x.xxxx5) the two differ. Rounding ``x * 10^d`` to 0 places rounds
    the binary product the same way in both (checked on 20k values).
    """
    scale = float(10 ** digits)
    return F.round(c * scale, 0) / scale


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column to 4 places for comparison (the oracle SQL
    applies ROUND(x, 4) to the same columns): computed doubles differ in
    the last bits between engines."""
    return df.select(*[
        round_half_away(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name) for f in df.schema.fields])
