"""Helpers shared by the operators: work folders and column guards."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import ensure_checkpoint_dir

SPACE = " \t\n\x0b\f\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Work:
    """Intermediate tables of one operator call, as Parquet in the folder that
    ``spark.checkpoint.dir`` names. A table survives the loss of executors
    and ends the lineage of what was written."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def table(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        path = self.path(name)
        df.write.mode("overwrite").parquet(path, **options)
        return self.spark.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, everything else untouched (``lower`` where the text is
    all ASCII, as it is much faster than ``translate``)."""
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
            .otherwise(F.translate(c, _UPPER, _UPPER.lower())))


def named(c: str) -> Column:
    """The column of this very name, whatever characters it has."""
    return F.col("`" + c.replace("`", "``") + "`")


def packed(df: DataFrame, *apart: str) -> Column:
    """All columns but those named, as one struct ``row``: beside it an operator may use
    any column name, as none of the caller's can clash."""
    kept = [named(c) for c in df.columns if c not in apart]
    return F.struct(*(kept or [F.lit(0).alias("none")])).alias("row")


def unpacked(df: DataFrame, **apart: Column) -> list[Column]:
    """The columns of ``df`` in their order, from ``row`` and the given columns."""
    return [(apart[c] if c in apart else F.col("row").getField(c)).alias(c) for c in df.columns]
