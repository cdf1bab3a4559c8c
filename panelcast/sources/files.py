"""File sources: typed CSV scans, suffix dispatch, multi-file batches with
their path, optional sources, newest-file pick, result-file discovery and
the structured prediction log.

All reads are lazy with an explicit schema; ``_metadata`` gives per-row
file path / modification time without listing files on the driver.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Sequence
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.schema import SALES_SCHEMA
from panelcast.session import ensure_checkpoint_dir, settings


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder of the cluster
    (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/panelcast-io/{name}-{uuid.uuid4().hex[:12]}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a Parquet table in a fresh scratch folder, for jobs that read
    them several times: its plan runs once, and each later pass scans the columns it needs.
    The shuffle files of that plan are removed with the write, not whenever the driver
    collects its garbage."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, name)
    with settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def read_sales_csv(spark: SparkSession, path: str, schema: T.StructType = SALES_SCHEMA) -> DataFrame:
    """SRC-01: typed CSV scan (Date parsed as a date, StateHoliday kept as
    text so '0' never becomes an int next to 'a'/'b'/'c')."""
    return spark.read.schema(schema).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def read_calendar_source(spark: SparkSession, path: str) -> DataFrame:
    """SRC-02: only the four calendar columns; Catalyst prunes the rest out
    of the CSV scan, so the calendar can never see the target."""
    return read_sales_csv(spark, path).select("Store", "Date", "StateHoliday", "SchoolHoliday")


def load_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """SRC-04: ``.parquet`` or ``.csv`` by suffix; anything else is an error;
    a missing path fails at analysis (Spark checks existence)."""
    p = path.rstrip("/")
    if p.endswith(".parquet"):
        return spark.read.parquet(p)
    if p.endswith(".csv"):
        r = spark.read.option("header", True)
        r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
        return r.csv(p)
    raise ValueError(f"Unsupported table format: {path}")


def read_batches(spark: SparkSession, pattern: str, schema: T.StructType = SALES_SCHEMA) -> DataFrame:
    """SRC-05: all batch files of a glob; each row carries its file (one
    file = one batch) and modification time."""
    df = spark.read.schema(schema).option("header", True).csv(pattern)
    return df.select("*", F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_modification_time").alias("file_mtime"))


def read_if_available(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """SRC-06: a missing source yields an empty frame with the declared schema."""
    try:
        return spark.read.schema(schema).format(fmt).option("header", True).load(path)
    except Exception as e:  # noqa: BLE001 - Spark raises AnalysisException for a missing path
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def file_table(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """SRC-08: the listing as a table (file, file_mtime, length). The content column is not
    asked for, so no file is opened."""
    listed = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    return listed.select(F.col("path").alias("file"), F.col("modificationTime").alias("file_mtime"), "length")


def open_file(path: str):
    """A stream over the bytes of a file that Spark lists (its path is not escaped): local
    paths, and any store that pyarrow opens (s3, hdfs, gs, abfs)."""
    scheme, _, rest = path.partition(":/") if ":/" in path else ("file", "", path)
    if scheme == "file":
        system, at = fs.LocalFileSystem(), "/" + rest.lstrip("/")
    else:
        system, at = fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}:/{quote(rest)}")
    return system.open_input_stream(at, compression=None)


def _hashed_file(path: str) -> str:
    digest = hashlib.sha256()
    with open_file(path) as file:
        while block := file.read(1 << 20):
            digest.update(block)
    return f"gt-{digest.hexdigest()[:20]}"


def file_batch_id(path: str | Column) -> Column:
    """FUN-10 of a file by its path: its bytes are hashed a block at a time, so that a file of
    any size takes one block of memory (as a value it would be held whole, several times
    over, and end at 2 GB)."""
    def hashed(paths: pd.Series) -> pd.Series:
        return paths.map(_hashed_file)

    return F.pandas_udf(hashed, "string")(path)


def newest_file(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """SRC-08: the newest file by modification time (ties: path), from the listing alone;
    no row where nothing matches."""
    return file_table(spark, paths).orderBy(F.col("file_mtime").desc(), F.col("file").desc()).limit(1)


def newest_batch(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = SALES_SCHEMA) -> DataFrame:
    """SRC-08: rows of the newest file. Its name (one value) is resolved when the plan is
    built, so that the scan opens this file only."""
    newest = newest_file(spark, paths).head()
    if newest is None:
        raise ValueError(f"No batch file under {paths}")
    # a listed path is literal: the characters of a pattern in it must not match others
    literal = re.sub(r"([\[\]{}*?\\])", r"\\\1", newest["file"])
    return read_batches(spark, literal, schema)


#: A comma and the field after it: quoted (a doubled quote stands for one) or plain.
CSV_FIELD = r',(?:"([^"]*(?:""[^"]*)*)"|([^,]*))'


def csv_fields(line: Column) -> Column:
    """The fields of one CSV line as an array of texts."""
    led = F.concat(F.lit(","), line)
    quoted, plain = (F.regexp_extract_all(led, F.lit(CSV_FIELD), F.lit(group)) for group in (1, 2))
    return F.zip_with(quoted, plain, lambda q, p: F.when(q != "", F.replace(q, F.lit('""'), F.lit('"'))).otherwise(p))


def discover_result_files(spark: SparkSession, pattern: str,
                          required: Sequence[str] = ("day", "rmse", "mae", "bias")) -> tuple[DataFrame, DataFrame]:
    """SRC-09: only CSVs whose header holds all required columns are taken, whatever else
    they hold and in whatever order. Returns (per-file table with header and ``accepted``,
    newest first; rows of the accepted files: the required columns as double, the others as
    a map ``other``, and ``source_file``).

    One text scan for all files: a line's place is its split's start and its number in the
    task, the header is the line of the least place, fields are found by name in the plan.
    No path reaches the driver. A line break inside a quoted field is not supported; a
    field that is no number is NULL; blank lines are skipped."""
    place = F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(pattern).select(
        F.rtrim(F.col("value"), F.lit("\r")).alias("value"), F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("file_mtime"), place.alias("place")).filter("value <> ''")
    files = lines.groupBy("source_file", "file_mtime").agg(
        F.min("place").alias("first"), csv_fields(F.min_by("value", "place")).alias("header"))
    need = F.array(*[F.lit(c) for c in required])
    files = files.withColumn("accepted", F.size(F.array_except(need, F.col("header"))) == 0)
    rows = lines.drop("file_mtime").join(files.filter("accepted").select("source_file", "first", "header"), "source_file")
    values = F.transform(csv_fields(F.col("value")), lambda v: F.nullif(v, F.lit("")))
    # fields beyond the header have no name; of a name that stands twice the first counts
    named = F.transform("header", lambda name, i: F.struct(name.alias("name"), F.try_element_at("values", i + 1).alias("field")))
    known = rows.filter(F.col("place") > F.col("first")).select("source_file", "header", values.alias("values")).select(
        "source_file", F.map_from_entries(F.filter(
            named, lambda e, i: F.array_position("header", e["name"]) == i + 1)).alias("f"))
    other = F.map_filter("f", lambda k, v: ~F.array_contains(need, k))
    data = known.select(*[F.try_element_at("f", F.lit(c)).try_cast("double").alias(c) for c in required],
                        other.alias("other"), "source_file")
    return files.select("source_file", "file_mtime", "header", "accepted").orderBy(F.col("file_mtime").desc()), data


PREDICTION_LOG_JSON_SCHEMA = T.StructType([
    T.StructField("jsonPayload", T.StructType([
        T.StructField("input", T.StructType([
            T.StructField("store", T.LongType()), T.StructField("date", T.StringType()),
            T.StructField("customers", T.LongType()), T.StructField("promo", T.IntegerType())])),
        T.StructField("prediction", T.DoubleType()),
    ])),
])


def read_structured_log(lines: DataFrame, value_col: str = "value",
                        schema: T.StructType = PREDICTION_LOG_JSON_SCHEMA) -> DataFrame:
    """SRC-07: JSON log lines -> typed nested fields; rows without a
    prediction are dropped."""
    j = lines.select(F.from_json(F.col(value_col), schema).alias("j"))
    return j.select(
        F.col("j.jsonPayload.input.store").alias("Store"),
        F.to_date(F.col("j.jsonPayload.input.date")).alias("Date"),
        F.col("j.jsonPayload.input.customers").alias("Customers"),
        F.col("j.jsonPayload.input.promo").alias("Promo"),
        F.col("j.jsonPayload.prediction").alias("prediction"),
    ).filter(F.col("prediction").isNotNull())


def parse_json_column(df: DataFrame, col: str, schema: str | T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """SRC-07 core: a JSON text column parsed into typed fields (``from_json``)."""
    return df.select(*keep, F.from_json(F.col(col), schema).alias("_j")).select(*keep, "_j.*")
