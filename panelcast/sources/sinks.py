"""Sinks: result tables, append-only histories, partitioned prediction log,
entity state, dataset snapshots with manifests, artifact checksums."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.sources.files import read_if_available


def save_table(df: DataFrame, path: str, fmt: str | None = None) -> None:
    """SNK-01: overwrite a result table; the format comes from the suffix."""
    fmt = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def append_history(rows: DataFrame, path: str, run_ts: dt.datetime | str) -> None:
    """SNK-02: append one evaluation's rows with one shared UTC ``timestamp``
    (O(new rows), not a rewrite of the whole history)."""
    rows.withColumn("timestamp", F.lit(run_ts).cast("timestamp")).write.mode("append").parquet(path)


# Metadata columns of a logged prediction.
PREDICTION_LOG_META = ("prediction_id", "prediction_ts", "prediction_date", "environment", "model_alias",
                       "model_version", "run_id", "request_id", "release_id")


def log_predictions(scored: DataFrame, path: str, *, environment: str, model_alias: str, model_version: str,
                    run_id: str, release_id: str, request_col: str | None = None,
                    ts: dt.datetime | None = None) -> DataFrame:
    """SNK-03: input columns + prediction + metadata, appended to a
    ``prediction_date``-partitioned parquet log (readers prune by date)."""
    ts = ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    out = scored.withColumns({
        "prediction_id": F.expr("uuid()"),
        "prediction_ts": F.lit(ts).cast("timestamp"),
        "prediction_date": F.lit(ts.date().isoformat()),
        "environment": F.lit(environment), "model_alias": F.lit(model_alias),
        "model_version": F.lit(model_version), "run_id": F.lit(run_id),
        "request_id": F.col(request_col).cast("string") if request_col else F.expr("uuid()"),
        "release_id": F.lit(release_id),
    })
    out.write.mode("append").partitionBy("prediction_date").parquet(path)
    return out


STATE_COMMITS = "version string, sequence long, committed_at timestamp"


def state_commits(spark: SparkSession, path: str) -> DataFrame:
    """SNK-04: the committed versions of a state table (none where there is no table yet)."""
    return read_if_available(spark, f"{path.rstrip('/')}/commits", T.StructType.fromDDL(STATE_COMMITS))


def current_state_version(spark: SparkSession, path: str) -> str | None:
    """SNK-04: folder name of the newest committed version: highest sequence, of two
    writers that took the same one the later commit."""
    newest = state_commits(spark, path).orderBy(F.desc("sequence"), F.desc("committed_at"), F.desc("version")).head(1)
    return newest[0]["version"] if newest else None


def write_state(state: DataFrame, path: str) -> str:
    """SNK-04: entity state (entity, history) as a new version of the table at ``path``.

    Rows go to a folder of their own; only when all are written is one row appended to
    ``commits``, which Spark's committer moves into place as a single file. Nothing is
    overwritten: a reader meanwhile, and every reader after a write that died, sees the
    version before; the new state may be computed from the old one. Earlier versions stay
    for readers that resolved them. Returns the version."""
    spark, root, version = state.sparkSession, path.rstrip("/"), f"v-{uuid.uuid4().hex}"
    state.write.parquet(f"{root}/versions/{version}")
    taken = state_commits(spark, root).agg(F.coalesce(F.max("sequence"), F.lit(0)).alias("n")).head()["n"]
    commit = spark.range(1).select(F.lit(version).alias("version"), F.lit(taken + 1).cast("long").alias("sequence"),
                                   F.current_timestamp().alias("committed_at"))
    commit.coalesce(1).write.mode("append").parquet(f"{root}/commits")
    return version


def read_state(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """SNK-04: the newest committed state, resolved once when the plan is built (or the
    named version); entities whose history is not a list are skipped."""
    version = version or current_state_version(spark, path)
    if version is None:
        raise ValueError(f"No committed state under {path}")
    df = spark.read.parquet(f"{path.rstrip('/')}/versions/{version}")
    return df.filter(F.col("history").isNotNull())


def snapshot(spark: SparkSession, frames: dict[str, DataFrame], root: str, version_id: str,
             config: dict, seed: int = 42, environment: str = "dev", commit: str | None = None) -> dict:
    """SNK-05: write each DataFrame under the version folder and a manifest
    (version, environment, commit, seed, effective config, snapshots) as a
    one-row JSON table, plus a ``latest`` manifest."""
    base = f"{root.rstrip('/')}/{version_id}"
    snaps = {}
    for name, df in frames.items():
        p = f"{base}/{name}"
        df.write.mode("overwrite").parquet(p)
        snaps[name] = p
    manifest = {"dataset_version": version_id, "environment": environment, "git_commit": commit, "seed": seed,
                "created_at_utc": dt.datetime.now(dt.timezone.utc).isoformat(),
                "effective_config": json.dumps(config, sort_keys=True), "snapshots": snaps}
    m = spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "json string")
    m.coalesce(1).write.mode("overwrite").text(f"{base}/manifest")
    m.coalesce(1).write.mode("overwrite").text(f"{root.rstrip('/')}/latest_manifest")
    return manifest


MANIFEST_SCHEMA = ("dataset_version string, environment string, git_commit string, seed long, "
                   "created_at_utc string, effective_config string, snapshots map<string,string>")


def read_manifests(spark: SparkSession, pattern: str) -> DataFrame:
    """SNK-06 / SNK-07: manifests as a typed table, newest first."""
    lines = spark.read.text(pattern)
    m = lines.select(F.from_json("value", MANIFEST_SCHEMA).alias("m"), F.col("_metadata.file_path").alias("path"))
    return m.select("m.*", "path").orderBy(F.col("created_at_utc").desc())


def paths_from_manifest(manifests: DataFrame, version_id: str | None = None) -> DataFrame:
    """SNK-06: resolve snapshot paths of one (or the newest) version."""
    m = manifests if version_id is None else manifests.filter(F.col("dataset_version") == version_id)
    return m.orderBy(F.col("created_at_utc").desc()).limit(1).select(
        "dataset_version", F.explode("snapshots").alias("name", "path"))


def list_releases(manifests: DataFrame, active_version: str | None) -> DataFrame:
    """SNK-07: releases newest first with an ``active`` flag."""
    return manifests.select("dataset_version", "created_at_utc",
                            (F.col("dataset_version") == F.lit(active_version)).alias("active")) \
        .orderBy(F.col("created_at_utc").desc())


def file_checksums(spark: SparkSession, pattern: str) -> DataFrame:
    """SNK-08: SHA-256 per file (``binaryFile``; a file is hashed by the task
    that reads it)."""
    return spark.read.format("binaryFile").load(pattern).select(
        "path", "length", F.sha2("content", 256).alias("sha256"))


def verify_checksums(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """SNK-08: compare against the manifest's checksums; rows with a
    mismatch or a missing file (the load must fail on any)."""
    j = expected.join(actual.select("path", F.col("sha256").alias("actual")), "path", "left")
    return j.withColumn("ok", F.coalesce(F.col("actual") == F.col("sha256"), F.lit(False)))
