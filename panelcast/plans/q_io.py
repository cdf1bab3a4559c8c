"""Catalogue: file sources and sinks. Stand-in files are written from the
driver's tables into a fresh folder under the shared checkpoint folder,
then read back through the library's readers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from panelcast.operators.state import create_state
from panelcast.plans.registry import Inputs, query, rounded
from panelcast.schema import Roles, STATE_SCHEMA
from panelcast.sources import files as Fi
from panelcast.sources import sinks as Sk
from panelcast.sources.adapters import raw_sales_rows

R = Roles()
SALES_COLS = ["Store", "DayOfWeek", "Date", "Sales", "Customers", "Open", "Promo", "StateHoliday", "SchoolHoliday"]


def _write_batches(spark, sf_dir, name: str) -> str:
    """One CSV folder per ship year (batch files) from the raw rows."""
    raw = raw_sales_rows(Inputs(spark, sf_dir).t.lineitem)
    out = Fi.scratch_dir(spark, name)
    (raw.withColumn("year", F.year("Date")).select(*SALES_COLS, "year")
     .write.mode("overwrite").partitionBy("year").option("header", True).csv(out))
    return out


@query("src_01_typed_csv_scan")
def src_01_typed_csv_scan(spark, sf_dir):
    path = _write_batches(spark, sf_dir, "src01")
    return Fi.read_sales_csv(spark, f"{path}/year=*/*.csv")


@query("src_02_column_pruned_csv_scan")
def src_02_column_pruned_csv_scan(spark, sf_dir):
    path = _write_batches(spark, sf_dir, "src02")
    return Fi.read_calendar_source(spark, f"{path}/year=*/*.csv")


@query("src_04_suffix_dispatched_load")
def src_04_suffix_dispatched_load(spark, sf_dir):
    base = Fi.scratch_dir(spark, "src04")
    p = Inputs(spark, sf_dir).panel()
    p.write.mode("overwrite").parquet(f"{base}/panel.parquet")
    p.write.mode("overwrite").option("header", True).csv(f"{base}/panel.csv")
    a = Fi.load_table(spark, f"{base}/panel.parquet").withColumn("fmt", F.lit("parquet"))
    from panelcast.schema import SALES_SCHEMA
    from pyspark.sql import types as T
    csv_schema = T.StructType([SALES_SCHEMA[c] for c in p.columns])
    b = Fi.load_table(spark, f"{base}/panel.csv", csv_schema).withColumn("fmt", F.lit("csv"))
    return a.unionByName(b, allowMissingColumns=True)


@query("src_05_multi_file_glob_scan")
def src_05_multi_file_glob_scan(spark, sf_dir):
    """Rows per batch folder (from the file path in ``_metadata``)."""
    path = _write_batches(spark, sf_dir, "src05")
    b = Fi.read_batches(spark, f"{path}/year=*/*.csv")
    year = F.regexp_extract("file", r"year=(\d+)", 1).cast("int").alias("year")
    return b.groupBy(year).agg(F.count(F.lit(1)).alias("rows"), F.min("Date").alias("min_date"),
                               (F.count("file_mtime") == F.count(F.lit(1))).alias("all_timed"))


@query("src_06_optional_source")
def src_06_optional_source(spark, sf_dir):
    """Performance history read with its declared schema: the written
    history (rolling metrics of the predictions) plus a missing second
    source, which contributes an empty frame instead of failing."""
    from panelcast.operators.metrics import rolling_metrics
    from panelcast.schema import PERFORMANCE_HISTORY_SCHEMA
    base = Fi.scratch_dir(spark, "src06")
    h = rolling_metrics(Inputs(spark, sf_dir).predictions())
    h.select(*[F.col(f.name).cast(f.dataType) for f in PERFORMANCE_HISTORY_SCHEMA.fields]) \
        .write.mode("overwrite").parquet(f"{base}/history")
    present = Fi.read_if_available(spark, f"{base}/history", PERFORMANCE_HISTORY_SCHEMA)
    missing = Fi.read_if_available(spark, f"{base}/no_history", PERFORMANCE_HISTORY_SCHEMA)
    from panelcast.plans.registry import rounded
    return rounded(present.unionByName(missing))


@query("src_07_structured_log_scan", """
SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS INT) AS k FROM events
WHERE TRY_CAST(json_extract(props, '$.k') AS INT) IS NOT NULL""")
def src_07_structured_log_scan(spark, sf_dir):
    """Nested JSON payload of each event parsed into typed fields; rows
    without the field are dropped."""
    ev = Inputs(spark, sf_dir).t.events
    return Fi.parse_json_column(ev, "props", "k int", keep=["event_id"]).filter(F.col("k").isNotNull())


@query("src_07_prediction_log_json")
def src_07_prediction_log_json(spark, sf_dir):
    """Predictions logged as JSON lines, read back with ``from_json``."""
    p = Inputs(spark, sf_dir).predictions()
    js = p.select(F.to_json(F.struct(F.struct(
        F.struct(F.col("Store").alias("store"), F.date_format("Date", "yyyy-MM-dd").alias("date"),
                 F.col("Customers").alias("customers"), F.col("Promo").alias("promo")).alias("input"),
        F.when(F.col("prediction") > 0, F.col("prediction")).alias("prediction")).alias("jsonPayload"))).alias("value"))
    out = Fi.scratch_dir(spark, "src07")
    js.write.mode("overwrite").text(out)
    return Fi.read_structured_log(spark.read.text(out))


@query("src_08_newest_file_pick")
def src_08_newest_file_pick(spark, sf_dir):
    """The files of every year, then the last year's delivered again: one of those is the
    newest. Each task writes the rows it reads, no task all of them."""
    path = _write_batches(spark, sf_dir, "src08")
    raw = raw_sales_rows(Inputs(spark, sf_dir).t.lineitem)
    last = F.year(raw.agg(F.max("Date")).scalar())
    raw.filter(F.year("Date") == last).select(*SALES_COLS, F.year("Date").alias("year")) \
        .write.partitionBy("year").option("header", True).csv(f"{path}/late")
    newest = Fi.newest_file(spark, [f"{path}/year=*/*.csv", f"{path}/late/year=*/*.csv"])
    return newest.select(F.regexp_extract("file", r"/year=(\d+)/", 1).cast("int").alias("year"),
                         F.col("file").contains("/late/").alias("is_late"), (F.col("length") > 0).alias("has_size"))


@query("src_09_result_file_discovery")
def src_09_result_file_discovery(spark, sf_dir):
    """Three kinds of rolling-metric result files: with the required header, with the
    columns in another order beside a quoted text column, and without two of them (not read)."""
    from panelcast.operators.metrics import rolling_metrics
    base = Fi.scratch_dir(spark, "src09")
    h = rolling_metrics(Inputs(spark, sf_dir).predictions()).withColumn("day", F.datediff("window_end", F.lit("1990-01-01")))
    note = F.lit('seven days, "rolling"').alias("note")
    for name, cols in (("plain", ["day", "rmse", "mae", "bias"]), ("swapped", ["bias", note, "mae", "day", "rmse"]),
                       ("short", ["day", "rmse"])):
        h.select(*cols).write.option("header", True).option("escape", '"').csv(f"{base}/{name}")
    _, data = Fi.discover_result_files(spark, f"{base}/*/*.csv")
    return rounded(data.select(F.col("day").cast("long").alias("day"), "rmse", "mae", "bias",
                               F.regexp_extract("source_file", r"/(\w+)/[^/]*$", 1).alias("source")))


@query("snk_01_overwrite_sink")
def snk_01_overwrite_sink(spark, sf_dir):
    from panelcast.operators.metrics import rolling_metrics
    out = Fi.scratch_dir(spark, "snk01") + "/metrics.csv"
    Sk.save_table(rolling_metrics(Inputs(spark, sf_dir).predictions()), out)
    Sk.save_table(rolling_metrics(Inputs(spark, sf_dir).predictions()), out)  # the second write replaces the first
    from panelcast.plans.registry import rounded
    back = spark.read.option("header", True).csv(out)
    return rounded(back.select(F.col("window_end").cast("date").alias("window_end"), F.col("n_samples").cast("long"),
                               *[F.col(c).cast("double") for c in ("rmse", "mae", "bias")]))


@query("snk_02_append_history")
def snk_02_append_history(spark, sf_dir):
    """Two drift evaluations appended with their own run timestamps."""
    from panelcast.operators.drift import categorical_drift
    from panelcast.sources.adapters import drift_samples
    ref, cur = drift_samples(Inputs(spark, sf_dir).t.events)
    out = Fi.scratch_dir(spark, "snk02")
    res = categorical_drift(ref, cur, ["event_type"])
    Sk.append_history(res, out, "2024-01-31 00:00:00")
    Sk.append_history(res, out, "2024-02-01 00:00:00")
    from panelcast.plans.registry import rounded
    return rounded(spark.read.parquet(out))


@query("snk_03_prediction_log")
def snk_03_prediction_log(spark, sf_dir):
    """Scored rows logged with metadata into date partitions; read back with
    partition pruning on ``prediction_date``."""
    p = Inputs(spark, sf_dir).predictions().select("Store", "Date", "Promo", "prediction")
    out = Fi.scratch_dir(spark, "snk03")
    Sk.log_predictions(p, out, environment="dev", model_alias="champion", model_version="1", run_id="r1",
                       release_id="rel-1", ts=dt.datetime(2024, 1, 31, 12, 0))
    back = spark.read.parquet(out).filter(F.col("prediction_date") == "2024-01-31")
    from panelcast.plans.registry import rounded
    ids = back.agg((F.count_distinct("prediction_id") == F.count("*")).alias("u")).scalar()
    return rounded(back.select("Store", "Date", "Promo", "prediction", "environment", "model_alias", "model_version",
                               "run_id", "release_id", ids.alias("ids_unique")))


@query("snk_04_state_write_read")
def snk_04_state_write_read(spark, sf_dir):
    """A state without the last 14 days, replaced by the whole one; between the two a
    write that died before its commit, which no reader sees."""
    from panelcast.operators.splits import holdout_split
    panel, out = Inputs(spark, sf_dir).panel(), Fi.scratch_dir(spark, "snk04")
    Sk.write_state(create_state(holdout_split(panel, R, 14)[0], R, 28), out)
    spark.createDataFrame([], Sk.read_state(spark, out).schema).write.parquet(f"{out}/versions/v-uncommitted")
    Sk.write_state(create_state(panel, R, 28), out)
    return Sk.read_state(spark, out)


def _snapshot(spark, sf_dir):
    from panelcast.operators.splits import holdout_split
    i = Inputs(spark, sf_dir)
    p = i.panel()
    train, val = holdout_split(p, R, 14)
    root = Fi.scratch_dir(spark, "snk05")
    Sk.snapshot(spark, {"validated": p, "train": train, "validation": val}, root, "ds_20240131_120000",
                {"lags": [1, 7, 14, 28]})
    Sk.snapshot(spark, {"validated": p}, root, "ds_20240201_120000", {"lags": [1, 7]})
    return root


@query("snk_05_dataset_snapshot")
def snk_05_dataset_snapshot(spark, sf_dir):
    root = _snapshot(spark, sf_dir)
    return Sk.read_manifests(spark, f"{root}/ds_*/manifest").select("dataset_version", "seed", "snapshots")


@query("snk_06_manifest_resolve")
def snk_06_manifest_resolve(spark, sf_dir):
    """Resolve a frozen version's paths and read its training split."""
    root = _snapshot(spark, sf_dir)
    paths = Sk.paths_from_manifest(Sk.read_manifests(spark, f"{root}/ds_*/manifest"), "ds_20240131_120000")
    train_path = [r["path"] for r in paths.filter("name = 'train'").collect()][0]
    return spark.read.parquet(train_path).agg(F.count(F.lit(1)).alias("rows"), F.max("Date").alias("max_date"))


@query("snk_07_manifest_catalogue")
def snk_07_manifest_catalogue(spark, sf_dir):
    root = _snapshot(spark, sf_dir)
    return Sk.list_releases(Sk.read_manifests(spark, f"{root}/ds_*/manifest"), "ds_20240131_120000")


@query("snk_08_artifact_checksums")
def snk_08_artifact_checksums(spark, sf_dir):
    """SHA-256 of every written snapshot file, verified against the recorded ones, after
    the files of one version were overwritten with other rows."""
    root = _snapshot(spark, sf_dir)
    expected = Sk.file_checksums(spark, f"{root}/ds_*/*/*.parquet").select("path", "sha256")
    recorded = f"{Fi.scratch_dir(spark, 'snk08')}/checksums"
    expected.write.parquet(recorded)
    tampered = Inputs(spark, sf_dir).panel().withColumn("Sales", F.col("Sales") + 1)
    tampered.write.mode("overwrite").parquet(f"{root}/ds_20240201_120000/validated")
    checked = Sk.verify_checksums(Sk.file_checksums(spark, f"{root}/ds_*/*/*.parquet"), spark.read.parquet(recorded))
    version = F.regexp_extract("path", r"/(ds_\d+_\d+)/(\w+)", 1).alias("version")
    part = F.regexp_extract("path", r"/(ds_\d+_\d+)/(\w+)", 2).alias("part")
    return checked.groupBy(version, part).agg(F.bool_and("ok").alias("ok")).where("part <> 'manifest'")


@query("fun_10_file_content_batch_id")
def fun_10_file_content_batch_id(spark, sf_dir):
    """Content ids of written batch files (``binaryFile`` bytes)."""
    from panelcast.functions.scalar import content_batch_id
    path = _write_batches(spark, sf_dir, "fun10")
    return spark.read.format("binaryFile").load(f"{path}/year=*/*.csv").select(
        "path", content_batch_id(F.col("content")).alias("batch_id"))


def _register_file_oracles() -> None:
    """Readers that return the written rows unchanged get SQL oracles."""
    from panelcast.plans.q_calendar import RAW_ROWS_SQL
    from panelcast.plans.registry import ORACLES
    from panelcast.plans.sql import with_ctes
    cols = ", ".join(SALES_COLS)
    ORACLES["src_01_typed_csv_scan"] = with_ctes(f"SELECT {cols} FROM raw", extra={"raw": RAW_ROWS_SQL})
    ORACLES["src_02_column_pruned_csv_scan"] = with_ctes(
        "SELECT Store, Date, StateHoliday, SchoolHoliday FROM raw", extra={"raw": RAW_ROWS_SQL})
    ORACLES["src_04_suffix_dispatched_load"] = with_ctes(
        "SELECT *, 'parquet' AS fmt FROM sales_panel UNION ALL SELECT *, 'csv' AS fmt FROM sales_panel", "sales_panel")
    ORACLES["src_06_optional_source"] = with_ctes("""
SELECT ROUND(SQRT(s2 / n), 4) AS rmse, ROUND(sa / n, 4) AS mae, ROUND(s1 / n, 4) AS bias, n AS n_samples,
       CAST(d - 7 AS TIMESTAMP) AS window_start, CAST(d AS TIMESTAMP) AS window_end FROM (
  SELECT d, SUM(s2) OVER w AS s2, SUM(sa) OVER w AS sa, SUM(s1) OVER w AS s1, SUM(n) OVER w AS n
  FROM (SELECT Date AS d, SUM((Sales - prediction) * (Sales - prediction)) AS s2, SUM(ABS(Sales - prediction)) AS sa,
               SUM(Sales - prediction) AS s1, COUNT(*) AS n FROM naive_predictions GROUP BY Date) x
  WINDOW w AS (ORDER BY d RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)) y""", "naive_predictions")
    ORACLES["src_08_newest_file_pick"] = with_ctes(
        "SELECT CAST(year(MAX(Date)) AS INT) AS year, true AS is_late, true AS has_size FROM raw",
        extra={"raw": RAW_ROWS_SQL})
    ORACLES["src_09_result_file_discovery"] = (
        "SELECT date_diff('day', DATE '1990-01-01', window_end) AS day, rmse, mae, bias, source FROM ("
        + ORACLES["win_09_rolling_metrics"] + ") h, (VALUES ('plain'), ('swapped')) t(source)")
    ORACLES["src_05_multi_file_glob_scan"] = with_ctes(
        "SELECT CAST(year(Date) AS INT) AS year, COUNT(*) AS rows, MIN(Date) AS min_date, true AS all_timed FROM raw GROUP BY 1",
        extra={"raw": RAW_ROWS_SQL})
    ORACLES["src_07_prediction_log_json"] = with_ctes(
        "SELECT Store, Date, Customers, Promo, prediction FROM naive_predictions WHERE prediction > 0", "naive_predictions")
    ORACLES["snk_01_overwrite_sink"] = ("SELECT CAST(window_end AS DATE) AS window_end, n_samples, rmse, mae, bias FROM ("
                                        + ORACLES["src_06_optional_source"] + ") h")
    ORACLES["snk_03_prediction_log"] = with_ctes(
        "SELECT Store, Date, Promo, ROUND(prediction, 4) AS prediction, 'dev' AS environment, 'champion' AS model_alias, "
        "'1' AS model_version, 'r1' AS run_id, 'rel-1' AS release_id, true AS ids_unique FROM naive_predictions", "naive_predictions")
    ORACLES["snk_08_artifact_checksums"] = (
        "SELECT * FROM (VALUES ('ds_20240131_120000', 'validated', true), ('ds_20240131_120000', 'train', true), "
        "('ds_20240131_120000', 'validation', true), ('ds_20240201_120000', 'validated', false)) t(version, part, ok) "
        "WHERE EXISTS (SELECT 1 FROM lineitem)")
    ORACLES["snk_04_state_write_read"] = ORACLES["win_07_tail_n_state"]
    ORACLES["snk_06_manifest_resolve"] = with_ctes(
        "SELECT COUNT(*) AS rows, MAX(Date) AS max_date FROM sales_panel "
        "WHERE Date <= (SELECT MAX(Date) FROM sales_panel) - 14", "sales_panel")
    ORACLES["prj_02_strict_casts"] = ("SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INT) AS rank "
                                      "FROM orders")
    from panelcast.plans.q_drift import EV, _chi_sql
    ORACLES["snk_02_append_history"] = with_ctes(
        "SELECT c.*, t.timestamp FROM chi c, (VALUES (TIMESTAMP '2024-01-31 00:00:00'), "
        "(TIMESTAMP '2024-02-01 00:00:00')) t(timestamp)", extra={**EV, "chi": _chi_sql(["event_type"])})

