"""Structured Streaming twins of the batch operators.

Every stream reads files as they arrive (file sources, explicit schema),
keeps state only where the operator needs it (watermarks bound it), and
writes through checkpointed sinks, so a restarted query resumes exactly
where it stopped. Each function returns the started ``StreamingQuery``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from panelcast.operators.scoring import Scorer
from panelcast.operators.serving import LATENCY_BUCKETS_SECONDS
from panelcast.operators.validate import TRAIN_RULES, route_batches
from panelcast.schema import SALES_SCHEMA, STATE_LENGTH, Roles
from panelcast.session import settings
from panelcast.sources.files import file_batch_id

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType()),
])


def _writer(df: DataFrame, checkpoint: str, available_now: bool = True):
    w = df.writeStream.option("checkpointLocation", checkpoint)
    return w.trigger(availableNow=True) if available_now else w


def after_watermark(condition: Column, ts: str = "ts") -> Column:
    """``condition`` for a filter behind a watermark on ``ts``. As it names ``ts``, the
    optimizer does not move it below the watermark: rows that fail it still move the clock."""
    return F.when(F.col(ts) < F.lit("0001-01-01").cast("timestamp"), F.lit(False)).otherwise(condition)


def ingest_stream(spark: SparkSession, source_dir: str, good_path: str, bad_path: str, checkpoint: str,
                  schema: T.StructType = SALES_SCHEMA):
    """STR-01: new batch files validated one file at a time inside each
    micro-batch (PRJ-03/06); accepted rows and quarantined rows go to two
    parquet sinks. ``foreachBatch`` is idempotent per epoch (overwrite of
    the epoch's partition)."""
    stream = (spark.readStream.schema(schema).option("header", True).csv(source_dir)
              .withColumn("file", F.col("_metadata.file_path")))

    def per_batch(batch: DataFrame, epoch: int) -> None:
        accepted, quarantined, _ = route_batches(batch, TRAIN_RULES)
        accepted.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(good_path)
        quarantined.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(bad_path)

    return _writer(stream, checkpoint).foreachBatch(per_batch).start()


REGISTER_SCHEMA = T.StructType([
    T.StructField("batch_id", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()), T.StructField("epoch", T.LongType())])


def register_batches(batch: DataFrame, epoch: int, register_path: str) -> None:
    """Append the content ids of one micro-batch that no earlier epoch holds. The rows of an
    epoch are one partition of the register, overwritten as a whole and compared with
    earlier epochs only: running an epoch again writes the same partition again."""
    known = (batch.sparkSession.read.schema(REGISTER_SCHEMA).parquet(register_path).where(F.col("epoch") < epoch)
             .select("batch_id"))
    # The same bytes under several names in one micro-batch: the first path stands for them.
    new = batch.groupBy("batch_id").agg(F.min("path").alias("path"), F.first("length").alias("length"))
    (new.join(known, "batch_id", "left_anti").withColumn("epoch", F.lit(epoch).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(register_path))


def dedup_batches_stream(spark: SparkSession, source_dir: str, register_path: str, checkpoint: str,
                         max_files: int | None = None):
    """STR-02: exactly-once batch counting: a file's content id (FUN-10) enters a permanent
    register once, however often and however late the same bytes arrive again. The content
    column is not asked for: a file's bytes are hashed block by block."""
    reader = spark.readStream.schema(BINARY_FILE_SCHEMA).format("binaryFile")
    files = (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(source_dir)
    ids = files.select(file_batch_id("path").alias("batch_id"), "path", "length")
    # The register is there, empty, before the first epoch reads it.
    spark.createDataFrame([], REGISTER_SCHEMA).write.mode("append").partitionBy("epoch").parquet(register_path)
    return _writer(ids, checkpoint).foreachBatch(lambda batch, epoch: register_batches(batch, epoch, register_path)).start()


ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
#: A commit writes the changes, not the whole store; rows are not counted, which would read
#: a key before each write; the four stores of a join's partition are one database; the
#: databases of an executor share a cache, whose filters a store of its own size (8 MB)
#: would not hold.
JOIN_STATE = {**ROCKSDB, "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
              "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
              "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
              "spark.sql.streaming.join.stateFormatVersion": "3"}


def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB (``transformWithState`` needs it);
    the session's own setting comes back afterwards."""
    return settings(spark, ROCKSDB)


def state_partitions(spark: SparkSession) -> str:
    """Shuffle partitions of a stateful stream: two a core, at most the session's. Every
    micro-batch opens and commits the stores of all of them, whether they hold rows or not;
    the first run's number stays in the checkpoint."""
    return str(min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(8, 2 * spark.sparkContext.defaultParallelism)))


def truth_join_stream(spark: SparkSession, pred_dir: str, truth_dir: str, sink_path: str, checkpoint: str,
                      pred_schema: T.StructType, truth_schema: T.StructType, delay_days: int = 7, outcomes: bool = False):
    """STR-03: predictions now, ground truth up to ``delay_days`` later: stream-stream join
    on (Store, Date) with watermarks on both sides and a time-range condition, so join state
    is dropped once truth can no longer arrive. The watermark exceeds the label delay.

    With ``outcomes`` every row leaves exactly once, as an outer join: ``matched``; a
    prediction whose truth did not come in time as ``no_truth``; truth that came too late,
    or without a prediction, as ``unmatched_truth``. Unmatched rows come out when both
    clocks have passed their time; rows without a store only move the clocks. The rows in
    state are kept in RocksDB, on disk, not on the heap (``JOIN_STATE``)."""
    p = (spark.readStream.schema(pred_schema).parquet(pred_dir)
         .withColumn("pred_ts", F.col("pred_ts").cast("timestamp")).withWatermark("pred_ts", f"{delay_days + 1} days")
         .filter(after_watermark(F.col("Store").isNotNull(), "pred_ts")).alias("p"))
    t = (spark.readStream.schema(truth_schema).parquet(truth_dir)
         .withColumn("truth_ts", F.col("truth_ts").cast("timestamp")).withWatermark("truth_ts", f"{delay_days + 1} days")
         .filter(after_watermark(F.col("Store").isNotNull(), "truth_ts")).alias("t"))
    cond = ((F.col("p.Store") == F.col("t.Store")) & (F.col("p.Date") == F.col("t.Date"))
            & (F.col("t.truth_ts") >= F.col("p.pred_ts"))
            & (F.col("t.truth_ts") <= F.col("p.pred_ts") + F.expr(f"INTERVAL {delay_days} DAYS")))
    if outcomes:
        outcome = (F.when(F.col("t.Store").isNull(), "no_truth").when(F.col("p.Store").isNull(), "unmatched_truth")
                   .otherwise("matched"))
        j = p.join(t, cond, "full_outer").select(
            F.coalesce("p.Store", "t.Store").alias("Store"), F.coalesce("p.Date", "t.Date").alias("Date"),
            "p.prediction", "t.Sales", outcome.alias("outcome"))
    else:
        j = p.join(t, cond, "inner").select("p.Store", "p.Date", "p.prediction", "t.Sales")
    with settings(spark, {**JOIN_STATE, "spark.sql.shuffle.partitions": state_partitions(spark)}):
        return _writer(j, checkpoint).format("parquet").option("path", sink_path).outputMode("append").start()


def rolling_metrics_stream(spark: SparkSession, source_dir: str, sink_path: str, checkpoint: str,
                           schema: T.StructType, days: int = 7, min_samples: int = 1, y: str = "Sales",
                           yhat: str = "prediction", lateness: str = "8 days"):
    """STR-04: sliding 7-day windows (1-day slide) over event time; append mode emits a
    window once it can no longer change. The watermark allows rows that are as late as
    truth may be (STR-03). A row without values only moves the clock: such a closing row,
    dated beyond window and lateness, makes the last windows come out. A window [T-6, T+1)
    is reported as window_end T only when day T has rows (the batch twin reports distinct
    dates only, T17)."""
    s = (spark.readStream.schema(schema).parquet(source_dir)
         .withColumn("ts", F.col("Date").cast("timestamp")).withWatermark("ts", lateness)
         .filter(after_watermark(F.col(y).isNotNull() & F.col(yhat).isNotNull())))
    e = F.col(y) - F.col(yhat)
    agg = s.groupBy(F.window("ts", f"{days} days", "1 day")).agg(
        F.sum(e * e).alias("s2"), F.sum(F.abs(e)).alias("sa"), F.sum(e).alias("s1"),
        F.count(F.lit(1)).alias("n_samples"), F.max("Date").alias("last_day"))
    end_day = F.date_sub(F.col("window.end").cast("date"), 1)
    out = agg.filter((F.col("last_day") == end_day) & (F.col("n_samples") >= min_samples)).select(
        F.date_sub(end_day, days).alias("window_start"), end_day.alias("window_end"),
        F.sqrt(F.col("s2") / F.col("n_samples")).alias("rmse"), (F.col("sa") / F.col("n_samples")).alias("mae"),
        (F.col("s1") / F.col("n_samples")).alias("bias"), "n_samples")
    return _writer(out, checkpoint).format("parquet").option("path", sink_path).outputMode("append").start()


STATE_OUT = T.StructType([T.StructField("entity", T.LongType()), T.StructField("history", T.ArrayType(T.DoubleType())),
                          T.StructField("appended", T.LongType())])
HISTORY_ROW = T.StructType([T.StructField("day", T.IntegerType()), T.StructField("y", T.DoubleType())])


class HistoryProcessor(StatefulProcessor):
    """The last n values of an entity by date, in a list state that expires after
    ``ttl_ms`` without an update (0: never)."""

    def __init__(self, n: int, ttl_ms: int):
        self.n, self.ttl_ms = n, ttl_ms

    def init(self, handle) -> None:
        self.history = handle.getListState("history", HISTORY_ROW, self.ttl_ms or None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values(["day", "delivered"], kind="stable")[["day", "y"]]
        old = pd.DataFrame([tuple(r) for r in self.history.get()], columns=["day", "y"])
        # Re-delivered truth replaces: of a date the newest row stays.
        both = pd.concat([old, new]) if len(old) else new
        kept = both.drop_duplicates("day", keep="last").sort_values("day").tail(self.n)
        self.history.put(list(zip(kept["day"].astype(int).tolist(), kept["y"].astype(float).tolist())))
        yield pd.DataFrame({"entity": [int(key[0])], "history": [kept["y"].tolist()], "appended": [len(new)]})

    def close(self) -> None:
        pass


def entity_state_stream(spark: SparkSession, source_dir: str, sink_path: str, checkpoint: str,
                        schema: T.StructType = SALES_SCHEMA, roles: Roles = Roles(), n: int = STATE_LENGTH,
                        idle_days: int = 0, max_files: int | None = None):
    """STR-05: per-entity bounded history (last n values, keyed by date) by
    ``transformWithState`` in RocksDB; an entity idle for ``idle_days`` expires. Each
    micro-batch emits the updated histories, written per epoch (idempotent on replay). Of
    several rows for a date the one in the newest file counts."""
    reader = spark.readStream.schema(schema).option("header", True)
    reader = reader.option("maxFilesPerTrigger", max_files) if max_files else reader
    s = (reader.csv(source_dir)
         .select(F.col(roles.entity).cast("long").alias("entity"), F.unix_date(F.col(roles.time)).alias("day"),
                 F.col(roles.target).cast("double").alias("y"), F.col("_metadata.file_modification_time").alias("delivered"))
         .dropna())
    out = s.groupBy("entity").transformWithStateInPandas(
        HistoryProcessor(n, idle_days * 86_400_000), STATE_OUT, "Update", "ProcessingTime" if idle_days else "None")

    def per_batch(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(sink_path)

    with rocksdb_state(spark):
        return _writer(out, checkpoint).outputMode("update").foreachBatch(per_batch).start()


SLO_OUT = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("minute", T.TimestampType()), T.StructField("requests", T.LongType()),
    T.StructField("server_errors", T.LongType()), T.StructField("error_ratio", T.DoubleType()),
    T.StructField("p95_seconds", T.DoubleType()), T.StructField("error_condition", T.BooleanType()),
    T.StructField("latency_condition", T.BooleanType()), T.StructField("error_firing", T.BooleanType()),
    T.StructField("latency_firing", T.BooleanType())])


class SloProcessor(StatefulProcessor):
    """The rules of AGG-25 for one path over its closed minutes, which arrive in order from
    one micro-batch to the next. State: counts of the minutes that the next window still
    sees, conditions of the minutes that the next hold time still sees."""

    def __init__(self, window: int, hold: int, min_requests: int, error_ratio: float, p95_seconds: float,
                 buckets: Sequence[float]):
        self.window, self.hold, self.min_requests = window, hold, min_requests
        self.error_ratio, self.p95_seconds = error_ratio, p95_seconds
        self.bounds = np.array([0.0, *buckets])

    def init(self, handle) -> None:
        self.tail = handle.getValueState("tail", T.StructType([
            T.StructField("minute", T.LongType()), T.StructField("counts", T.ArrayType(T.ArrayType(T.LongType()))),
            T.StructField("conditions", T.ArrayType(T.ArrayType(T.LongType())))]))

    def _p95(self, n: np.ndarray, cumulative: np.ndarray) -> np.ndarray:
        """Interpolated inside the first bucket whose running count reaches the rank; the
        last finite bound beyond it."""
        rank = n * 0.95
        first = np.argmax(cumulative >= rank[:, None], axis=1)
        rows = np.arange(len(n))
        below = np.where(first > 0, cumulative[rows, first - 1], 0)
        inside = np.minimum(first, len(self.bounds) - 2)
        low, high = self.bounds[inside], self.bounds[inside + 1]
        with np.errstate(divide="ignore", invalid="ignore"):
            value = low + (high - low) * (rank - below) / (cumulative[rows, first] - below)
        value = np.where(first == len(self.bounds) - 1, self.bounds[-1], value)
        return np.where(n > 0, value, np.nan)

    def _rolled(self, rows: np.ndarray, width: int) -> np.ndarray:
        """Sum of each row and the width - 1 rows before it."""
        total = np.concatenate([np.zeros((1, rows.shape[1]), rows.dtype), np.cumsum(rows, axis=0)])
        at = np.arange(1, len(rows) + 1)
        return total[at] - total[np.maximum(at - width, 0)]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values("minute")
        width = 2 + len(self.bounds)
        if self.tail.exists():
            last, counts, conditions = self.tail.get()
            counts = np.array(counts, np.int64).reshape(-1, width)
            conditions = np.array(conditions, np.int64).reshape(-1, 2)
        else:
            last = int(new["minute"].iloc[0]) - 1
            counts, conditions = np.zeros((0, width), np.int64), np.zeros((0, 2), np.int64)
        # The minutes up to the newest one, those without requests too.
        minutes = np.arange(last + 1, int(new["minute"].iloc[-1]) + 1)
        fresh = np.zeros((len(minutes), width), np.int64)
        fresh[new["minute"].to_numpy() - last - 1] = np.array(new["counts"].tolist(), np.int64)
        seen = len(counts)
        counts = np.concatenate([counts, fresh])
        rolled = self._rolled(counts, self.window)[seen:]
        n, errors, cumulative = rolled[:, 0], rolled[:, 1], rolled[:, 2:]
        ratio, p95 = errors / np.maximum(n, 1), self._p95(n, cumulative)
        busy = n >= self.min_requests
        met = np.stack([(ratio > self.error_ratio) & busy, (p95 > self.p95_seconds) & busy], axis=1)
        held = len(conditions)
        conditions = np.concatenate([conditions, met.astype(np.int64)])
        # A path that has been seen for less than the hold time fires if it always held.
        need = np.minimum(np.arange(1, len(conditions) + 1), self.hold + 1)[held:]
        firing = self._rolled(conditions, self.hold + 1)[held:] == need[:, None]
        self.tail.update((int(minutes[-1]), counts[-(self.window - 1):].tolist(), conditions[-self.hold:].tolist()))
        yield pd.DataFrame({
            "path": key[0], "minute": pd.to_datetime(minutes * 60, unit="s"), "requests": n, "server_errors": errors,
            "error_ratio": ratio, "p95_seconds": p95,
            "error_condition": met[:, 0], "latency_condition": met[:, 1],
            "error_firing": firing[:, 0], "latency_firing": firing[:, 1]})

    def close(self) -> None:
        pass


def slo_stream(spark: SparkSession, source_dir: str, sink_path: str, checkpoint: str, schema: T.StructType,
               path: str = "/predict", lateness: str = "10 minutes", window_minutes: int = 10, hold_minutes: int = 5,
               min_requests: int = 20, error_ratio: float = 0.01, p95_seconds: float = 1.0,
               buckets: Sequence[float] = LATENCY_BUCKETS_SECONDS):
    """STR-06: the SLO rules of AGG-25 live, two chained stateful operators: requests are
    counted per closed minute (5xx, cumulative latency buckets), then ``transformWithState``
    rolls the minutes of a path into 10-minute windows, histogram p95 and hold times.
    Rows without a path only move the clock: such a closing row lets the last minutes out.
    Rows later than the watermark are dropped by design."""
    s = (spark.readStream.schema(schema).parquet(source_dir).withColumn("ts", F.col("ts").cast("timestamp"))
         .withWatermark("ts", lateness).filter(after_watermark(F.col("path") == path)))
    cumulative = [F.count_if(F.col("latency_seconds") <= x) for x in buckets]
    per = s.groupBy(F.window("ts", "1 minute"), "path").agg(F.array(
        F.count(F.lit(1)), F.count_if(F.col("status_code") >= 500), *cumulative, F.count(F.lit(1))).alias("counts"))
    per = per.select("path", (F.unix_timestamp(F.col("window.start")) / 60).cast("long").alias("minute"), "counts")
    rules = SloProcessor(window_minutes, hold_minutes, min_requests, error_ratio, p95_seconds, buckets)
    out = per.groupBy("path").transformWithStateInPandas(rules, SLO_OUT, "Append", "None")
    with rocksdb_state(spark):
        return _writer(out, checkpoint).format("parquet").option("path", sink_path).outputMode("append").start()


def request_counts_stream(spark: SparkSession, source_dir: str, sink_path: str, checkpoint: str, schema: T.StructType,
                          window_seconds: int = 900, lateness: str = "10 minutes"):
    """STR-06: closed 900-second windows of the request log as counts per status code, path
    and latency (rounded to 0.01 ms), from which ``serving.summary_of_counts`` gives the
    exact summary of AGG-23. Rows without a path only move the clock."""
    s = (spark.readStream.schema(schema).parquet(source_dir).withColumn("ts", F.col("ts").cast("timestamp"))
         .withWatermark("ts", lateness).filter(after_watermark(F.col("path").isNotNull()))
         .withColumn("latency_ms", F.round(F.col("latency_seconds") * 1000.0, 2)))
    per = s.groupBy(F.window("ts", f"{window_seconds} seconds"), "status_code", "path", "latency_ms").agg(F.count(F.lit(1)).alias("n"))
    out = per.select(F.col("window.start").alias("window_start"), "status_code", "path", "latency_ms", "n")
    return _writer(out, checkpoint).format("parquet").option("path", sink_path).outputMode("append").start()


def log_scored(batch: DataFrame, epoch: int, scorer: Scorer, sink_path: str, environment: str,
               received_col: str = "received_on") -> None:
    """STR-07: score one micro-batch and write it as the partitions (epoch, prediction_date),
    the date being that of the request's arrival. The partitions of an epoch are overwritten,
    and dates and ids depend on the rows alone: an epoch that runs again leaves the same log."""
    out = scorer.score(batch).withColumns({
        "environment": F.lit(environment), "epoch": F.lit(epoch).cast("long"),
        "prediction_date": F.date_format(received_col, "yyyy-MM-dd")})
    (out.repartition("prediction_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd")
     .partitionBy("epoch", "prediction_date").parquet(sink_path))


def score_stream(spark: SparkSession, source_dir: str, scorer: Scorer, sink_path: str, checkpoint: str,
                 schema: T.StructType, environment: str = "dev", files_per_batch: int | None = None):
    """STR-07: a stream of requests scored with a fitted model by the function that bulk
    scoring uses, logged to a date-partitioned parquet sink. A request's rows must lie in
    one file, since a micro-batch takes whole files. ``files_per_batch`` bounds a batch."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (_writer(reader.parquet(source_dir), checkpoint)
            .foreachBatch(lambda batch, epoch: log_scored(batch, epoch, scorer, sink_path, environment)).start())
