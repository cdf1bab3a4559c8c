"""Stream operators: replayed epochs, late and re-delivered rows, state across micro-batches."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.operators.serving import LATENCY_BUCKETS_SECONDS, slo_breaches
from panelcast.plans.q_stream import _run
from panelcast.sources.files import scratch_dir
from panelcast.streaming import streams as St


class Held:
    """A value or list state in memory."""

    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value or ()

    def update(self, value):
        self.value = value

    put = update


class Handle:
    def __init__(self):
        self.states = {}

    def getValueState(self, name, schema, ttl=None):
        return self.states.setdefault(name, Held())

    getListState = getValueState


def test_register_is_permanent_and_epochs_replay(spark):
    base = scratch_dir(spark, "register")
    spark.createDataFrame([], St.REGISTER_SCHEMA).write.partitionBy("epoch").parquet(base)

    def deliver(epoch, *ids):
        rows = [(i, f"p{k}", 1) for k, i in enumerate(ids)]
        St.register_batches(spark.createDataFrame(rows, "batch_id string, path string, length long"), epoch, base)
        found = spark.read.schema(St.REGISTER_SCHEMA).parquet(base).collect()
        return sorted((r.batch_id, r.epoch) for r in found)

    assert deliver(0, "a", "b", "a") == [("a", 0), ("b", 0)]
    assert deliver(1, "b", "c") == [("a", 0), ("b", 0), ("c", 1)]
    # The epoch runs again after a failure; later the first bytes come again.
    assert deliver(1, "b", "c") == [("a", 0), ("b", 0), ("c", 1)]
    assert deliver(400, "a", "d") == [("a", 0), ("b", 0), ("c", 1), ("d", 400)]


def test_history_replaces_redelivered_days_and_keeps_the_last():
    handle, store = Handle(), St.HistoryProcessor(3, 0)
    store.init(handle)

    def deliver(*rows):
        frame = pd.DataFrame(rows, columns=["day", "y", "delivered"])
        return next(store.handleInputRows((7,), iter([frame]), None)).iloc[0].tolist()

    assert deliver((5, 5.0, 1), (3, 3.0, 1)) == [7, [3.0, 5.0], 2]
    # Day 5 again, twice in one micro-batch: the row of the newer file counts.
    assert deliver((5, 50.0, 3), (5, 51.0, 2), (6, 6.0, 2)) == [7, [3.0, 50.0, 6.0], 3]
    assert deliver((1, 1.0, 4), (9, 9.0, 4)) == [7, [50.0, 6.0, 9.0], 2]


def minute_counts(events):
    """(minute, counts) rows as the first operator of the SLO stream emits them."""
    out = {}
    for minute, status, latency in events:
        row = out.setdefault(minute, np.zeros(3 + len(LATENCY_BUCKETS_SECONDS), np.int64))
        row += np.array([1, status >= 500, *[latency <= b for b in LATENCY_BUCKETS_SECONDS], 1], np.int64)
    return pd.DataFrame({"minute": list(out), "counts": [r.tolist() for r in out.values()]})


@pytest.mark.parametrize("cuts", [[], [7], [3, 4, 5, 30, 31, 60]])
def test_slo_state_equals_the_batch_rules_for_any_micro_batches(spark, cuts):
    rng = np.random.default_rng(4)
    events = []
    for minute in [*range(0, 25), *range(40, 55), 90, 91]:
        bad, slow = 10 <= minute < 20, minute >= 42
        for _ in range(int(rng.integers(3, 9))):
            events.append((28_000_000 + minute, 500 if bad and rng.random() < 0.3 else 200,
                           float(rng.choice([2.0, 7.0]) if slow else rng.choice([0.004, 0.3, 0.9]))))
    rules = St.SloProcessor(10, 5, 20, 0.01, 1.0, LATENCY_BUCKETS_SECONDS)
    rules.init(Handle())
    got, bounds = [], [0, *cuts, 1000]
    for lo, hi in zip(bounds, bounds[1:]):
        part = [e for e in events if lo <= e[0] - 28_000_000 < hi]
        if part:
            got.append(next(rules.handleInputRows(("/predict",), iter([minute_counts(part)]), None)))
    got = pd.concat(got).drop(columns="path")
    log = spark.createDataFrame([(m * 60 + 1, "/predict", s, x) for m, s, x in events],
                                "t long, path string, status_code int, latency_seconds double")
    want = slo_breaches(log.withColumn("ts", F.timestamp_seconds("t"))).orderBy("minute").toPandas()
    assert got["error_firing"].any() and got["latency_firing"].any() and (got["requests"] == 0).any()
    pd.testing.assert_frame_equal(got.reset_index(drop=True).astype(want.dtypes.to_dict()), want, check_exact=False, rtol=1e-12)


def test_rows_a_week_late_count_and_closing_rows_do_not(spark):
    base = scratch_dir(spark, "late-week")

    def deliver(*rows):
        df = spark.createDataFrame([(1, d, y, p) for d, y, p in rows], "Store long, d string, Sales double, prediction double")
        df = df.select("Store", F.to_date("d").alias("Date"), "Sales", "prediction")
        df.coalesce(1).write.mode("append").parquet(f"{base}/src")
        _run(St.rolling_metrics_stream(spark, f"{base}/src", f"{base}/out", f"{base}/ck", df.schema))


    deliver(("2024-01-01", 3.0, 1.0), ("2024-01-10", 5.0, 5.0))
    deliver(("2024-01-03", 8.0, 4.0), ("2024-01-11", None, 1.0))  # seven days behind the newest row
    deliver(("2024-03-01", None, None))
    rows = spark.read.parquet(f"{base}/out").orderBy("window_end").collect()
    assert [(str(r.window_end), r.n_samples, r.bias) for r in rows] == [
        ("2024-01-01", 1, 2.0), ("2024-01-03", 2, 3.0), ("2024-01-10", 1, 0.0)]


def test_state_provider_setting_comes_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with St.rocksdb_state(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key, None) == before


def test_truth_join_in_several_deliveries(spark, monkeypatch):
    from panelcast.plans import q_stream
    from tests.conftest import SF_SMALL
    one = {tuple(r) for r in q_stream.str_03_delayed_truth_join(spark, SF_SMALL).collect()}
    seen, plain = [], q_stream.St.truth_join_stream

    def counted(*a, **k):
        seen.append(spark.conf.get("spark.sql.streaming.stateStore.providerClass"))
        return plain(*a, **k)

    monkeypatch.setattr(q_stream.St, "truth_join_stream", counted)
    monkeypatch.setattr(q_stream, "DELIVERY_ROWS", 2500)
    rows = [tuple(r) for r in q_stream.str_03_delayed_truth_join(spark, SF_SMALL).collect()]
    assert len(seen) > 1 and len(rows) == len(one) and set(rows) == one


def test_day_ranges(spark):
    import datetime as dt
    from panelcast.plans.q_stream import day_ranges
    day = [dt.date(2020, 1, k) for k in (1, 2, 3, 5)]
    df = spark.createDataFrame([(d,) for d, n in zip(day, (2, 1, 7, 1)) for _ in range(n)] + [(None,)], "Date date")
    assert day_ranges(df, 3) == [(day[0], day[1]), (day[2], day[2]), (day[3], day[3])]
    assert day_ranges(df.limit(0), 3) == []


def test_batch_files_are_hashed_without_being_held(spark, tmp_path):
    import gzip
    import hashlib
    from panelcast.sources.files import open_file
    src = tmp_path / "in"
    src.mkdir()
    given = {"a b%20.csv": b"x" * 3_000_000, "c.csv.gz": gzip.compress(b"y" * 100), "d.csv": b"", "again.csv": b"x" * 3_000_000}
    for name, content in given.items():
        (src / name).write_bytes(content)
    key = "spark.sql.sources.binaryFile.maxLength"  # longer files fail where their content is read
    spark.conf.set(key, "10")
    try:
        q = St.dedup_batches_stream(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ck"))
        q.awaitTermination()
        assert q.exception() is None
    finally:
        spark.conf.unset(key)
    ids = [r.batch_id for r in spark.read.schema(St.REGISTER_SCHEMA).parquet(str(tmp_path / "out")).collect()]
    assert sorted(ids) == sorted({"gt-" + hashlib.sha256(c).hexdigest()[:20] for c in given.values() if c})  # Spark skips empty files
    assert open_file(str(src / "d.csv")).read() == b""


def test_join_state_is_small_and_settings_come_back(spark):
    with St.settings(spark, {"spark.sql.shuffle.partitions": "200"}):
        assert int(St.state_partitions(spark)) == max(8, 2 * spark.sparkContext.defaultParallelism)
    keys = [*St.JOIN_STATE, "spark.sql.shuffle.partitions"]
    before, seen, plain = [spark.conf.get(k, None) for k in keys], [], St._writer

    def writer(df, checkpoint):
        seen.append([spark.conf.get(k, None) for k in keys])
        return plain(df, checkpoint)

    St._writer = writer
    try:
        from panelcast.plans import q_stream
        from tests.conftest import SF_SMALL
        q_stream.str_03_join_outcomes(spark, SF_SMALL).count()
    finally:
        St._writer = plain
    assert len(seen) == 4 and all(s[:-1] == list(St.JOIN_STATE.values()) for s in seen)
    assert [spark.conf.get(k, None) for k in keys] == before
