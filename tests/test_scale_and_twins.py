"""Plan shape, skew, leakage, split invariants and batch/stream equality."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelcast.plans.registry import Inputs
from panelcast.schema import Roles
from tests.conftest import SF_SMALL

R = Roles()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_plan_single_exchange_by_entity(spark):
    """Panel aggregate (two levels) + ONE exchange by Store for all windows."""
    from panelcast.operators.features import build_features
    from panelcast.operators.joins import join_dimension
    i = Inputs(spark, SF_SMALL)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(build_features(join_dimension(i.panel(), i.store(), "Store"), R))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    hash_exchanges = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln]
    assert len(hash_exchanges) == 3, plan
    assert sum("hashpartitioning(Store" in ln and ", Date" not in ln for ln in hash_exchanges) == 1
    assert "BroadcastHashJoin" in plan
    # The scan reads the panel's columns only, and no session-wide copy of it.
    assert "Scan ExistingRDD" not in plan and "l_comment" not in plan


def test_scan_prunes_columns(spark):
    i = Inputs(spark, SF_SMALL)
    plan = _plan(i.panel())
    assert "l_partkey" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_holdout_filter_pushed_to_scan(spark):
    from panelcast.operators.splits import holdout_split
    ev = Inputs(spark, SF_SMALL).t.orders.withColumn("Date", F.col("o_orderdate").cast("date"))
    _, val = holdout_split(ev, R, 14)
    plan = _plan(val)
    assert "PushedFilters: [IsNotNull(o_orderdate)" in plan or "o_orderdate" in plan.split("PushedFilters")[1][:200]


def _brute_ks(a, b):
    xs = sorted(set(a) | set(b))
    n, m = len(a), len(b)
    best = 0.0
    for x in xs:
        fa = sum(1 for v in a if v <= x) / n
        fb = sum(1 for v in b if v <= x) / m
        best = max(best, abs(fa - fb))
    return best


def test_ks_skewed_values_match_brute_force(spark):
    """A third of the rows hold one value; slices are range partitions."""
    rnd = random.Random(7)
    ref = [5.0] * 300 + [rnd.uniform(0, 10) for _ in range(600)]
    cur = [5.0] * 100 + [rnd.uniform(1, 12) for _ in range(800)]
    from panelcast.operators.drift import numeric_drift
    r = spark.createDataFrame([(v,) for v in ref], "x double")
    c = spark.createDataFrame([(v,) for v in cur], "x double")
    out = numeric_drift(r, c, ["x"]).first()
    assert out["score"] == pytest.approx(_brute_ks(ref, cur), abs=1e-12)
    assert out["reference_n"] == 900 and out["current_n"] == 900


def test_ks_ties_across_samples(spark):
    from panelcast.operators.drift import ks_statistic, long_samples
    a = [1.0, 2.0, 2.0, 3.0]
    b = [2.0, 2.0, 2.0, 4.0]
    r = spark.createDataFrame([(v,) for v in a], "x double")
    c = spark.createDataFrame([(v,) for v in b], "x double")
    d = ks_statistic(long_samples(r, c, ["x"]), ["feature"], slices=3).first()["score"]
    assert d == pytest.approx(_brute_ks(a, b))


def test_no_leakage_features_at_t(spark):
    """Features at T do not change when rows after T are deleted."""
    from panelcast.operators.features import add_lag_features
    p = Inputs(spark, SF_SMALL).panel()
    lo, hi = p.agg(F.min("Date"), F.max("Date")).first()
    cut = lo + (hi - lo) / 2
    full = add_lag_features(p).filter(F.col("Date") <= cut)
    trunc = add_lag_features(p.filter(F.col("Date") <= cut))
    assert full.exceptAll(trunc).count() == 0 and trunc.exceptAll(full).count() == 0


def test_splits_disjoint_and_exhaustive(spark):
    from panelcast.operators.splits import holdout_split, split_90_10
    p = Inputs(spark, SF_SMALL).panel()
    for a, b in (holdout_split(p, R, 14), split_90_10(p, R)):
        assert a.count() + b.count() == p.count()
        assert a.join(b, ["Store", "Date"], "inner").count() == 0


def test_stream_rolling_metrics_equal_batch_for_closed_windows(spark):
    from panelcast.plans import q_stream
    from panelcast.operators.metrics import rolling_metrics
    from panelcast.plans.registry import rounded
    s = q_stream.str_04_sliding_window_metrics(spark, SF_SMALL)   # rounded to 4 places
    b = rounded(rolling_metrics(Inputs(spark, SF_SMALL).predictions()))
    cols = ["window_start", "window_end", "n_samples"]
    joined = s.join(b, ["window_end"], "inner")
    assert joined.count() == s.count() and s.count() > 0
    assert joined.filter((F.abs(s["rmse"] - b["rmse"]) > 1.01e-4) | (s["n_samples"] != b["n_samples"])).count() == 0


def test_stream_state_equals_batch_state(spark):
    from panelcast.plans import q_stream
    from panelcast.operators.state import create_state
    s = q_stream.str_05_entity_history_state(spark, SF_SMALL)
    b = create_state(Inputs(spark, SF_SMALL).panel(), R, 28)
    assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0


def test_stream_truth_join_equals_batch_join(spark):
    from panelcast.plans import q_stream
    from panelcast.operators.joins import join_predictions_truth
    i = Inputs(spark, SF_SMALL)
    s = q_stream.str_03_delayed_truth_join(spark, SF_SMALL)
    b = join_predictions_truth(i.predictions().select("Store", "Date", "prediction"), i.panel().select("Store", "Date", "Sales"))
    assert s.select("Store", "Date", "prediction", "Sales").exceptAll(b.select("Store", "Date", "prediction", "Sales")).count() == 0
    assert s.count() == b.count()


def test_exactly_once_batches(spark):
    from panelcast.plans import q_stream
    out = q_stream.str_02_exactly_once_batches(spark, SF_SMALL)
    assert out.count() == out.select("batch_id").distinct().count() > 0


def test_stream_ingest_equals_batch_routing(spark):
    """STR-01 vs PRJ-06 on the same batch files: same accepted / quarantined rows per file."""
    from panelcast.operators.validate import TRAIN_RULES, route_batches
    from panelcast.plans import q_stream
    from panelcast.sources.files import read_batches, scratch_dir
    from panelcast.streaming import streams as St
    from pyspark.sql import types as T
    base = scratch_dir(spark, "twin01")
    src = q_stream._raw_csv(spark, SF_SMALL, base)
    q_stream._run(St.ingest_stream(spark, src, f"{base}/good", f"{base}/bad", f"{base}/ck"))
    sch = T.StructType([*q_stream.SALES_SCHEMA.fields, T.StructField("file", T.StringType()),
                        T.StructField("epoch", T.IntegerType())])
    s_good = spark.read.schema(sch).parquet(f"{base}/good").drop("epoch")
    s_bad = spark.read.schema(sch).parquet(f"{base}/bad").drop("epoch")
    batch = read_batches(spark, src).drop("file_mtime")
    b_good, b_bad, _ = route_batches(batch, TRAIN_RULES)
    assert s_good.count() == b_good.count() and s_bad.count() == b_bad.count()
    assert s_bad.exceptAll(b_bad.select(*s_bad.columns)).count() == 0


def test_stream_scoring_equals_bulk_scoring(spark):
    """STR-07 vs MLD-10: all requests, over deliveries with restarts and a repeated epoch."""
    from panelcast.plans import q_stream
    rows = q_stream.str_07_prediction_log_sink(spark, SF_SMALL).agg(
        F.count("*"), F.count_if(F.col("copies") == 1), F.count_if("as_bulk")).first()
    n = Inputs(spark, SF_SMALL).panel().count()
    assert tuple(rows) == (n, n, n)


def test_costly_rows_are_spread_and_the_panel_is_read_back(spark):
    from panelcast.plans.q_misc import udf_06_statistical_tails
    from panelcast.plans.registry import Inputs
    tails = udf_06_statistical_tails(spark, "/root/testdata/sf0.001")
    assert tails.rdd.getNumPartitions() == 8 * spark.sparkContext.defaultParallelism
    i = Inputs(spark, "/root/testdata/sf0.001")
    plain = i.panel()
    kept = i.keep_panel().panel()
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    assert i.keep_panel().panel() is kept and kept.dtypes == plain.dtypes
    assert kept.exceptAll(plain).count() == plain.exceptAll(kept).count() == 0
