"""Unit tests from the literal fixtures (small frames, exact values)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from panelcast.schema import Roles

D = dt.date


def test_win01_lags_count_rows(spark):
    from panelcast.operators.features import add_lags
    df = spark.createDataFrame([(1, D(2026, 3, 1), 10.0), (1, D(2026, 3, 2), 20.0)], "Store long, Date date, Sales double")
    out = add_lags(df, Roles(), [1]).orderBy("Date").collect()
    assert [r["sales_lag_1"] for r in out] == [0.0, 10.0]


def test_win01_gap_days_are_rows_not_days(spark):
    from panelcast.operators.features import add_lags
    df = spark.createDataFrame([(1, D(2026, 3, 1), 10.0), (1, D(2026, 3, 9), 20.0)], "Store long, Date date, Sales double")
    assert [r["sales_lag_1"] for r in add_lags(df, Roles(), [1]).orderBy("Date").collect()] == [0.0, 10.0]


def test_win02_rolling_needs_w_non_null(spark):
    from panelcast.operators.features import add_rolling_means
    rows = [(1, D(2026, 3, d), float(d) if d != 2 else None) for d in range(1, 6)]
    df = spark.createDataFrame(rows, "Store long, Date date, Sales double")
    out = {r["Date"].day: r["sales_rolling_mean_2"] for r in add_rolling_means(df, Roles(), [2]).collect()}
    # day 4 sees days 2,3 (day 2 null) -> 0; day 5 sees 3,4 -> 3.5
    assert out[4] == 0.0 and out[5] == 3.5


def test_renamed_roles(spark):
    from panelcast.operators.features import build_features
    rows = [(7, D(2026, 3, d), float(10 * d), "x") for d in range(1, 9)]
    df = spark.createDataFrame(rows, "entity_id long, ds date, y double, category_col string")
    out = build_features(df, Roles(entity="entity_id", time="ds", target="y", promo="nope"), lags=[1], windows=[7])
    assert "y_lag_1" in out.columns and "y_rolling_mean_7" in out.columns
    last = out.orderBy(F.col("ds").desc()).first()
    assert last["y_lag_1"] == 70.0 and last["y_rolling_mean_7"] == pytest.approx(40.0)


def test_inference_mode_placeholders(spark):
    from panelcast.operators.features import build_features
    df = spark.createDataFrame([(1, D(2026, 3, 1), 1)], "Store long, Date date, Promo int")
    out = build_features(df, Roles()).first()
    assert out["sales_lag_1"] == 0.0 and out["sales_rolling_mean_28"] == 0.0


def test_unknown_step_is_error(spark):
    from panelcast.operators.features import build_features
    df = spark.createDataFrame([(1, D(2026, 3, 1), 1.0)], "Store long, Date date, Sales double")
    with pytest.raises(ValueError):
        build_features(df, Roles(), steps=["sort", "bogus"])


def test_fun02_competition_age(spark):
    from panelcast.functions.scalar import competition_age
    df = spark.createDataFrame([(2026, 3, 2025, 1), (2020, 1, 2025, 1), (2026, 3, None, None)],
                               "year int, month int, CompetitionOpenSinceYear int, CompetitionOpenSinceMonth int")
    assert [r[0] for r in df.select(competition_age()).collect()] == [14.0, 0.0, 0.0]


def test_fun03_promo2_age_null_stays_null(spark):
    from panelcast.functions.scalar import promo2_age
    df = spark.createDataFrame([(2026, 10, 2025, 2), (2020, 1, 2025, 1), (2026, 3, None, None)],
                               "year int, WeekOfYear int, Promo2SinceYear int, Promo2SinceWeek int")
    assert [r[0] for r in df.select(promo2_age()).collect()] == [14.0, 0.0, None]


def test_iso_week_53(spark):
    from panelcast.functions.scalar import calendar_parts
    r = calendar_parts(spark.createDataFrame([(D(2021, 1, 3),)], "Date date")).first()
    assert r["WeekOfYear"] == 53 and r["DayOfWeek"] == 7


def test_win06_calendar_literal(spark):
    from panelcast.operators.calendar import build_known_calendar
    rows = list(zip([1] * 8, [D(2015, 4, d) for d in range(1, 9)], list("00a00a00"), [0, 1, 1, 1, 0, 0, 0, 0]))
    df = spark.createDataFrame(rows, "Store long, Date date, StateHoliday string, SchoolHoliday int")
    cal = {r["Date"].day: r for r in build_known_calendar(df).collect()}
    assert cal[2]["days_until_state_holiday"] == 1 and cal[2]["is_day_before_state_holiday"] == 1
    assert cal[2]["is_school_holiday_start"] == 1 and cal[2]["days_until_school_holiday_start"] == 0
    assert cal[4]["days_since_state_holiday"] == 1 and cal[4]["days_until_state_holiday"] == 2
    assert cal[4]["is_day_after_state_holiday"] == 1 and cal[4]["is_school_holiday_end"] == 1
    assert cal[4]["days_since_school_holiday_start"] == 2
    assert cal[1]["days_since_state_holiday"] == 31   # none before: max + 1


def test_calendar_strict_join_raises_on_missing_key(spark):
    from panelcast.operators.calendar import build_known_calendar, merge_calendar
    rows = [(1, D(2015, 4, d), "0", 0) for d in range(1, 4)]
    df = spark.createDataFrame(rows, "Store long, Date date, StateHoliday string, SchoolHoliday int")
    cal = build_known_calendar(df.filter(F.dayofmonth("Date") < 3))
    with pytest.raises(Exception):
        merge_calendar(df, cal, strict=True).collect()
    lenient = {r["Date"].day: r for r in merge_calendar(df, cal, strict=False).collect()}
    assert lenient[3]["days_until_state_holiday"] == 31 and lenient[3]["is_school_holiday_start"] == 0


def test_prj03_rejects_each_bad_value(spark):
    from panelcast.operators.validate import TRAIN_RULES, with_violations
    good = dict(Store=1, Date=D(2015, 7, 31), Sales=100.0, Customers=10, Open=1, Promo=1, StateHoliday="0",
                SchoolHoliday=1, DayOfWeek=5)
    bads = [dict(good, Sales=-1.0), dict(good, Open=5), dict(good, StateHoliday="Z"), dict(good, Store=0)]
    schema = "Store long, Date date, Sales double, Customers long, Open int, Promo int, StateHoliday string, SchoolHoliday int, DayOfWeek int"
    df = spark.createDataFrame([tuple(r.values()) for r in [good, *bads]], schema)
    v = [r["violations"] for r in with_violations(df, TRAIN_RULES).collect()]
    assert v[0] == [] and all(len(x) == 1 for x in v[1:])


def test_prj05_target_must_be_absent(spark):
    from panelcast.operators.validate import validate_inference
    df = spark.createDataFrame([(1, D(2015, 7, 31), 1.0)], "Store long, Date date, Sales double")
    with pytest.raises(ValueError):
        validate_inference(df)


def test_prj06_quarantine_whole_file(spark):
    from panelcast.operators.validate import TRAIN_RULES, route_batches
    schema = "file string, Store long, Date date, Sales double, Customers long, Open int, Promo int, StateHoliday string, SchoolHoliday int"
    rows = [("a", 1, D(2015, 7, 1), 1.0, 1, 1, 0, "0", 0), ("a", 1, D(2015, 7, 2), 2.0, 1, 1, 0, "0", 0),
            ("b", 2, D(2015, 7, 1), -99.0, 1, 1, 0, "0", 0), ("b", 2, D(2015, 7, 2), 5.0, 1, 1, 0, "0", 0)]
    acc, quar, verdict = route_batches(spark.createDataFrame(rows, schema), TRAIN_RULES)
    assert {r["file"] for r in acc.collect()} == {"a"} and quar.count() == 2


def test_win13_recency_tiers(spark):
    from panelcast.operators.splits import recency_weights
    last = D(2024, 6, 30)
    ages = [0, 30, 31, 60, 61, 120, 121]
    promo = [1, 0, 1, 0, 1, 1, 1]
    rows = [(last - dt.timedelta(days=a), p) for a, p in zip(ages, promo)]
    df = spark.createDataFrame(rows, "Date date, Promo int")
    out = recency_weights(df, Roles()).orderBy(F.col("Date").desc()).collect()
    assert [r["weight"] for r in out] == [10, 1, 5, 1, 2, 2, 1]


def test_prj16_scenario_uplift(spark):
    from panelcast.operators.scenario import apply_scenario
    df = spark.createDataFrame([(100.0, 0), (100.0, 1)], "Sales double, Promo int")
    out = apply_scenario(df, F.lit(59), start=46, duration=14, base_uplift=0.10, promo_uplift=0.35).collect()
    assert [r["Sales"] for r in out] == [110, 135] and out[0]["progress"] == 1.0


def test_agg05_promotion_metrics(spark):
    from panelcast.operators.metrics import promotion_metrics
    df = spark.createDataFrame([(100.0, 110.0, 1), (200.0, 190.0, 1), (100.0, 130.0, 0), (200.0, 170.0, 0)],
                               "Sales double, prediction double, Promo int")
    r = promotion_metrics(df).first()
    assert r["promo_rmse"] == pytest.approx(10) and r["non_promo_rmse"] == pytest.approx(30)
    assert r["overall_bias"] == pytest.approx(0) and r["promo_rows"] == 2 and r["non_promo_rows"] == 2


def test_agg01_metrics_and_empty_error(spark):
    from panelcast.operators.metrics import regression_metrics
    df = spark.createDataFrame([(10.0, 8.0), (20.0, 22.0), (30.0, 29.0)], "Sales double, prediction double")
    r = regression_metrics(df).first()
    assert r["n_samples"] == 3 and r["rmse"] == pytest.approx(math.sqrt(3)) and r["mae"] == pytest.approx(5 / 3)
    assert r["bias"] == pytest.approx(1 / 3)
    with pytest.raises(Exception):
        regression_metrics(df.filter("Sales < 0")).collect()


def test_agg02_zero_actuals(spark):
    from panelcast.operators.metrics import regression_metrics
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 2.0)], "Sales double, prediction double")
    r = regression_metrics(df, extended=True).first()
    assert r["wmape"] is None and r["rmspe"] is None


def test_set02_truth_rebuild_idempotent(spark):
    from panelcast.operators.dedup import union_keep_last
    s = "Store long, Date date, Sales double"
    b1 = spark.createDataFrame([(1, D(2026, 8, 11), 100.0), (1, D(2026, 8, 12), 100.0)], s)
    b2 = spark.createDataFrame([(1, D(2026, 8, 12), 110.0), (2, D(2026, 8, 12), 50.0)], s)
    once = union_keep_last([b1, b2], ["Store", "Date"])
    twice = union_keep_last([once, b1.limit(0), b2], ["Store", "Date"])
    got = {(r["Store"], r["Date"]): r["Sales"] for r in once.collect()}
    assert len(got) == 3 and got[(1, D(2026, 8, 12))] == 110.0
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def _metrics(spark, rows):
    return spark.createDataFrame(rows, "model string, overall_rmse double, promo_rmse double, non_promo_rmse double, "
                                       "overall_bias double, validation_rows long, promo_rows long, non_promo_rows long")


def test_dec01_accepts_and_rejects(spark):
    from panelcast.operators.decisions import promotion_decision
    cand = _metrics(spark, [("m", 950.0, 900.0, 980.0, 80.0, 5000, 2500, 2500)])
    champ = _metrics(spark, [("m", 1000.0, 1000.0, 1000.0, 100.0, 5000, 2500, 2500)])
    r = promotion_decision(cand, champ, ["model"]).first()
    assert r["accepted"] and r["reasons"] == [] and r["status"] == "ok"
    same = promotion_decision(champ, champ, ["model"]).first()
    assert not same["accepted"]                       # equal RMSE is rejected
    exact = _metrics(spark, [("m", 995.0, 1000.0, 1000.0, 100.0, 5000, 2500, 2500)])
    assert promotion_decision(exact, champ, ["model"]).first()["accepted"]   # exactly -0.5% accepted
    few = _metrics(spark, [("m", 950.0, 900.0, 980.0, 80.0, 10, 5, 5)])
    assert promotion_decision(few, champ, ["model"]).first()["status"] == "invalid"


SIG = ("dataset_version string, new_training_rows long, minimum_training_rows long, data_quality_ok boolean, "
       "performance_degraded boolean, feature_drift_persistent boolean, cooldown_active boolean, budget_available boolean, "
       "batch_ids array<string>, scheduled_retraining_due boolean, performance_window_end string, drift_window_end string, "
       "performance_reason string, drift_reason string, data_quality_reason string")


def test_dec03_precedence(spark):
    from panelcast.operators.decisions import retraining_decision
    base = ["v1", 1000, 500, True, False, False, False, True, ["b1"], False, None, None, None, None, None]
    cases = {
        "skip": base,
        "block_quality": base[:3] + [False] + base[4:],
        "skip_cooldown": base[:6] + [True] + base[7:],
        "train": base[:4] + [True, True] + base[6:],
        "few_rows": [base[0], 10] + base[2:4] + [True] + base[5:],
    }
    rows = [tuple(v) for v in cases.values()]
    out = retraining_decision(spark.createDataFrame(rows, SIG)).collect()
    acts = [r["action"] for r in out]
    assert acts == ["skip", "block", "skip", "train_candidate", "skip"]
    assert out[3]["trigger_types"] == ["performance_degradation", "feature_drift"]
    assert out[0]["decision_id"].startswith("retrain-") and len(out[0]["decision_id"]) == 24


def test_decision_id_matches_python_json(spark):
    import hashlib
    import json
    from panelcast.operators.decisions import decision_id
    row = ["v1", 1000, 500, True, False, True, False, True, ["b1", "b2"], True, "2024-01-02", None, None, None, None]
    got = spark.createDataFrame([tuple(row)], SIG).select(decision_id().alias("i")).first()["i"]
    ident = {"dataset_version": "v1", "performance_window_end": "2024-01-02", "drift_window_end": None,
             "new_training_rows": 1000, "performance_degraded": False, "feature_drift_persistent": True,
             "batch_ids": ["b1", "b2"], "scheduled_retraining_due": True}
    want = "retrain-" + hashlib.sha256(json.dumps(ident, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:16]
    assert got == want


def test_dec05_cooldown_edges(spark):
    from panelcast.operators.decisions import cooldown_and_schedule
    now = dt.datetime(2026, 1, 8, 0, 0)
    rows = [("2026-01-01T00:00:00+00:00",), ("2026-01-01T00:00:01+00:00",), ("2026-02-01T00:00:00+00:00",),
            ("not a time",), (None,)]
    df = spark.createDataFrame(rows, "last_retrained_at_utc string")
    out = cooldown_and_schedule(df, F.lit(now), release_created=None).collect()
    assert [r["scheduled_retraining_due"] for r in out] == [True, False, False, False, False]   # exactly 168 h is due
    assert [r["cooldown_active"] for r in out] == [False, True, True, False, False]


def test_agg17_persistence(spark):
    from panelcast.operators.drift import persistent_drift
    s = "timestamp timestamp, feature string, drift_detected boolean"
    at = dt.datetime(2026, 8, 14)
    same = spark.createDataFrame([(dt.datetime(2026, 8, 12), "Customers", True), (dt.datetime(2026, 8, 13), "Customers", True)], s)
    assert persistent_drift(same, at, 14, 2).first()["triggered"]
    diff = spark.createDataFrame([(dt.datetime(2026, 8, 12), "Customers", True), (dt.datetime(2026, 8, 13), "Promo", True)], s)
    assert not persistent_drift(diff, at, 14, 2).first()["triggered"]
    old = spark.createDataFrame([(dt.datetime(2026, 7, 1), "Customers", True), (dt.datetime(2026, 7, 2), "Customers", True)], s)
    assert not persistent_drift(old, at, 14, 2).first()["triggered"]


def test_srt03_probe_row(spark):
    from panelcast.operators.dedup import top_n
    df = spark.createDataFrame([(2, D(2015, 4, 23)), (1, D(2015, 4, 24))], "Store long, Date date")
    r = top_n(df, 1, [F.col("Date").desc(), F.col("Store").asc()]).first()
    assert r["Store"] == 1 and r["Date"] == D(2015, 4, 24)


def test_fun09_state_modes(spark):
    from panelcast.operators.state import state_features
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), (None,)], "h array<double>")
    strict = df.select(*[c.alias(k) for k, c in state_features(F.col("h"), lags=[1, 7], windows=[7]).items()]).collect()
    assert strict[0]["sales_lag_1"] == 3.0 and strict[0]["sales_lag_7"] == 0.0 and strict[0]["sales_rolling_mean_7"] == 0.0
    pad = df.select(*[c.alias(k) for k, c in state_features(F.col("h"), lags=[1, 7], windows=[7], mode="pad").items()]).collect()
    assert pad[0]["sales_rolling_mean_7"] == pytest.approx(6 / 7) and pad[0]["sales_lag_7"] == 0.0
    assert pad[1]["sales_rolling_mean_7"] == 0.0


def test_win08_roll_forward_keeps_last_n(spark):
    from panelcast.operators.state import update_state
    st = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "entity long, history array<double>")
    batch = spark.createDataFrame([(1, D(2026, 1, 1), 4.0), (1, D(2026, 1, 2), 5.0), (2, D(2026, 1, 1), 9.0)],
                                  "Store long, Date date, Sales double")
    new, summary = update_state(st, batch, Roles(), n=4, order_col=batch.columns[-1])
    got = {r["entity"]: r["history"] for r in new.collect()}
    assert got == {1: [2.0, 3.0, 4.0, 5.0], 2: [9.0]}
    s = summary.first()
    assert s["updated_entities"] == 2 and s["appended_values"] == 3 and s["state_entities"] == 2


# (x, degrees of freedom, upper tail) from exact term sums in double precision.
CHI2_TAILS = [
    (999.3333, 1000, 5.000010031e-01),
    (1106.969, 1000, 9.999996854e-03),
    (2000, 1600, 2.571573559e-11),
    (1600, 1600, 4.952983876e-01),
    (3182.05, 1499, 4.551112286e-123),
    (9999.333, 10000, 5.000009626e-01),
    (10332.0, 10000, 9.987757997e-03),
    (12000.0, 10000, 1.147006552e-40),
    (999999.33, 1000000, 5.000009403e-01),
    (1003293.0, 1000000, 9.998000984e-03),
    (1030000.0, 1000000, 2.940622544e-98),
    (1.5, 7, 9.823096598e-01),
    (40.0, 3, 1.065509033e-08),
    (900.0, 1001, 9.899103827e-01),
]


def test_chi2_tail_at_every_scale(spark):
    from panelcast.functions.stats import chi2_sf
    df = spark.createDataFrame([(float(x), d, p) for x, d, p in CHI2_TAILS], "x double, k int, p double")
    for r in df.select("x", "k", "p", chi2_sf(F.col("x"), F.col("k")).alias("got")).collect():
        assert r["got"] == pytest.approx(r["p"], rel=1e-6), r


def test_drift_keeps_null_groups(spark):
    from panelcast.operators.drift import categorical_drift, numeric_drift
    rows = [(None, float(k), "a") for k in range(100)] + [("g", float(k), "a") for k in range(100)]
    ref = spark.createDataFrame(rows, "g string, v double, c string")
    cur = ref.withColumn("v", F.col("v") + 50)
    for drift, col in ((numeric_drift, "v"), (categorical_drift, "c")):
        got = {r["g"]: r for r in drift(ref, cur, [col], group_cols=["g"]).collect()}
        assert set(got) == {None, "g"}
        assert all((r["reference_n"], r["current_n"], r["reason"]) == (100, 100, "") for r in got.values())
    assert got[None]["score"] == got["g"]["score"]


def test_integral_keys_do_not_pass_through_double(spark):
    from panelcast.operators.joins import join_predictions_truth
    big = 2 ** 53 + 1
    a = spark.createDataFrame([(big, D(2026, 1, 1), 1.0), (big - 1, D(2026, 1, 1), 2.0)], "Store long, Date date, prediction double")
    b = spark.createDataFrame([(str(big), "2026-01-01", 3.0), ("7.0", "2026-01-01", 4.0), ("x", "2026-01-01", 5.0)],
                              "Store string, Date string, Sales double")
    got = join_predictions_truth(a, b).collect()
    assert [(r["Store"], r["prediction"]) for r in got] == [(big, 1.0)]


def test_alert_defaults_and_description(spark):
    from panelcast.operators.serving import group_alerts
    rows = [("a", "B", None, "svc", "sum", "more"), ("a", None, "info", None, None, ""), ("b", "C", "info", "s", "t", None)]
    alerts = spark.createDataFrame(rows, "group string, alertname string, severity string, service string, summary string, description string")
    got = {r["group"]: r for r in group_alerts(alerts).collect()}
    assert got["a"]["severity"] == "warning" and got["b"]["severity"] == "info"
    assert got["a"]["message"].split("\n") == ["- UnnamedAlert | service=unknown | No summary provided.",
                                              "- B | service=svc | sum", "  more", "Alert count: 2"]


def test_keep_last_needs_an_order(spark):
    from panelcast.operators.state import create_state, update_state
    rows = [(1, D(2026, 1, 1), 4.0, 2), (1, D(2026, 1, 1), 5.0, 1)]
    batch = spark.createDataFrame(rows, "Store long, Date date, Sales double, line int")
    new, _ = update_state(create_state(batch.limit(0)), batch, Roles(), order_col="line")
    assert new.first()["history"] == [4.0]
    with pytest.raises(TypeError):
        update_state(create_state(batch), batch, Roles())


def test_chi2_and_ks_tails(spark):
    from panelcast.functions.stats import chi2_sf, ks_pvalue
    df = spark.createDataFrame([(3.841459, 1), (5.991465, 2), (7.814728, 3), (9.487729, 4), (11.0705, 5), (0.0, 3)],
                               "x double, k int")
    ps = [r[0] for r in df.select(chi2_sf(F.col("x"), F.col("k"))).collect()]
    assert all(abs(p - 0.05) < 2e-6 for p in ps[:5]) and ps[5] == 1.0
    ks = spark.createDataFrame([(0.0, 100, 100), (1.36 / math.sqrt(1e5), 200_000, 200_000)], "d double, n long, m long")
    p = [r[0] for r in ks.select(ks_pvalue(F.col("d"), F.col("n"), F.col("m"))).collect()]
    assert p[0] == 1.0 and abs(p[1] - 0.0494) < 1e-3
