"""Drift per store up to the retraining decision, on planted shifts."""

import datetime as dt

from pyspark.sql import functions as F

from panelcast.operators.decisions import retraining_decision
from panelcast.operators.drift import drift_history, persistent_drift, persistent_drift_by

LAST = dt.date(2015, 7, 31)


def _panel(spark):
    """Store 1: steady; 2: 10 times the sales in the last 100 days; 3: only in the last 95
    of the current window's days that the earlier evaluation does not see in full; 4: too short."""
    rows = []
    for back in range(300):
        day, base = LAST - dt.timedelta(days=back), float(back * 37 % 101)
        rows += [(1, day, base), (2, day, base + (1000.0 if back < 100 else 0.0)), (None, day, base)]
        rows.append((3, day, base + (1000.0 if back < 20 else 0.0)))
        if back < 40:
            rows.append((4, day, base))
    return spark.createDataFrame(rows, "Store long, Date date, Sales double")


def test_persistence_by_store(spark):
    history = drift_history(_panel(spark), ["Sales"], F.lit(LAST), (0, 14), days=100, group_cols=["Store"])
    drifted = {(r["Store"], r["timestamp"]): r["drift_detected"] for r in history.collect()}
    earlier = LAST - dt.timedelta(days=14)
    assert drifted[(2, LAST)] and drifted[(2, earlier)] and drifted[(3, LAST)] and not drifted[(3, earlier)]
    assert not drifted[(1, LAST)] and not drifted[(4, LAST)] and (None, LAST) in drifted
    got = {r["Store"]: r for r in persistent_drift_by(history, F.lit(LAST), ["Store"]).collect()}
    assert [s for s, r in got.items() if r["triggered"]] == [2] and got[2]["features"] == ["Sales"]
    assert got[2]["reason"] == "Persistent feature drift detected for: ['Sales']."
    # the same rule as the one for a single history
    for store in (1, 2, 3):
        one = persistent_drift(history.where(F.col("Store") == store), LAST).first()
        assert all(one[c] == got[store][c] for c in ("triggered", "windows_found", "window_end", "features", "reason"))
    # one evaluation in the look-back is not enough
    few = persistent_drift_by(history, F.lit(LAST), ["Store"], lookback_days=7)
    assert {r["triggered"] for r in few.collect()} == {False}
    assert persistent_drift_by(history.limit(0), F.lit(LAST), ["Store"]).count() == 0


def test_drift_leads_to_a_candidate(spark):
    from panelcast.plans.q_decisions import store_signals
    from panelcast.plans.registry import Inputs
    signals = store_signals(Inputs(spark, "/root/testdata/sf0.01"))
    decided = retraining_decision(signals).where("action = 'train_candidate'")
    rows = decided.select("Store", "trigger_types", "reasons").collect()
    drift = [r for r in rows if "feature_drift" in r["trigger_types"]]
    assert drift and all(r["Store"] % 5 == 0 for r in drift) and len(drift) < len(rows)
    assert all("Persistent feature drift detected for: ['Sales']." in r["reasons"] for r in drift)
