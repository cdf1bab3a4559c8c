"""Model data work: factory, alignment, transforms, refit iteration."""

import datetime as dt

import pytest
from pyspark.sql import functions as F


def test_factory_and_alignment(spark):
    from panelcast.operators import ml as ML
    assert ML.build_model("xgboost", {"n_estimators": 3}).getMaxIter() == 3
    assert type(ML.build_model("random_forest")).__name__ == "RandomForestRegressor"
    assert type(ML.build_model("linear_regression")).__name__ == "LinearRegression"
    with pytest.raises(ValueError):
        ML.build_model("unknown")
    df = spark.createDataFrame([(1, 2.0, "a")], "a int, b double, c string")
    assert ML.align_features(df, ["c", "a"]).columns == ["c", "a"]
    with pytest.raises(ValueError):
        ML.align_features(df, ["a", "zz"])
    assert ML.resolve_columns(df.withColumnRenamed("b", "Prediction"), {"prediction": ["prediction", "Prediction"]}) \
        .columns == ["a", "prediction", "c"]


def test_fit_predict_inverse_and_rule(spark):
    from panelcast.operators import ml as ML
    rows = [(float(i % 7), i % 2, float(100 + 10 * (i % 7)), 1 if i % 5 else 0) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, Promo int, Sales double, Open int")
    model = ML.fit(df, ["x", "Promo"], [], params={"n_estimators": 5, "max_depth": 3})
    out = ML.predict(model, df.drop("Sales"), ["x", "Promo"], [])
    r = out.agg(F.min("prediction"), F.max(F.when(F.col("Open") == 0, F.col("prediction")))).first()
    assert r[0] >= 0.0 and r[1] == 0.0          # closed stores forced to 0, no negatives
    assert 0 <= ML.best_iteration(model, df, ["x", "Promo"], []) < 5


def test_sample_params_seeded():
    from panelcast.operators import ml as ML
    assert ML.sample_params(3, 42) == ML.sample_params(3, 42)
    assert ML.sample_params(3, 42) != ML.sample_params(3, 7)


def test_patience_and_search_space():
    from panelcast.operators import ml as ML
    assert ML.stopping_iteration([5, 4, 3, 3.5, 3.2, 2], 2) == 2
    assert ML.stopping_iteration([5, 4, 3, 3.5, 3.2, 2], 4) == 5
    assert ML.TRAINING_PARAMS["n_estimators"] == 1200 and ML.SEARCH_TRIALS == 15
    maps = ML.sample_params(200)
    assert all(len(m) == 9 and m["n_estimators"] in ML.SEARCH_ROUNDS and 0.02 <= m["learning_rate"] <= 0.1 for m in maps)


def test_categories_beyond_the_default_bins(spark):
    from panelcast.operators import ml as ML
    df = spark.createDataFrame([(f"c{i % 90}", float(i % 90)) for i in range(400)], "c string, Sales double")
    model = ML.fit(df, [], ["c"], params={"n_estimators": 2, "max_depth": 2})
    assert ML.predict(model, df, [], ["c"]).count() == 400


def test_config_hash_is_sorted_json():
    import hashlib
    import json
    from panelcast.functions.scalar import config_hash
    cfg = {"b": 1, "a": [1, 2]}
    assert config_hash(cfg) == hashlib.sha256(json.dumps(cfg, sort_keys=True).encode()).hexdigest()


def test_search_uses_all_parameters_and_marks_the_best(spark):
    from panelcast.operators import metrics as M
    from panelcast.operators import ml as ML
    rows = [(float(i % 9), float(50 + 10 * (i % 9)), fold, "train" if i % 4 else "validation", 1)
            for fold in (1, 2, 3) for i in range(120)]
    tagged = spark.createDataFrame(rows, "x double, Sales double, fold int, role string, Open int")
    asked = []

    def rmse(scored):
        asked.append(scored.select("fold").first()[0])
        return M.regression_metrics(scored, "Sales", "prediction")

    got = ML.search(tagged, ["x"], [], rmse, trials=3, tree_share=0.01).orderBy("trial").collect()
    sampled = ML.sample_params(3)
    assert [r["trees"] for r in got] == [round(p["n_estimators"] * 0.01) for p in sampled]
    assert all(r[k] == v for r, p in zip(got, sampled) for k, v in p.items())
    assert sorted(asked) == [1, 1, 1, 2, 2, 2]
    assert all(abs(r["mean_rmse"] - sum(r["fold_rmse"]) / 2) < 1e-9 for r in got)
    means = [r["mean_rmse"] for r in got]
    assert [r["is_best"] for r in got] == [r["trial"] == means.index(min(means)) for r in got]  # ties: the earlier


def test_search_fits_the_feature_stages_once_per_fold(spark, monkeypatch):
    from panelcast.operators import metrics as M
    from panelcast.operators import ml as ML
    rows = [(float(i % 9), float(50 + 10 * (i % 9)), fold, "train" if i % 4 else "validation", 1)
            for fold in (1, 2) for i in range(60)]
    tagged = spark.createDataFrame(rows, "x double, Sales double, fold int, role string, Open int")
    plain, built = ML.feature_pipeline, []
    monkeypatch.setattr(ML, "feature_pipeline", lambda *a: built.append(a) or plain(*a))
    ML.search(tagged, ["x"], [], lambda scored: M.regression_metrics(scored, "Sales", "prediction"), trials=3, tree_share=0.01)
    assert len(built) == 2


def test_models_read_a_kept_table(spark):
    from panelcast.plans import q_ml
    from panelcast.plans.registry import Inputs
    plan = q_ml._features(Inputs(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" in plan and "Window" not in plan and "Exchange" not in plan


def test_folds_from_limits_are_filters_of_one_scan(spark, tmp_path):
    import datetime as dt
    from panelcast.operators.splits import fold_limits, walk_forward
    day = dt.date(2020, 1, 1)
    rows = [(s, day + dt.timedelta(d), float(d)) for s in (1, 2) for d in range(40)] + [(3, None, 1.0), (1, day, 0.0)]
    spark.createDataFrame(rows, "Store int, Date date, Sales double").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    by_limits, plain = walk_forward(df, limits=fold_limits(df, folds=3, days=5)), walk_forward(df, folds=3, days=5)
    assert by_limits.dtypes == plain.dtypes
    assert sorted(map(str, by_limits.collect())) == sorted(map(str, plain.collect()))
    plan = by_limits.filter("fold = 2").filter("role = 'train'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Generate" not in plan and "Subquery" not in plan and "LessThan" in plan


def test_medians_are_those_of_the_imputer(spark):
    from pyspark.ml.feature import Imputer
    from panelcast.operators import ml as ML
    rows = [(float(i * 37 % 101) if i % 3 else None, float("nan") if i % 5 == 0 else float(i), "a") for i in range(400)]
    df = spark.createDataFrame(rows, "x double, y double, c string")
    feats, _ = ML.fit_features(df, ["x", "y"], ["c"])
    own = Imputer(inputCols=["x", "y"], outputCols=["p", "q"], strategy="median").fit(df).surrogateDF.first()
    assert feats.stages[0].surrogateDF.first().asDict() == own.asDict()


def test_search_query_fits_all_sampled_trees(spark, monkeypatch):
    from panelcast.operators import ml as ML
    from panelcast.plans import q_ml
    asked = []

    class Fitted(Exception):
        pass

    def build(model_type, params, *a, **k):
        asked.append(params["n_estimators"])
        raise Fitted

    monkeypatch.setattr(ML, "build_model", build)
    with pytest.raises(Fitted):
        q_ml.mld_09_hyperparameter_search(spark, "/root/testdata/sf0.001")
    assert asked and set(asked) <= set(ML.SEARCH_ROUNDS)


def test_large_fits_of_the_search_run_alone(spark, monkeypatch):
    import threading
    from panelcast.operators import metrics as M
    from panelcast.operators import ml as ML
    rows = [(float(i % 9), float(50 + i % 9), fold, "train" if i % 4 else "validation", 1) for fold in (1, 2) for i in range(60)]
    tagged = spark.createDataFrame(rows, "x double, Sales double, fold int, role string, Open int")
    threads, plain = set(), ML.build_model
    monkeypatch.setattr(ML, "SEARCH_ROWS", 50)
    monkeypatch.setattr(ML, "build_model", lambda *a, **k: threads.add(threading.get_ident()) or plain(*a, **k))
    kept = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    ML.search(tagged, ["x"], [], lambda scored: M.regression_metrics(scored, "Sales", "prediction"), trials=2, tree_share=0.005)
    assert len(threads) == 1 and spark.sparkContext._jsc.sc().getPersistentRDDs().size() <= kept


def test_kept_tables_leave_no_shuffle_files(spark):
    from panelcast.sources.files import kept
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = manager.getAllFiles()
        names = (files.apply(k).getName() for k in range(files.size()))
        return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffled(), spark.conf.get(key)
    table = kept(spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count(), "count")
    assert not shuffled() - before and spark.conf.get(key) == setting
    assert table.count() == 7


def test_features_join_their_calendar_without_an_exchange(spark, monkeypatch):
    from panelcast.plans import q_ml
    from panelcast.plans.registry import Inputs
    plans = []

    def kept(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return df

    monkeypatch.setattr(q_ml, "kept", kept)
    with q_ml.settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        i = Inputs(spark, "/root/testdata/sf0.001")
        q_ml._features(i)
    name, plan = plans[-1]
    assert name == "features" and "l_orderkey" not in plan
    assert "hashpartitioning(Store" in plan and not [ln for ln in plan.splitlines() if "hashpartitioning(Store" in ln and "Date" in ln]
