"""Model data work on Spark ML: feature alignment, model factory, weighted
fit with validation, refit, walk-forward backtest, search and scoring.

The boosted-tree algorithm itself is Spark ML's ``GBTRegressor``; scores
are not expected to equal another library's, only the data work around
them (alignment, transforms, weights, folds, metrics) is.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.scalar import business_rule, inverse_target_transform, target_transform
from panelcast.session import settings


def align_features(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """PRJ-10: exactly the model features in order; missing ones raise,
    extras are dropped (plan-time check)."""
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise ValueError(f"Missing model features: {missing}")
    return df.select(*expected)


def find_column(df: DataFrame, candidates: Sequence[str]) -> str:
    """PRJ-11: first candidate name that exists."""
    for c in candidates:
        if c in df.columns:
            return c
    raise KeyError(f"None of the columns {list(candidates)} found")


def resolve_columns(df: DataFrame, aliases: dict[str, Sequence[str]]) -> DataFrame:
    """PRJ-11: rename the first present candidate of each alias list."""
    for target, cands in aliases.items():
        src = find_column(df, cands)
        if src != target:
            df = df.withColumnRenamed(src, target)
    return df


# Model types of the factory, their seed default, and the training settings.
MODEL_TYPES = ("xgboost", "random_forest", "linear_regression")
DEFAULT_SEED = 42
TRAINING_PARAMS = {
    "n_estimators": 1200,
    "max_depth": 7,
    "learning_rate": 0.02951097123871115,
    "min_child_weight": 7,
    "subsample": 0.7591811958673289,
    "colsample_bytree": 0.8220753234069667,
    "reg_alpha": 0.026633895001357495,
    "reg_lambda": 8.719936821452245,
    "gamma": 0.22544860040323314,
    "early_stopping_rounds": 50,
}
SEARCH_TRIALS, SEARCH_FOLDS = 15, 2
SEARCH_ROUNDS = (300, 500, 700, 900, 1200)
#: Spark's gain is the variance reduction of the (log) target, far below the loss gain
#: that gamma is given in.
GAIN_SCALE = 1e-3
#: Least number of split candidates; categories of more levels raise it.
LEAST_BINS = 64
#: The JVM interprets methods of over 8000 bytes for good; the stages of many columns that
#: would be such a method are planned as several.
COMPILED_METHODS = {"spark.sql.codegen.hugeMethodLimit": "8000"}
#: Training rows that all fits running at the same time may keep together in the search.
SEARCH_ROWS = 4_000_000


def build_model(model_type: str, params: dict | None = None, seed: int = DEFAULT_SEED,
                features_col: str = "features", label_col: str = "label", weight_col: str | None = None,
                validation_col: str | None = None, max_bins: int = LEAST_BINS):
    """MLD-04: boosted trees / random forest / linear regression by config; what the
    parameters leave open comes from ``TRAINING_PARAMS``. Spark's trees have no L1 / L2
    leaf penalty, so reg_alpha and reg_lambda have no counterpart; gamma is the least
    gain of a split."""
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
    given, params = dict(params or {}), {**TRAINING_PARAMS, **(params or {})}
    if model_type == "xgboost":
        kw = dict(featuresCol=features_col, labelCol=label_col, seed=seed,
                  maxIter=int(params["n_estimators"]), maxDepth=int(params["max_depth"]),
                  stepSize=float(params["learning_rate"]),
                  subsamplingRate=float(params["subsample"]),
                  featureSubsetStrategy=str(params["colsample_bytree"]),
                  minInstancesPerNode=int(params["min_child_weight"]), minInfoGain=float(params["gamma"]) * GAIN_SCALE,
                  maxBins=max_bins)
        if weight_col:
            kw["weightCol"] = weight_col
        if validation_col:
            kw["validationIndicatorCol"] = validation_col
            kw["validationTol"] = float(params.get("validation_tol", 0.0))
        return GBTRegressor(**kw)
    if model_type == "random_forest":
        kw = dict(featuresCol=features_col, labelCol=label_col, seed=seed,
                  numTrees=int(given.get("n_estimators", 100)), maxDepth=int(given.get("max_depth", 8)), maxBins=max_bins)
        if weight_col:
            kw["weightCol"] = weight_col
        return RandomForestRegressor(**kw)
    if model_type == "linear_regression":
        kw = dict(featuresCol=features_col, labelCol=label_col)
        if weight_col:
            kw["weightCol"] = weight_col
        return LinearRegression(**kw)
    raise ValueError(f"Unsupported model type: {model_type}")


def feature_pipeline(numeric: Sequence[str], categorical: Sequence[str]):
    """Imputer + missing flags for numerics, StringIndexer(keep) for
    categories, then a vector assembler (Spark trees take no NaN / raw text)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
    stages = []
    num_out = [f"{c}__imp" for c in numeric]
    if numeric:
        stages.append(Imputer(inputCols=list(numeric), outputCols=num_out, strategy="median"))
    cat_out = [f"{c}__idx" for c in categorical]
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=cat_out, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=num_out + cat_out, outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages)


def prepare_training_frame(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str,
                           transform: str | None = "log1p") -> DataFrame:
    """Cast features (numerics to double, categories to text with null ->
    'nan'), add the transformed label."""
    cols = {c: F.col(c).cast("double") for c in numeric}
    cols.update({c: F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in categorical})
    out = df.withColumns(cols)
    if target in df.columns:
        out = out.withColumn("label", target_transform(F.col(target).cast("double"), transform))
    return out


def fit_features(prep: DataFrame, numeric: Sequence[str], categorical: Sequence[str]):
    """The feature stages fitted on prepared rows, and the split bins that cover the
    largest category. The medians of all columns are one SQL aggregate with the sketch that
    the imputer itself uses (it would pass every row as an object), whose one row the
    imputer is fitted on."""
    from pyspark.ml import Estimator, PipelineModel
    from pyspark.ml.feature import Imputer
    fitted = []
    for stage in feature_pipeline(numeric, categorical).getStages():
        if isinstance(stage, Imputer):
            given = [F.when(~F.isnan(c), F.col(c)) for c in numeric]
            accuracy = round(1 / stage.getRelativeError())
            row = prep.agg(*[F.percentile_approx(x, 0.5, accuracy).alias(c) for x, c in zip(given, numeric)]).first()
            stage = stage.fit(prep.sparkSession.range(1).select(*[F.lit(v).cast("double").alias(c) for v, c in zip(row, numeric)]))
        elif isinstance(stage, Estimator):
            stage = stage.fit(prep)
        fitted.append(stage)
    feats = PipelineModel(stages=fitted)
    levels = [len(labels) + 1 for stage in feats.stages if hasattr(stage, "labelsArray") for labels in stage.labelsArray]
    return feats, max([LEAST_BINS, *levels])


def fit(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str = "Sales",
        model_type: str = "xgboost", params: dict | None = None, weight_col: str | None = None,
        validation_col: str | None = None, transform: str | None = "log1p", seed: int = DEFAULT_SEED):
    """MLD-05: fit on the transformed target with optional weights; a boosted
    model early-stops on rows flagged by ``validation_col``. The learners keep their own
    (binned) rows, so no second copy is kept here; as the rows are read several times, a
    costly plan should come as a table (``files.kept``)."""
    from pyspark.ml import PipelineModel
    prep = prepare_training_frame(df, numeric, categorical, target, transform)
    with settings(df.sparkSession, COMPILED_METHODS):
        feats, bins = fit_features(prep, numeric, categorical)
        model = build_model(model_type, params, seed, weight_col=weight_col, validation_col=validation_col, max_bins=bins)
        ready = feats.transform(prep).select(*{"features", "label", *filter(None, (weight_col, validation_col))})
        return PipelineModel(stages=[feats, model.fit(ready)])


def predict(model, df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
            transform: str | None = "log1p", open_col: str | None = "Open", target: str = "Sales") -> DataFrame:
    """Score: transform, inverse target transform (FUN-07), business rule
    and rounding (FUN-08)."""
    prep = prepare_training_frame(df, numeric, categorical, target, transform)
    scored = model.transform(prep)
    raw = inverse_target_transform(F.col("prediction"), transform)
    rule_open = open_col if open_col and open_col in df.columns else None
    keep = [c for c in df.columns if c not in ("prediction",)]
    out = scored.select(*[F.col(c) for c in keep], raw.alias("raw_prediction"))
    return out.withColumn("prediction", business_rule("raw_prediction", rule_open)).drop("raw_prediction")


def stopping_iteration(losses: Sequence[float], patience: int) -> int:
    """The best iteration at the time when ``patience`` iterations have not improved on it."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best


def validation_losses(model, df: DataFrame, numeric, categorical, target="Sales", transform="log1p") -> list[float]:
    """Squared validation loss after each boosting iteration."""
    prep = prepare_training_frame(df, numeric, categorical, target, transform)
    ready = model.stages[0].transform(prep).persist()
    try:
        return list(model.stages[-1].evaluateEachIteration(ready, "squared"))
    finally:
        ready.unpersist()


def best_iteration(model, df: DataFrame, numeric, categorical, target="Sales", transform="log1p",
                   patience: int = TRAINING_PARAMS["early_stopping_rounds"]) -> int:
    """MLD-07: best boosting iteration on validation rows, stopping with patience."""
    return stopping_iteration(validation_losses(model, df, numeric, categorical, target, transform), patience)


def sample_params(trials: int = SEARCH_TRIALS, seed: int = DEFAULT_SEED) -> list[dict]:
    """MLD-09: seeded random parameter maps over the nine searched parameters, in log
    or linear ranges (fixed values)."""
    rng = random.Random(seed)
    return [{
        "n_estimators": rng.choice(SEARCH_ROUNDS),
        "max_depth": rng.randint(4, 9),
        "learning_rate": math.exp(rng.uniform(math.log(0.02), math.log(0.10))),
        "min_child_weight": rng.randint(1, 15),
        "subsample": rng.uniform(0.70, 1.0),
        "colsample_bytree": rng.uniform(0.70, 1.0),
        "reg_alpha": math.exp(rng.uniform(math.log(1e-4), 0.0)),
        "reg_lambda": math.exp(rng.uniform(0.0, math.log(20.0))),
        "gamma": rng.uniform(0.0, 0.5),
    } for _ in range(trials)]


def search(tagged: DataFrame, numeric, categorical, evaluate, trials: int = SEARCH_TRIALS, folds: int = SEARCH_FOLDS,
           tree_share: float = 1.0, parallelism: int = 4, seed: int = DEFAULT_SEED) -> DataFrame:
    """MLD-09: one row per trial (its parameters, ``trees`` fitted, the folds' RMSE, their
    mean, and whether it is the best) over rows tagged with (fold, role). ``evaluate(scored)``
    gives a one-row table with rmse.

    The feature stages depend on the fold alone: they are fitted once per fold, and its
    validation rows are kept for all trials. The training vectors are not: every fit reads
    ``tagged`` (a table, ``files.kept``) and keeps its own binned rows. Up to ``parallelism``
    fits submit their jobs at the same time, so that the short jobs of one fit fill the gaps
    of another (with ``spark.scheduler.mode`` FAIR they share executors evenly), but only as
    many as have ``SEARCH_ROWS`` together: a larger fit has all executors for itself. Only a
    fold's RMSE reaches the driver. ``tree_share`` scales every sampled tree count where a
    budget is needed, so that the count stays a searched parameter; ties go to the earlier
    trial."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target
    from pyspark.ml import PipelineModel
    spark, sampled = tagged.sparkSession, sample_params(trials, seed)
    trees = [max(1, round(p["n_estimators"] * tree_share)) for p in sampled]
    prepared, largest = {}, 1

    def fold_rmse(job: tuple[int, int]) -> float:
        trial, fold = job
        feats, bins, prep, validation = prepared[fold]
        model = build_model("xgboost", {**sampled[trial], "n_estimators": trees[trial]}, seed, max_bins=bins)
        ready = feats.transform(prep).select("features", "label")
        scored = predict(PipelineModel(stages=[feats, model.fit(ready)]), validation, numeric, categorical)
        return evaluate(scored).first()["rmse"]

    jobs = [(trial, fold) for trial in range(trials) for fold in range(1, folds + 1)]
    with settings(spark, COMPILED_METHODS):
        try:
            for fold in range(1, folds + 1):
                rows = tagged.filter(F.col("fold") == fold)
                train = rows.filter("role = 'train'")
                prep = prepare_training_frame(train, numeric, categorical, "Sales")
                prepared[fold] = (*fit_features(prep, numeric, categorical), prep, rows.filter("role = 'validation'").persist())
                largest = max(largest, train.count())
            with ThreadPoolExecutor(max(1, min(parallelism, SEARCH_ROWS // largest))) as pool:
                rmse = dict(zip(jobs, pool.map(inheritable_thread_target(spark)(fold_rmse), jobs)))
        finally:
            for *_, validation in prepared.values():
                validation.unpersist()
    by_trial = [[rmse[(t, f)] for f in range(1, folds + 1)] for t in range(trials)]
    means = [sum(r) / folds for r in by_trial]
    rows = [(t, *sampled[t].values(), trees[t], by_trial[t], means[t], t == means.index(min(means))) for t in range(trials)]
    kinds = ", ".join(f"{k} {'int' if isinstance(v, int) else 'double'}" for k, v in sampled[0].items())
    return spark.createDataFrame(rows, f"trial int, {kinds}, trees int, fold_rmse array<double>, mean_rmse double, is_best boolean")
