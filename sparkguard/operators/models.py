"""Classifier training, random search and scoring with ``pyspark.ml``.

Models keep the data-model names of the reference flow.  XGBoost / LightGBM
are not installed; their parameter sets map onto ``boosting.py`` (second-order
splits and leaf values, columns sampled per tree, leaf-wise growth).  Scores are
never claimed equal to those libraries.  ``build_estimator`` still gives the
nearest ``pyspark.ml`` estimator of each model.
"""
from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace
from typing import Any

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ID, LABEL
from ..session import cut_in_files, drop_table
from . import boosting
from .ranked import null_safe_join
from .sampling import TUNING_MIN_ROWS, stratified_kfold, tuning_subsample

# Model names (in report order), seed, live and extended grids.
MODEL_NAMES = ["logistic_regression", "random_forest", "gradient_boosting", "xgboost", "lightgbm"]
SEED = 42
MAX_TREE_DEPTH = 30  # Spark's limit stands in for "no limit"

PARAM_GRIDS: dict[str, dict[str, list[Any]]] = {
    "logistic_regression": {"C": [0.01, 0.1, 1.0], "penalty": ["l1", "l2"], "solver": ["liblinear"]},
    "random_forest": {"n_estimators": [100, 200], "max_depth": [5, 10, None], "min_samples_split": [2, 5],
                      "min_samples_leaf": [1, 2]},
    "gradient_boosting": {"n_estimators": [100, 200], "learning_rate": [0.05, 0.1], "max_depth": [3, 5],
                          "subsample": [0.8, 1.0]},
    "xgboost": {"n_estimators": [100, 200], "learning_rate": [0.05, 0.1], "max_depth": [3, 5], "subsample": [0.8],
                "colsample_bytree": [0.8], "scale_pos_weight": [1, 5]},
    "lightgbm": {"n_estimators": [100, 200], "learning_rate": [0.05, 0.1], "max_depth": [3, 5, -1],
                 "num_leaves": [31, 50], "subsample": [0.8]},
}
PARAM_GRIDS_EXTENDED: dict[str, dict[str, list[Any]]] = {
    "logistic_regression": {"C": [0.001, 0.01, 0.1, 1, 10, 100], "penalty": ["l1", "l2"], "solver": ["liblinear"]},
    "random_forest": {"n_estimators": [100, 200, 300], "max_depth": [None, 10, 20, 30],
                      "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4]},
    "xgboost": {"n_estimators": [100, 200, 300], "max_depth": [3, 5, 7], "learning_rate": [0.01, 0.1, 0.2],
                "subsample": [0.8, 1.0], "colsample_bytree": [0.8, 1.0], "scale_pos_weight": [1, 5, 10]},
    "lightgbm": {"n_estimators": [100, 200, 300], "max_depth": [3, 5, 7], "learning_rate": [0.01, 0.1, 0.2],
                 "num_leaves": [31, 50, 70], "subsample": [0.8, 1.0]},
}
# Defaults of the five base estimators (library defaults of the reference flow).
BASE_PARAMS: dict[str, dict[str, Any]] = {
    "logistic_regression": {"C": 1.0, "penalty": "l2"},
    "random_forest": {"n_estimators": 100, "max_depth": None, "min_samples_leaf": 1},
    "gradient_boosting": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3, "subsample": 1.0},
    "xgboost": {"n_estimators": 100, "learning_rate": 0.3, "max_depth": 6, "subsample": 1.0,
                "colsample_bytree": 1.0, "scale_pos_weight": 1},
    "lightgbm": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": -1, "num_leaves": 31, "subsample": 1.0},
}
#: The weighted fit of the second-order model: the grid's sampling shares and its positive weight above 1.
WEIGHTED_PARAMS: dict[str, Any] = {"subsample": 0.8, "colsample_bytree": 0.8, "scale_pos_weight": 5}
WEIGHTED = {"logistic_regression", "random_forest"}  # class_weight='balanced'
BOOSTED = {"xgboost", "lightgbm"}
TASK_ROWS = 100_000     # rows that a task of a fit holds, about


def grid_points(model: str, grids: dict | None = None) -> list[dict[str, Any]]:
    g = (grids or PARAM_GRIDS)[model]
    keys = list(g)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[g[k] for k in keys])]


def param_grid_frame(spark: SparkSession, grids: dict | None = None) -> DataFrame:
    """``(model, point, param, value)`` for every grid point (value as text)."""
    rows = [(m, i, k, None if v is None else str(v))
            for m in (grids or PARAM_GRIDS) for i, p in enumerate(grid_points(m, grids)) for k, v in p.items()]
    return spark.createDataFrame(rows, "model string, point int, param string, value string")


def random_search_sample(model: str, n_iter: int, seed: int = SEED, grids: dict | None = None
                         ) -> list[dict[str, Any]]:
    """``n_iter`` distinct grid points (all when the grid is smaller), in a
    seeded hash order."""
    import hashlib
    pts = grid_points(model, grids)
    order = sorted(range(len(pts)), key=lambda i: hashlib.md5(f"{seed}-{i}".encode()).hexdigest())
    return [pts[i] for i in order[:n_iter]]


def with_class_weights(df: DataFrame, label: str = LABEL, weight_col: str = "w") -> DataFrame:
    """Balanced weights n / (classes x n_c), from the actual counts (lazy)."""
    cc = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = cc.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    w = cc.crossJoin(tot).select(label, (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias(weight_col))
    return null_safe_join(df, w, [label])


def build_estimator(model: str, params: dict[str, Any] | None = None, n_rows: int | None = None,
                    features_col: str = "features", label_col: str = LABEL, weight_col: str = "w"):
    """Map a reference parameter set onto a ``pyspark.ml`` estimator."""
    p = {**BASE_PARAMS[model], **(params or {})}
    common = dict(featuresCol=features_col, labelCol=label_col)
    if model == "logistic_regression":
        n = max(1, n_rows or 1)
        return LogisticRegression(maxIter=1000, tol=1e-4, regParam=1.0 / (float(p["C"]) * n),
                                  elasticNetParam=1.0 if p.get("penalty") == "l1" else 0.0,
                                  standardization=False, weightCol=weight_col, **common)
    if model == "random_forest":
        depth = MAX_TREE_DEPTH if p.get("max_depth") is None else int(p["max_depth"])
        return RandomForestClassifier(numTrees=int(p["n_estimators"]), maxDepth=min(depth, MAX_TREE_DEPTH),
                                      minInstancesPerNode=int(p.get("min_samples_leaf", 1)),
                                      featureSubsetStrategy="sqrt", weightCol=weight_col, seed=SEED,
                                      cacheNodeIds=True, **common)      # deep trees aren't walked again in each pass
    if model == "gradient_boosting":
        return GBTClassifier(maxIter=int(p["n_estimators"]), stepSize=float(p["learning_rate"]),
                             maxDepth=int(p["max_depth"]), subsamplingRate=float(p["subsample"]), seed=SEED, **common)
    if model == "xgboost":
        est = GBTClassifier(maxIter=int(p["n_estimators"]), stepSize=float(p["learning_rate"]),
                            maxDepth=int(p["max_depth"]), subsamplingRate=float(p["subsample"]),
                            featureSubsetStrategy=str(float(p["colsample_bytree"])) if float(p["colsample_bytree"]) < 1
                            else "all", seed=SEED, **common)
        if float(p.get("scale_pos_weight", 1)) != 1:
            est.setWeightCol(weight_col)
        return est
    if model == "lightgbm":
        depth = int(p["max_depth"])
        leaf_depth = math.ceil(math.log2(int(p["num_leaves"])))
        return GBTClassifier(maxIter=int(p["n_estimators"]), stepSize=float(p["learning_rate"]),
                             maxDepth=leaf_depth if depth <= 0 else min(depth, leaf_depth),
                             subsamplingRate=float(p["subsample"]), seed=SEED, **common)
    raise ValueError(f"unknown model {model!r}")


def boosting_params(model: str, params: dict[str, Any] | None = None) -> boosting.Boosting:
    """The ``boosting`` parameters of a boosted model's parameter set."""
    p = {**BASE_PARAMS[model], **(params or {})}
    common = dict(rounds=int(p["n_estimators"]), rate=float(p["learning_rate"]), rows=float(p["subsample"]), seed=SEED)
    if model == "xgboost":
        return replace(boosting.SECOND_ORDER, depth=int(p["max_depth"]), columns=float(p["colsample_bytree"]),
                       positive_weight=float(p["scale_pos_weight"]), **common)
    return replace(boosting.LEAFWISE, depth=max(0, int(p["max_depth"])), leaves=int(p["num_leaves"]), **common)


def prepare(df: DataFrame, features: list[str], model: str, params: dict | None = None,
            label: str = LABEL) -> DataFrame:
    """Assemble features and attach the weight column the model needs."""
    out = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep").transform(df)
    p = {**BASE_PARAMS[model], **(params or {})}
    if model in WEIGHTED:
        out = with_class_weights(out, label)
    elif model == "xgboost":
        out = out.withColumn("w", F.when(F.col(label) == 1, F.lit(float(p.get("scale_pos_weight", 1))))
                             .otherwise(F.lit(1.0)))
    else:
        out = out.withColumn("w", F.lit(1.0))
    return out


@contextmanager
def split_by_file(spark: SparkSession, n: int) -> Iterator[None]:
    """While more than ``TASK_ROWS`` rows are read, a scan's files aren't packed into shared partitions: ``cut_in_files`` bounds their
    rows, while their bytes say nothing, as values that repeat are small in files and large as vectors."""
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key, None)
    if n > TASK_ROWS:
        spark.conf.set(key, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def held_rows(data: DataFrame, n: int, extra: tuple[str, ...] = (), label: str = LABEL, key: str = ID,
              source: DataFrame | None = None) -> DataFrame:
    """What a fit reads of ``n`` prepared rows: no other column, and more partitions as the rows grow.  A scan with a partition for
    about ``TASK_ROWS`` rows (see ``split_by_file``) is read again from its files; other rows are dealt out, the same number for each
    core, and persisted.  A fit keeps its own compact copy of the rows anyway."""
    if n > TASK_ROWS:
        if (source or data).rdd.getNumPartitions() * TASK_ROWS >= n:
            return data.select("features", label, "w", *extra)
        cores = data.sparkSession.sparkContext.defaultParallelism
        data = data.repartition(cores * math.ceil(n / (TASK_ROWS * cores)), key)
    return data.select("features", label, "w", *extra).persist()


def fit_model(train: DataFrame, features: list[str], model: str, params: dict | None = None):
    if model in BOOSTED:
        return boosting.fit(train, features, boosting_params(model, params))
    n = train.count()
    with split_by_file(train.sparkSession, n):
        data = held_rows(prepare(train, features, model, params), n, source=train)
        fitted = build_estimator(model, params, n).fit(data)
        data.unpersist()
    return fitted


def fit_boosted(train: DataFrame, features: list[str], params: dict[str, dict | None],
                binned: Callable[[], boosting.Binned] | None = None) -> dict[str, boosting.BoostedModel]:
    """Several boosted models (name -> parameters) grown side by side on one binned table (``binned()``, else written here)."""
    if not params:
        return {}
    binned = binned() if binned else boosting.bin_features(train, features)
    return dict(zip(params, boosting.fit_many(binned, [boosting_params(m, p) for m, p in params.items()])))


def score(fitted, df: DataFrame, features: list[str], model: str) -> DataFrame:
    """``(model, id, y_true, y_prob, y_pred)`` with y_prob = P(class 1)."""
    a = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep").transform(df)
    out = fitted.transform(a)
    return out.select(F.lit(model).alias("model"), F.col(ID), F.col(LABEL).cast("int").alias("y_true"),
                      vector_to_array("probability")[1].alias("y_prob"),
                      F.col("prediction").cast("int").alias("y_pred"))


def train_all_base(train: DataFrame, test: DataFrame, features: list[str],
                   models: list[str] | None = None) -> tuple[dict, DataFrame]:
    """Fit every base model; return (fitted models, unioned scored test rows)."""
    models = models or MODEL_NAMES
    fitted, scored = {}, None
    boosted = fit_boosted(train, features, {m: None for m in models if m in BOOSTED})
    for m in models:
        fitted[m] = boosted[m] if m in boosted else fit_model(train, features, m)
        s = score(fitted[m], test, features, m)
        scored = s if scored is None else scored.unionByName(s)
    return fitted, scored


def _weight_name(model: str, p: dict) -> str:
    """The weight column of a grid point: one per ``scale_pos_weight`` for xgboost, else ``w``."""
    return f"w_{float(p.get('scale_pos_weight', 1))}".replace(".", "_") if model == "xgboost" else "w"


def _different_points(model: str, n_iter: int, seed: int) -> list[dict]:
    """The first ``n_iter`` grid points, in seeded order, that give different fits here."""
    out, seen = [], set()
    for p in random_search_sample(model, 10**6, seed):
        e = build_estimator(model, p, 1)
        mark = repr(sorted((k.name, str(v)) for k, v in e.extractParamMap().items())) + _weight_name(model, p)
        if mark not in seen:
            seen.add(mark)
            out.append(p)
    return out[:n_iter]


def _param_maps(est, model: str, points: list[dict], n_rows: int):
    maps = []
    for p in points:
        e = build_estimator(model, p, n_rows, weight_col=_weight_name(model, p))
        maps.append({est.getParam(k.name): v for k, v in e.extractParamMap().items()
                     if est.hasParam(k.name) and k.name not in ("featuresCol", "labelCol")})
    return maps


def _boosted_scores(sample: DataFrame, features: list[str], model: str, points: list[dict], folds: int) -> list[float]:
    """Mean F1 of class 1 over the folds per point: one binned fold table, all points and folds grown side by side."""
    binned = boosting.bin_features(sample, features, fold="fold")
    fits = [replace(boosting_params(model, p), fold=f) for p in points for f in range(folds)]
    found = boosting.fold_f1(binned, boosting.fit_many(binned, fits))
    return [sum(found[i * folds:(i + 1) * folds]) / folds for i in range(len(points))]


def random_search(train: DataFrame, features: list[str], model: str, n_iter: int = 10, folds: int = 3, subsample: float = 1.0,
                  seed: int = SEED, parallelism: int = 4, min_rows: int = TUNING_MIN_ROWS) -> tuple[dict[str, Any], float]:
    """Stratified k-fold random search on F1 of class 1 over all rows (a ``subsample`` only when one is asked for): the best
    params and their mean F1."""
    points = _different_points(model, n_iter, seed)
    sample = stratified_kfold(tuning_subsample(train, subsample, min_rows, seed=seed), folds, seed)
    if model in BOOSTED:
        means = _boosted_scores(sample, features, model, points, folds)
    else:
        n, table = sample.count(), None
        if n > TASK_ROWS:                                # the fits of all folds read the rows with their folds
            sample = table = cut_in_files(sample.select(ID, LABEL, "fold", *features), "folds", TASK_ROWS)
            parallelism = 1 if n > TASK_ROWS * train.sparkSession.sparkContext.defaultParallelism else parallelism      # each fit caches its rows
        n_rows = n * (folds - 1) // folds                # rows that each fold's fit sees
        est = build_estimator(model, None, n_rows)
        ev = MulticlassClassificationEvaluator(labelCol=LABEL, metricName="fMeasureByLabel", metricLabel=1.0, beta=1.0)
        cv = CrossValidator(estimator=est, estimatorParamMaps=_param_maps(est, model, points, n_rows), evaluator=ev,
                            numFolds=folds, foldCol="fold", parallelism=parallelism, seed=seed)
        with split_by_file(train.sparkSession, n):
            data = held_rows(prepare(sample, features, model), n, ("fold",), source=table)
            means = cv.fit(data).avgMetrics
            data.unpersist()
        if table is not None:
            drop_table(table)
    best_i = max(range(len(points)), key=lambda i: (means[i], -i))
    return points[best_i], float(means[best_i])


def random_search_cv(train: DataFrame, features: list[str], model: str, n_iter: int = 10, folds: int = 3,
                     subsample: float = 1.0, seed: int = SEED, parallelism: int = 4, min_rows: int = TUNING_MIN_ROWS):
    """``random_search``, then refit on all training rows.  Returns (refit model, best params, best CV F1)."""
    best, f1 = random_search(train, features, model, n_iter, folds, subsample, seed, parallelism, min_rows)
    return fit_model(train, features, model, best), best, f1


def best_params_frame(spark: SparkSession, best: dict[str, dict[str, Any]]) -> DataFrame:
    """Long ``(model, param, value)`` of the tuned parameters."""
    rows = [(m, k, None if v is None else str(v)) for m, p in best.items() for k, v in p.items()]
    return spark.createDataFrame(rows, "model string, param string, value string")


def best_params_table(long: DataFrame) -> DataFrame:
    """Wide table, one row per model, one column per parameter (NULL if unused)."""
    return long.groupBy("model").pivot("param").agg(F.first("value"))


def feature_importance(fitted, features: list[str]) -> DataFrame:
    """``(feature, importance)`` of a tree model, sorted descending."""
    spark = SparkSession.getActiveSession()
    imp = fitted.featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(features, [float(x) for x in imp])), "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature")


def tune_all(train: DataFrame, test: DataFrame, features: list[str], models: list[str] | None = None,
             n_iter: int = 10, folds: int = 3, subsample: float = 1.0, seed: int = SEED):
    """Random search for every model; returns (best params per model, scored test rows, refit models)."""
    best, scored, fitted = {}, None, {}
    for m in models or MODEL_NAMES:
        refit, params, _ = random_search_cv(train, features, m, n_iter, folds, subsample, seed)
        best[m], fitted[m] = params, refit
        s = score(refit, test, features, m)
        scored = s if scored is None else scored.unionByName(s)
    return best, scored, fitted
