"""Model training, tuning, comparison, scoring and importance on MLlib pipelines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.operators import metrics as M
from shopsight.operators.clean import impute
from shopsight.operators.neighbours import CELL_ROWS, nearest_rows
from shopsight.operators.sampling import hash_split
from shopsight.schemas import numeric_columns
from shopsight.session import materialize, together

CLASSIFIERS = {
    "random_forest": lambda seed: RandomForestClassifier(numTrees=100, maxDepth=10, seed=seed),
    "logistic_regression": lambda seed: LogisticRegression(maxIter=100),
    "gradient_boosting": lambda seed: GBTClassifier(maxIter=100, maxDepth=3, seed=seed),
    "xgboost": lambda seed: GBTClassifier(maxIter=100, maxDepth=6, subsamplingRate=0.8, seed=seed),
    "decision_tree": lambda seed: DecisionTreeClassifier(maxDepth=10, seed=seed),
    "svm": lambda seed: LinearSVC(maxIter=50),
    "naive_bayes": lambda seed: NaiveBayes(modelType="gaussian"),
}
REGRESSORS = {
    "random_forest": lambda seed: RandomForestRegressor(numTrees=100, maxDepth=10, seed=seed),
    "linear_regression": lambda seed: LinearRegression(maxIter=100),
    "gradient_boosting": lambda seed: GBTRegressor(maxIter=100, maxDepth=3, seed=seed),
    "xgboost": lambda seed: GBTRegressor(maxIter=100, maxDepth=6, subsamplingRate=0.8, seed=seed),
    "decision_tree": lambda seed: DecisionTreeRegressor(maxDepth=10, seed=seed),
}

# The tuning grids per model, in the estimator's own parameter names.
GRIDS: dict[str, dict[str, list]] = {
    "random_forest": {"numTrees": [50, 100, 200], "maxDepth": [10, 20, 30], "minInstancesPerNode": [1, 2, 4]},
    "xgboost": {"maxIter": [50, 100, 200], "maxDepth": [3, 6, 10], "stepSize": [0.01, 0.1, 0.2], "subsamplingRate": [0.8, 1.0]},
    "logistic_regression": {"regParam": [10.0, 1.0, 0.1], "elasticNetParam": [1.0, 0.0]},
}
GRIDS["gradient_boosting"] = GRIDS["xgboost"]


def _registry(task: str) -> dict:
    if task not in ("classification", "regression"):
        raise ValueError(f"unknown task: {task}")
    return CLASSIFIERS if task == "classification" else REGRESSORS


def _estimator(model: str, task: str, seed: int, params: Mapping | None = None):
    registry = _registry(task)
    if model not in registry:
        raise ValueError(f"unknown {task} model: {model}")
    est = registry[model](seed).setLabelCol("label").setFeaturesCol("features")
    return est.copy({est.getParam(k): v for k, v in params.items()}) if params else est


def build_pipeline(features: Sequence[str], model: str, task: str, seed: int = 42, params: Mapping | None = None, weight: str | None = None) -> Pipeline:
    est = _estimator(model, task, seed, params)
    if weight and est.hasParam("weightCol"):
        est = est.setWeightCol(weight)
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="raw_features", handleInvalid="keep"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
            est,
        ]
    )


def prepare(df: DataFrame, key: str, label: str = "label", features: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Key, numeric features (NULL -> median) and label, materialised once for all fits."""
    features = list(features or [c for c in numeric_columns(df) if c not in (key, label)])
    filled = impute(df.select(key, *[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("double").alias("label")), features, [])
    return materialize(filled), features


def with_probability(scored: DataFrame) -> DataFrame:
    """Positive-class probability; models without one (linear SVM) give a logistic of the margin."""
    if "probability" in scored.columns:
        return scored.withColumn("score", vector_to_array("probability")[1])
    if "rawPrediction" in scored.columns:
        return scored.withColumn("score", 1 / (1 + F.exp(-vector_to_array("rawPrediction")[1])))
    return scored


def evaluate(scored: DataFrame, task: str) -> DataFrame:
    """``(metric, value)`` of a scored table."""
    if task == "classification":
        return M.classification_metrics(with_probability(scored).select("label", "prediction", "score"), "label", "prediction", "score")
    return M.regression_metrics(scored)


def _cv_evaluator(task: str, scoring: str | None = None):
    if task == "classification":
        if scoring == "roc_auc":
            return BinaryClassificationEvaluator(metricName="areaUnderROC")
        return MulticlassClassificationEvaluator(metricName=scoring or "accuracy")
    return RegressionEvaluator(metricName=scoring or "r2")


def with_folds(df: DataFrame, key: str, folds: int, seed: int = 42) -> DataFrame:
    """``fold`` 0..folds-1 by key hash, the same on every run."""
    return df.withColumn("fold", F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(folds)).cast("int"))


def cross_validate(
    df: DataFrame, key: str, features: Sequence[str], model: str, task: str, folds: int = 5, scoring: str | None = None, seed: int = 42, parallelism: int = 4
) -> DataFrame:
    """``(model, scoring, mean, std, min, max, folds)`` over hash folds."""
    cv = CrossValidator(
        estimator=build_pipeline(features, model, task, seed),
        estimatorParamMaps=[{}],
        evaluator=_cv_evaluator(task, scoring),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        collectSubModels=True,
    )
    data = with_folds(df, key, folds, seed)
    fitted = cv.fit(data)
    scores = [
        _cv_evaluator(task, scoring).evaluate(models[0].transform(data.filter(F.col("fold") == i)))
        for i, models in enumerate(fitted.subModels)
    ]
    name = scoring or ("accuracy" if task == "classification" else "r2")
    row = (model, name, float(np.mean(scores)), float(np.std(scores)), float(min(scores)), float(max(scores)), folds)
    return df.sparkSession.createDataFrame(
        [row], "model STRING, scoring STRING, mean DOUBLE, std DOUBLE, min DOUBLE, max DOUBLE, folds INT"
    )


def train(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    model: str,
    task: str,
    test_pct: int = 20,
    seed: int = 42,
    params: Mapping | None = None,
    weight: str | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """Fitted pipeline and its ``(model, metric, value)`` table on held-out rows."""
    train_df, test_df = hash_split(df, [key], test_pct, seed)
    fitted = build_pipeline(features, model, task, seed, params, weight).fit(train_df)
    scored = fitted.transform(test_df)
    return fitted, evaluate(scored, task).withColumn("model", F.lit(model)).select("model", "metric", "value")


def _first_trees(model, n: int | None):
    """A boosted model as the fit of ``n`` iterations leaves it; other models as they are."""
    if n is None or n >= model.getNumTrees:
        return model
    java = model._java_obj
    trees = SparkContext._gateway.new_array(SparkContext._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = SparkContext._gateway.new_array(SparkContext._jvm.double, n)
    for i, (tree, weight) in enumerate(zip(java.trees()[:n], model.treeWeights[:n], strict=True)):
        trees[i], weights[i] = tree, weight
    if isinstance(model, GBTClassificationModel):
        short = SparkContext._jvm.org.apache.spark.ml.classification.GBTClassificationModel(
            java.uid(), trees, weights, model.numFeatures, model.numClasses
        )
    else:
        short = SparkContext._jvm.org.apache.spark.ml.regression.GBTRegressionModel(java.uid(), trees, weights, model.numFeatures)
    return type(model)(java.copyValues(short, java.extractParamMap()))


def tune(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    model: str,
    task: str,
    grid: Mapping[str, Sequence] | None = None,
    folds: int = 3,
    scoring: str | None = None,
    test_pct: int = 20,
    seed: int = 42,
    parallelism: int = 4,
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Best pipeline, the grid with its scores, held-out metrics. Models without a grid are trained as they are."""
    grid = GRIDS.get(model) if grid is None else grid
    spark = df.sparkSession
    if not grid:
        fitted, metrics = train(df, key, features, model, task, test_pct, seed)
        return fitted, spark.createDataFrame([("{}", None, True)], "params STRING, score DOUBLE, is_best BOOLEAN"), metrics
    train_df, test_df = hash_split(df, [key], test_pct, seed)
    pipeline = build_pipeline(features, model, task, seed)
    est = pipeline.getStages()[-1]
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(est.getParam(name), list(values))
    maps = builder.build()
    evaluator = _cv_evaluator(task, scoring)
    data = with_folds(train_df, key, folds, seed)

    # boosting goes tree by tree, so points that differ in the number of trees only are read off one fit of the most
    steps = est.getParam("maxIter") if isinstance(est, (GBTClassifier, GBTRegressor)) else None
    alike: dict[tuple, list[int]] = {}
    for i, m in enumerate(maps):
        alike.setdefault(tuple((p.name, v) for p, v in m.items() if p != steps), []).append(i)

    def scored(run: tuple[int, list[int]]) -> list[float]:
        fold, points = run
        params = max((maps[i] for i in points), key=lambda m: m.get(steps, 0))
        fitted = pipeline.fit(data.filter(F.col("fold") != fold), params)
        ready = PipelineModel(fitted.stages[:-1]).transform(data.filter(F.col("fold") == fold))
        return [evaluator.evaluate(_first_trees(fitted.stages[-1], maps[i].get(steps)).transform(ready)) for i in points]

    # the fits of all folds and all points of the grid share the cluster
    groups = list(alike.values())
    found = together(scored, [(fold, points) for fold in range(folds) for points in groups], parallelism)
    by_fold = np.empty((folds, len(maps)))
    for at, values in enumerate(found):
        by_fold[at // len(groups), groups[at % len(groups)]] = values
    scores = np.mean(by_fold, axis=0)
    best = int(np.argmax(scores) if evaluator.isLargerBetter() else np.argmin(scores))
    rows = [(str({p.name: v for p, v in m.items()}), float(s), i == best) for i, (m, s) in enumerate(zip(maps, scores))]
    table = spark.createDataFrame(rows, "params STRING, score DOUBLE, is_best BOOLEAN")
    fitted = pipeline.fit(data, maps[best])
    metrics = evaluate(fitted.transform(test_df), task).withColumn("model", F.lit(model))
    return fitted, table, metrics.select("model", "metric", "value")


def compare(
    df: DataFrame, key: str, features: Sequence[str], models: Sequence[str], task: str, seed: int = 42
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """All models on the same split, ranked by accuracy or R2: ``(model, metric, value, rank)``."""
    fitted, results = {}, None
    found = together(lambda name: train(df, key, features, name, task, seed=seed), models)
    for name, (model, metrics) in zip(models, found, strict=True):
        fitted[name] = model
        results = metrics if results is None else results.unionByName(metrics)
    results = materialize(results)
    main = "accuracy" if task == "classification" else "r2"
    ranks = M.rank_models(results, main).select("model", "rank")
    return fitted, results.join(F.broadcast(ranks), "model")


def score(model: PipelineModel, df: DataFrame, key: str, task: str) -> DataFrame:
    """Batch scoring: key, prediction and, for classifiers, probability of the positive class."""
    out = model.transform(df)
    if task == "classification":
        return with_probability(out).select(key, "prediction", F.col("score").alias("probability"))
    return out.select(key, "prediction")


def importance(model: PipelineModel, features: Sequence[str], top_k: int = 20) -> DataFrame:
    """``(feature, importance, share_pct, rank)`` from tree importance or absolute coefficients."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    elif hasattr(last, "coefficients"):
        values = np.abs(last.coefficients.toArray())
    else:
        raise ValueError("the model reports no importance")
    total = float(values.sum())
    order = sorted(range(len(features)), key=lambda i: (-values[i], features[i]))[:top_k]
    rows = [(features[i], float(values[i]), float(values[i]) / total * 100 if total else 0.0, r + 1) for r, i in enumerate(order)]
    from pyspark.sql import SparkSession

    return SparkSession.active().createDataFrame(rows, "feature STRING, importance DOUBLE, share_pct DOUBLE, rank INT")


def learning_curve(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    model: str,
    task: str,
    sizes: Sequence[float] = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0),
    folds: int = 3,
    scoring: str | None = None,
    seed: int = 42,
) -> DataFrame:
    """``(size, train_score, test_score, gap, is_overfitting)``: nested hash fractions, mean over folds."""
    data = with_folds(df, key, folds, seed)
    share = F.pmod(F.xxhash64(F.col(key), F.lit(seed + 1)), F.lit(10_000)) / 10_000
    evaluator = _cv_evaluator(task, scoring)

    def scores(run: tuple[float, int]) -> tuple[float, float]:
        size, fold = run
        part = data.filter((F.col("fold") != fold) & (share < size))
        fitted = build_pipeline(features, model, task, seed).fit(part)
        rest = data.filter(F.col("fold") == fold)
        return evaluator.evaluate(fitted.transform(part)), evaluator.evaluate(fitted.transform(rest))

    runs = [(size, fold) for size in sizes for fold in range(folds)]
    found = together(scores, runs)
    rows = []
    for i, size in enumerate(sizes):
        a, b = (float(x) for x in np.mean(found[i * folds : (i + 1) * folds], axis=0))
        rows.append((float(size), a, b, a - b, a - b > 0.1))
    return df.sparkSession.createDataFrame(
        rows, "size DOUBLE, train_score DOUBLE, test_score DOUBLE, gap DOUBLE, is_overfitting BOOLEAN"
    )


def ensemble(scored: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Mean probability of several scored tables and the class it implies."""
    out = None
    for df in scored.values():
        part = df.select(key, "probability")
        out = part if out is None else out.unionByName(part)
    mean = out.groupBy(key).agg(F.avg("probability").alias("probability"))
    return mean.withColumn("prediction", (F.col("probability") >= 0.5).cast("double"))


# --- nearest neighbours -------------------------------------------------------------

def nearest_neighbours(
    train_df: DataFrame,
    query_df: DataFrame,
    key: str,
    features: Sequence[str],
    label: str = "label",
    k: int = 5,
    rows_per_block: int = 8192,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Majority label of the k nearest training rows (ties: smallest label), exact."""
    near = nearest_rows(train_df, query_df, key, features, label, k, rows_per_block, cell_rows)
    return near.groupBy(F.col("id").alias(key)).agg(
        F.mode(F.col("y"), True).alias("prediction"), F.avg("y").alias("probability")
    )
