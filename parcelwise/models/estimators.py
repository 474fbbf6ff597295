"""Regressors on the log price, their importances and comparison."""

from __future__ import annotations

import math
import time
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.features import log_target, price_from_log
from parcelwise.models.boosting import BoostedTrees, fit_all, follows
from parcelwise.operators.metrics import regression_metrics

LABEL = "label"
VALIDATION = "is_validation"

TASK_ROWS = 250_000
"""Training rows of one task. Tree learners hold them as objects of some 200 bytes."""


def with_label(df: DataFrame, price: str = "price") -> DataFrame:
    return df.withColumn(LABEL, log_target(price))


def gradient_boosting(early_stop: bool = False, **params) -> GBTRegressor:
    """Boosted trees; with `early_stop`, rows flagged `is_validation` decide when to stop."""
    settings = {
        "featuresCol": "features", "labelCol": LABEL, "maxIter": 100, "stepSize": 0.05, "maxDepth": 5,
        "subsamplingRate": 0.8, "minInstancesPerNode": 20, "featureSubsetStrategy": "all", "seed": 42,
    }
    if early_stop:
        settings["validationIndicatorCol"] = VALIDATION
    return GBTRegressor(**{**settings, **params})


def random_forest(**params) -> RandomForestRegressor:
    settings = {
        "featuresCol": "features", "labelCol": LABEL, "numTrees": 100, "maxDepth": 15,
        "minInstancesPerNode": 2, "featureSubsetStrategy": "sqrt", "seed": 42,
    }
    return RandomForestRegressor(**{**settings, **params})


def predict_price(model: Model, df: DataFrame, out: str = "prediction") -> DataFrame:
    """Price predictions: the model output is a log price."""
    scored = model.transform(df)
    return scored.withColumn(out, price_from_log("prediction"))


def evaluate(model: Model, df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    scored = predict_price(model, df).withColumn("actual", F.col("price"))
    return regression_metrics(scored, keys)


def spread(df: DataFrame, task_rows: int | None = None) -> DataFrame:
    """`df` in partitions of at most about `task_rows` rows, and at least one per core.

    Files are dealt to tasks by their bytes, and columns that compress well make that millions of rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // (task_rows or TASK_ROWS))))


def shared_rows(df: DataFrame) -> DataFrame:
    """The same for rows that several models are fitted to: dealt once and kept on disk, so that memory is left to
    the learners. The caller ends it with `unpersist`."""
    return spread(df).persist(StorageLevel.DISK_ONLY)


def fit_spread(estimator: Estimator, df: DataFrame) -> Model:
    """A model of `df`, of which only the columns that learners read are dealt to the tasks."""
    return estimator.fit(spread(df.select(LABEL, "features")))


def _fit_few(estimator: Estimator, df: DataFrame) -> BoostedTrees | None:
    """Boosted trees grown in one task if they are asked for and `df` has at most the rows of a task."""
    return next(fit_all([estimator], df)) if follows(estimator) and df.count() <= TASK_ROWS else None


def best_round(errors: Sequence[float], patience: int) -> int:
    """Rounds up to the least error that `patience` further rounds do not undercut; all if nothing can be measured."""
    if math.isnan(errors[0]):
        return len(errors)
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def fit_patient(estimator: GBTRegressor, train: DataFrame, val: DataFrame, patience: int = 50) -> Model | BoostedTrees:
    """The rounds with the least absolute error of `val`, found when `patience` more rounds bring no better one.

    Rounds depend on earlier ones only, so a longer run, twice as long each time, begins with the same trees."""
    plain = estimator.copy()
    plain.clear(plain.validationIndicatorCol)
    most = plain.getMaxIter()
    rounds = min(2 * patience, most)
    kept = shared_rows(train.select(LABEL, "features"))

    def fitted(n: int) -> tuple[Model | BoostedTrees, bool]:
        own = plain.copy({plain.maxIter: n})
        few = _fit_few(own, kept)
        return few or own.fit(kept), few is not None

    try:
        while True:
            model, few = fitted(rounds)
            best = best_round(model.evaluateEachIteration(val, "absolute"), patience)
            if best + patience <= rounds or rounds == most:
                break
            rounds = min(2 * rounds, most)
        if best == rounds:
            return model
        return model.first(best) if few else fitted(best)[0]
    finally:
        kept.unpersist()


def fit_early_stopping(estimator: GBTRegressor, train: DataFrame, val: DataFrame) -> Model:
    """Spark's own rule: it ends at the first round that brings less than one percent."""
    both = train.withColumn(VALIDATION, F.lit(False)).unionByName(val.withColumn(VALIDATION, F.lit(True)))
    rows = spread(both.select(LABEL, "features", VALIDATION))
    return estimator.copy({estimator.validationIndicatorCol: VALIDATION}).fit(rows)


def importance_table(model: Model, df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per feature with the impurity importance of a tree model."""
    rows = [(name, float(score)) for name, score in zip(names, model.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature STRING, importance DOUBLE")


def compare_models(estimators: dict[str, Estimator], train: DataFrame, test: DataFrame) -> DataFrame:
    """Error metrics and fit seconds per model."""
    kept = shared_rows(train.select(LABEL, "features"))
    try:
        rows = []
        for name, estimator in estimators.items():
            began = time.perf_counter()
            model = _fit_few(estimator, kept) or estimator.fit(kept)
            seconds = time.perf_counter() - began
            m = evaluate(model, test).first()
            rows.append((name, m["mae"], m["rmse"], m["r2"], seconds))
    finally:
        kept.unpersist()
    schema = "model STRING, mae DOUBLE, rmse DOUBLE, r2 DOUBLE, train_seconds DOUBLE"
    return train.sparkSession.createDataFrame(rows, schema)
