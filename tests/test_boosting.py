"""Boosted trees grown in a task against Spark's learner, and the settings of the queries that fit models."""

import random

import numpy as np
import pytest
from pyspark.ml.linalg import DenseVector
from pyspark.sql import functions as F

from parcelwise.models import boosting, estimators, tuning
from parcelwise.models.boosting import fit_all, follows, thresholds
from parcelwise.models.estimators import best_round, compare_models, evaluate, fit_patient, gradient_boosting
from parcelwise.models.tuning import SEARCH_RANGES, random_search, sample_params
from parcelwise.plans import modeling


def frame(spark, n, signal=1.0, seed=7):
    """Sales with two features that matter and one that does not, in values that repeat."""
    draw, rows = random.Random(seed), []
    for i in range(n):
        x = [float(draw.randrange(200)), round(draw.random(), 3), float(draw.randrange(9))]
        label = 10 + signal * (x[0] / 100 + (x[1] > 0.4) * x[2] / 9) + draw.gauss(0, 0.3)
        rows.append((i, float(np.expm1(label)), label, DenseVector(x)))
    return spark.createDataFrame(rows, ["id", "price", "label", "features"]).repartition(3).persist()


@pytest.fixture(scope="module")
def rows(spark):
    return frame(spark, 700)


def predictions(model, rows):
    return np.array([r[0] for r in model.transform(rows).orderBy("id").select("prediction").collect()])


@pytest.mark.parametrize("depth", [1, 4])
def test_trees_of_a_task_predict_as_those_of_spark(rows, depth):
    """Without draws the rules leave one result."""
    estimator = gradient_boosting(maxIter=6, maxDepth=depth, subsamplingRate=1.0, stepSize=0.3)
    own = next(fit_all([estimator], rows))
    theirs = estimator.fit(rows)
    assert own.getNumTrees == 6
    assert np.allclose(predictions(own, rows), predictions(theirs, rows), rtol=1e-9)
    for loss in ("squared", "absolute"):
        assert np.allclose(own.evaluateEachIteration(rows, loss), theirs.evaluateEachIteration(rows, loss), rtol=1e-9)


def test_draws_do_not_depend_on_partitions_and_models_keep_their_places(rows):
    wanted = [gradient_boosting(maxIter=n, maxDepth=3, featureSubsetStrategy="0.6") for n in (2, 5, 3)]
    a = list(fit_all(wanted, rows))
    b = list(fit_all(wanted, rows.repartition(7)))
    assert [m.getNumTrees for m in a] == [2, 5, 3]
    assert all((predictions(x, rows) == predictions(y, rows)).all() for x, y in zip(a, b))
    # A longer run begins with the trees of a shorter one.
    assert (predictions(a[1].first(3), rows) == predictions(a[2], rows)).all()


def test_thresholds_lie_between_values_or_at_quantiles():
    assert thresholds(np.array([3.0, 1.0, 3.0, 7.0]), 4).tolist() == [2.0, 5.0]
    assert thresholds(np.full(5, 2.0), 4).tolist() == []
    cuts = thresholds(np.arange(1000.0), 32)
    assert len(cuts) == 31 and np.abs(np.diff(np.searchsorted(np.arange(1000.0), cuts)) - 31.25).max() <= 1


def test_what_spark_refuses_is_refused(spark, rows):
    estimator = gradient_boosting(maxIter=1)
    with pytest.raises(Exception, match="labels must not be null"):
        next(fit_all([estimator], rows.withColumn("label", F.when(F.col("id") > 0, F.col("label")))))
    with pytest.raises(ValueError, match="no rows"):
        next(fit_all([estimator], rows.filter("id < 0")))
    assert follows(estimator)
    assert not follows(gradient_boosting(True)) and not follows(gradient_boosting(lossType="absolute"))


def test_best_round_waits_for_patience():
    assert best_round([5.0, 4.0, 4.5, 4.4, 3.0, 9.0], 3) == 5
    assert best_round([5.0, 4.0, 4.5, 4.4, 3.0, 9.0], 2) == 2
    assert best_round([float("nan")] * 4, 2) == 4


@pytest.mark.parametrize("task_rows", [10_000, 10])
def test_early_stopping_keeps_all_rounds_up_to_the_best(spark, rows, monkeypatch, task_rows):
    """Small steps bring less than one percent each, at which Spark's own rule ends after the first tree."""
    monkeypatch.setattr(estimators, "TASK_ROWS", task_rows)
    train, val = rows.filter("id < 500"), rows.filter("id >= 500")
    model = fit_patient(gradient_boosting(maxIter=24, stepSize=0.002, maxDepth=4, subsamplingRate=1.0), train, val, patience=6)
    assert model.getNumTrees == 24
    noise = frame(spark, 400, signal=0.0)
    train, val = noise.filter("id < 300"), noise.filter("id >= 300")
    fast = gradient_boosting(maxIter=40, stepSize=0.5, maxDepth=5, minInstancesPerNode=1, subsamplingRate=1.0)
    stopped = fit_patient(fast, train, val, patience=4)
    whole = next(fit_all([fast], train)).evaluateEachIteration(val, "absolute")
    assert stopped.getNumTrees == best_round(whole, 4) < 40
    assert evaluate(stopped, val).first()["n"] == 100


def test_search_runs_every_round_of_every_trial(rows, monkeypatch):
    ranges = {"num_leaves": (4, 8), "n_estimators": (20, 30)}
    train, val = rows.filter("id < 500"), rows.filter("id >= 500")
    grown = []
    monkeypatch.setattr(
        tuning, "fit_all", lambda wanted, df: (grown.append(m.getNumTrees) or m for m in boosting.fit_all(wanted, df))
    )
    best, trials = random_search(train, val, trials=3, ranges=ranges)
    drawn = sample_params(3, ranges=ranges)
    assert grown == [p["maxIter"] for p in drawn]
    found = [r["value"] for r in trials.orderBy("trial").collect()]
    assert best == drawn[int(np.argmin(found))]
    # Beyond the rows of a task Spark's learner does the same with draws of its own.
    _, spread = random_search(train, val, trials=3, ranges=ranges, max_rows=100)
    assert np.allclose(found, [r["value"] for r in spread.orderBy("trial").collect()], rtol=0.2)


def test_comparison_grows_the_trees_asked_for(rows, monkeypatch):
    sizes = []
    seen = estimators.evaluate
    monkeypatch.setattr(estimators, "evaluate", lambda model, df: sizes.append(model.getNumTrees) or seen(model, df))
    models = {"boosted": gradient_boosting(maxIter=30), "forest": estimators.random_forest(numTrees=7, maxDepth=3)}
    table = compare_models(models, rows.filter("id < 500"), rows.filter("id >= 500")).collect()
    assert sizes == [30, 7] and [r["model"] for r in table] == ["boosted", "forest"]
    assert all(r["r2"] > 0.5 and r["train_seconds"] > 0 for r in table)


@pytest.fixture
def fits(monkeypatch):
    """What the plans ask of the operators, without the tables."""
    asked = {}
    monkeypatch.setattr(modeling, "model_rows", lambda spark, folder: None)
    monkeypatch.setattr(modeling, "_by_date", lambda rows: ("train", "later"))
    monkeypatch.setattr(modeling, "compare_models", lambda models, *rows: asked.update(models))
    monkeypatch.setattr(modeling, "fit_patient", lambda estimator, *rows, **o: asked.update(boosted=estimator, **o))
    monkeypatch.setattr(modeling, "evaluate", lambda model, rows: None)
    monkeypatch.setattr(modeling, "random_search", lambda *rows, **o: asked.update(search=o) or (None, None))
    return asked


def test_model_comparison_fits_whole_models(spark, fits):
    """500 rounds of some 31 leaves, 200 trees of depth 15."""
    modeling.m21(spark, "")
    assert (fits["boosted"].getMaxIter(), fits["boosted"].getMaxDepth()) == (500, 5)
    assert (fits["forest"].getNumTrees(), fits["forest"].getMaxDepth()) == (200, 15)


def test_gradient_boosting_may_take_a_thousand_rounds(spark, fits):
    """1000 rounds of some 255 leaves at most, and 50 rounds of patience by default."""
    modeling.m6(spark, "")
    assert (fits["boosted"].getMaxIter(), fits["boosted"].getMaxDepth()) == (1000, 8)
    assert fits.get("patience", 50) == 50


def test_search_draws_from_the_whole_ranges(spark, fits):
    modeling.m9(spark, "")
    assert fits["search"] == {}
    drawn = sample_params(20)
    low, high = SEARCH_RANGES["n_estimators"]
    assert len(drawn) == 20 and all(low <= p["maxIter"] <= high and p["maxDepth"] >= 5 for p in drawn)
