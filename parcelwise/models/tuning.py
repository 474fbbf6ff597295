"""Seeded random search over boosted-tree parameters and its history."""

from __future__ import annotations

import json
import math
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.models.boosting import fit_all
from parcelwise.models.estimators import LABEL, evaluate, gradient_boosting, shared_rows
from parcelwise.scale import MAX_GROUP_ROWS

# Search ranges.
SEARCH_RANGES = {
    "num_leaves": (31, 255),
    "learning_rate": (0.01, 0.3),
    "feature_fraction": (0.5, 1.0),
    "subsample": (0.5, 1.0),
    "min_child_samples": (5, 100),
    "n_estimators": (500, 2000),
}


def sample_params(trials: int, seed: int = 42, ranges: dict[str, tuple[float, float]] | None = None) -> list[dict]:
    """Draws from the ranges; the learning rate is drawn log-uniformly, a leaf limit becomes a depth."""
    r = {**SEARCH_RANGES, **(ranges or {})}
    draw = random.Random(seed)
    found = []
    for _ in range(trials):
        leaves = draw.randint(*map(int, r["num_leaves"]))
        low, high = r["learning_rate"]
        found.append(
            {
                "maxDepth": max(1, math.ceil(math.log2(leaves))),
                "stepSize": math.exp(draw.uniform(math.log(low), math.log(high))),
                "featureSubsetStrategy": f"{draw.uniform(*r['feature_fraction']):.3f}",
                "subsamplingRate": draw.uniform(*r["subsample"]),
                "minInstancesPerNode": draw.randint(*map(int, r["min_child_samples"])),
                "maxIter": draw.randint(*map(int, r["n_estimators"])),
            }
        )
    return found


def random_search(
    train: DataFrame,
    val: DataFrame,
    trials: int = 20,
    seed: int = 42,
    ranges: dict[str, tuple[float, float]] | None = None,
    parallelism: int = 2,
    max_rows: int = MAX_GROUP_ROWS,
) -> tuple[dict, DataFrame]:
    """(best parameters, one row per trial). The objective is the mean absolute error of prices.

    Up to `max_rows` training rows a task fits a trial; of more rows Spark's learner fits `parallelism` at a time."""
    drawn = sample_params(trials, seed, ranges)
    estimators = [gradient_boosting(**params) for params in drawn]
    rows = train.select(LABEL, "features")

    def error(model) -> float:
        return evaluate(model, val).first()["mae"]

    if rows.count() <= max_rows:
        scores = [error(model) for model in fit_all(estimators, rows)]
    else:
        kept = shared_rows(rows)
        try:
            with ThreadPoolExecutor(parallelism) as pool:
                scores = list(pool.map(lambda estimator: error(estimator.fit(kept)), estimators))
        finally:
            kept.unpersist()
    rows = [(i, float(s), json.dumps(p, sort_keys=True)) for i, (s, p) in enumerate(zip(scores, drawn))]
    table = train.sparkSession.createDataFrame(rows, "trial INT, value DOUBLE, params STRING")
    return drawn[min(range(trials), key=scores.__getitem__)], table


def search_history(studies: DataFrame, study: str, document: str) -> DataFrame:
    """Trials of search documents `{"trials": [{"value": x}, ...]}` with the best value so far.

    Each document is a history of its own, also where a study has several; the minimum runs inside its row."""
    parsed = F.from_json(document, "trials ARRAY<STRUCT<value: DOUBLE>>")
    values = studies.select(study, parsed["trials"]["value"].alias("__values"))

    def step(value: Column, i: Column) -> Column:
        best = F.array_min(F.slice("__values", 1, i + 1))
        return F.struct(i.alias("trial"), value.alias("value"), best.alias("best_so_far"))

    return values.select(study, F.inline(F.transform("__values", step)))
