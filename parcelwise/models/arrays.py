"""Predictions of fitted linear and tree models on NumPy matrices, for tasks that score many variants of a row.

A variant differs from its row in one feature, so only what depends on that feature is computed again."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Model
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    GBTRegressionModel,
    LinearRegressionModel,
    RandomForestRegressionModel,
)
from pyspark.sql import SparkSession

from parcelwise.scale import fresh_path


class Linear:
    """State: predictions as one column."""

    def __init__(self, coefficients: np.ndarray, intercept: float):
        self.coefficients, self.intercept = coefficients, intercept

    def state(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.coefficients + self.intercept)[:, None]

    def changed(self, state: np.ndarray, x: np.ndarray, feature: int, old: np.ndarray) -> np.ndarray:
        return state + (self.coefficients[feature] * (x[:, feature] - old))[:, None]

    def predictions(self, state: np.ndarray) -> np.ndarray:
        return state[:, 0]

    def uses(self, feature: int) -> bool:
        return bool(self.coefficients[feature])

    def alike(self, feature: int, values: np.ndarray) -> np.ndarray:
        """A number per value; values of the same number give the same predictions."""
        return np.arange(len(values)) if self.uses(feature) else np.zeros(len(values), np.int64)


@dataclass(frozen=True)
class Tree:
    """Node arrays, the root first. A leaf leads to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def __call__(self, x: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(x), np.int32), np.arange(len(x))
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.value[at]


class Trees:
    """State: one column of weighted predictions per tree."""

    def __init__(self, trees: list[Tree], weights: list[float]):
        self.trees, self.weights = trees, weights
        self.cuts: dict[int, np.ndarray] = {}
        self.users: dict[int, list[int]] = {}
        for t, tree in enumerate(trees):
            inner = tree.left != np.arange(len(tree.left))
            for f in np.unique(tree.feature[inner]).tolist():
                self.users.setdefault(f, []).append(t)
                own = tree.threshold[inner & (tree.feature == f)]
                self.cuts[f] = np.union1d(self.cuts.get(f, []), own)

    def state(self, x: np.ndarray) -> np.ndarray:
        return np.stack([w * tree(x) for tree, w in zip(self.trees, self.weights)], axis=1)

    def changed(self, state: np.ndarray, x: np.ndarray, feature: int, old: np.ndarray) -> np.ndarray:
        out = state.copy()
        for t in self.users.get(feature, ()):
            out[:, t] = self.weights[t] * self.trees[t](x)
        return out

    def predictions(self, state: np.ndarray) -> np.ndarray:
        return state.sum(axis=1)

    def uses(self, feature: int) -> bool:
        return feature in self.users

    def alike(self, feature: int, values: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.cuts.get(feature, np.zeros(0)), values, side="left")


def _trees(spark: SparkSession, model: Model) -> list[Tree]:
    """Trees of a model in order, from its saved form."""
    path = fresh_path(spark, "explained-model")
    model.save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "nodeData" in nodes.columns:
        nodes = nodes.select("treeID", "nodeData.*")
    else:
        nodes = nodes.selectExpr("0 AS treeID", "*")
    nodes = nodes.select("treeID", "id", "prediction", "leftChild", "rightChild", "split.*")
    own: dict[int, list] = {}
    for row in nodes.orderBy("treeID", "id").collect():
        own.setdefault(row["treeID"], []).append(row)
    out = []
    for t in sorted(own):
        # Nodes are numbered in pre-order from 0, so children come after their parents.
        rows = own[t]
        inner = np.array([r["leftChild"] >= 0 for r in rows])
        if any(i and r["numCategories"] >= 0 for i, r in zip(inner, rows)):
            raise ValueError("splits of categories are not supported")
        itself = np.arange(len(rows))
        level = np.zeros(len(rows), np.int64)
        for r in rows:
            if r["leftChild"] >= 0:
                level[[r["leftChild"], r["rightChild"]]] = level[r["id"]] + 1
        out.append(
            Tree(
                np.where(inner, [r["featureIndex"] for r in rows], 0).astype(np.int32),
                np.array([r["leftCategoriesOrThreshold"][0] if i else np.inf for i, r in zip(inner, rows)]),
                np.where(inner, [r["leftChild"] for r in rows], itself).astype(np.int32),
                np.where(inner, [r["rightChild"] for r in rows], itself).astype(np.int32),
                np.array([r["prediction"] for r in rows]),
                int(level.max()),
            )
        )
    return out


def on_arrays(spark: SparkSession, model: Model) -> Linear | Trees:
    if isinstance(model, LinearRegressionModel):
        return Linear(model.coefficients.toArray(), float(model.intercept))
    if isinstance(model, RandomForestRegressionModel):
        trees = _trees(spark, model)
        return Trees(trees, [1 / len(trees)] * len(trees))
    if isinstance(model, GBTRegressionModel):
        return Trees(_trees(spark, model), [float(w) for w in model.treeWeights])
    if isinstance(model, DecisionTreeRegressionModel):
        return Trees(_trees(spark, model), [1.0])
    raise TypeError(f"{type(model).__name__} is neither a linear nor a tree model")
