"""Boosted trees of estimators that share their training rows, each estimator fitted in a task of its own.

Spark's learner runs a job per level of every tree, which takes some 80 ms however few the rows are, so that the
thousands of rounds of a search spend their time there. Here a task holds one byte per value and grows whole
trees. The rules are those of `GBTRegressor` for squared errors: 32 bins by quantiles, splits by variance, the first
tree on the labels with weight 1, each later one on twice the residuals with weight `stepSize`, rows drawn per tree and
features per node. Callers bound the rows and leave more of them to Spark's learner."""

from __future__ import annotations

import json
import math
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise.scale import written

SETTINGS = {
    "featuresCol", "labelCol", "maxIter", "stepSize", "maxDepth", "subsamplingRate", "minInstancesPerNode",
    "featureSubsetStrategy", "seed", "maxBins",
}

BLOCK_ROWS = 65_536
ENTRIES = 50_000
"""Values counted at once: keeps the index arrays beside the bytes in the processor's cache."""


def follows(estimator) -> bool:
    """Whether every parameter that is set has its counterpart here."""
    return isinstance(estimator, GBTRegressor) and {p.name for p in estimator.params if estimator.isSet(p)} <= SETTINGS


def thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds of a feature: between all values if they are few, else at the quantiles, as Spark places them."""
    found, counts = np.unique(values, return_counts=True)
    if len(found) <= bins:
        return (found[:-1] + found[1:]) / 2
    total = np.cumsum(counts)
    between, stride = total[:-1] + total[1:], total[-1] / bins
    cuts, at, target = [], 0, stride
    while (at := max(at, int(np.searchsorted(between, 2 * target, side="right")))) < len(between):
        cuts.append((found[at] + found[at + 1]) / 2)
        at, target = at + 1, target + stride
    return np.array(cuts)


def binned(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Bytes by feature and row: the number of thresholds below the value."""
    out = np.empty((len(cuts), len(x)), np.uint8)
    for f, c in enumerate(cuts):
        out[f] = np.searchsorted(c, x[:, f], side="left")
    return out


@dataclass(frozen=True)
class Tree:
    """Node arrays, the root first. Rows of a bin beyond `cut` go to the node after `left`; a leaf leads to itself."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    depth: int

    def __call__(self, bins: np.ndarray) -> np.ndarray:
        n = bins.shape[1]
        at, flat, rows = np.zeros(n, np.intp), bins.reshape(-1), np.arange(n)
        start = self.feature.astype(np.intp) * n
        for _ in range(self.depth):
            at = self.left[at] + (flat[start[at] + rows] > self.cut[at])
        return self.value[at]


def grow(
    bins: np.ndarray, y: np.ndarray, splits: np.ndarray, depth: int, least: int, features: int, draw: np.random.Generator
) -> Tree:
    """One tree of the rows given; `splits` has the number of thresholds per feature."""
    width, total = int(splits.max(initial=0)) + 1, len(bins)
    possible = np.arange(width - 1) < splits[:, None]
    feature, cut, left, value = [], [], [], []
    at, nodes, level = np.zeros(len(y), np.intp), 1, 0
    while nodes:
        n, s = np.bincount(at, minlength=nodes), np.bincount(at, y, nodes)
        first = len(value)
        feature += [0] * nodes
        cut += [255] * nodes
        left += range(first, first + nodes)
        value += (s / n).tolist()
        if level == depth or width == 1:
            break
        gain = np.full((nodes, total, width - 1), -np.inf)
        step = max(1, min(total, ENTRIES // len(y)))
        base = at * width + (np.arange(step) * (nodes * width))[:, None]
        keys, weights = np.empty_like(base), np.tile(y, step)
        for f in range(0, total, step):
            some = bins[f : f + step]
            shape, size = (len(some), nodes, width), len(some) * nodes * width
            key = keys[: len(some)]
            np.copyto(key, some)
            key += base[: len(some)]
            key = key.reshape(-1)
            c = np.bincount(key, minlength=size).reshape(shape).cumsum(2)[:, :, :-1]
            t = np.bincount(key, weights[: len(key)], size).reshape(shape).cumsum(2)[:, :, :-1]
            rest = n[:, None] - c
            allowed = (c >= max(least, 1)) & (rest >= max(least, 1)) & possible[f : f + step, None, :]
            with np.errstate(divide="ignore", invalid="ignore"):
                found = t * t / c + (s[:, None] - t) ** 2 / rest - (s * s / n)[:, None]
            gain[:, f : f + step] = np.where(allowed, found, -np.inf).swapaxes(0, 1)
        if features < total:
            drawn = draw.random((nodes, total)).argsort(1).argsort(1) < features
            gain[~drawn] = -np.inf
        flat = gain.reshape(nodes, -1)
        best = flat.argmax(1)
        goes_on = flat[np.arange(nodes), best] > 0
        by, where = best // (width - 1), best % (width - 1)
        child = 2 * (np.cumsum(goes_on) - 1)
        for k in np.flatnonzero(goes_on):
            feature[first + k], cut[first + k], left[first + k] = int(by[k]), int(where[k]), first + nodes + int(child[k])
        kept = goes_on[at]
        if not kept.all():
            at, bins, y = at[kept], bins[:, kept], y[kept]
        beyond = bins.reshape(-1)[by[at] * len(y) + np.arange(len(y))] > where[at]
        at, nodes, level = child[at] + beyond, 2 * int(goes_on.sum()), level + 1
    arrays = np.array(feature, np.uint16), np.array(cut, np.uint8), np.array(left, np.int32), np.array(value)
    return Tree(*arrays, level)


def features_per_node(strategy: str, features: int) -> int:
    named = {"all": features, "auto": features, "sqrt": math.sqrt(features), "log2": math.log2(features), "onethird": features / 3}
    share = named.get(strategy)
    if share is None:
        share = min(int(strategy), features) if strategy.isdigit() else float(strategy) * features
    return max(1, math.ceil(share))


def boost(bins: np.ndarray, label: np.ndarray, splits: np.ndarray, p: dict) -> list[Tree]:
    draw = np.random.default_rng(p["seed"] & (2**63 - 1))
    features, score, trees = features_per_node(p["featureSubsetStrategy"], len(bins)), np.zeros(len(label)), []
    for i in range(p["maxIter"]):
        target = 2 * (label - score) if i else label
        rows, own = bins, target
        if p["subsamplingRate"] < 1:
            chosen = draw.random(len(label)) < p["subsamplingRate"]
            if chosen.any():
                rows, own = bins[:, chosen], target[chosen]
        tree = grow(rows, own, splits, p["maxDepth"], p["minInstancesPerNode"], features, draw)
        score += (p["stepSize"] if i else 1.0) * tree(bins)
        trees.append(tree)
    return trees


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted model that scores frames as Spark's models do, without the vector column in its result."""

    cuts: list[np.ndarray]
    trees: list[Tree]
    step: float
    features: str = "features"
    label: str = "label"

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    def first(self, rounds: int) -> BoostedTrees:
        return BoostedTrees(self.cuts, self.trees[:rounds], self.step, self.features, self.label)

    def rounds(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """Predictions after each round, in one array that is added to."""
        bins, score = binned(x, self.cuts), np.zeros(len(x))
        for i, tree in enumerate(self.trees):
            score += (self.step if i else 1.0) * tree(bins)
            yield score

    def transform(self, df: DataFrame) -> DataFrame:
        kept, width = [c for c in df.columns if c != self.features], len(self.cuts)

        def scored(batches):
            for batch in batches:
                score = np.zeros(0)
                for score in self.rounds(_matrix(batch.column("__x"), width)):
                    pass
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(score, pa.float64())], [*kept, "prediction"])

        rows = df.select(*[f"`{c}`" for c in kept], vector_to_array(self.features).alias("__x"))
        fields = [*[rows.schema[c] for c in kept], T.StructField("prediction", T.DoubleType())]
        return rows.mapInArrow(scored, T.StructType(fields))

    def evaluateEachIteration(self, df: DataFrame, loss: str = "squared") -> list[float]:
        """Mean loss after each round."""
        power, width = {"squared": 2, "absolute": 1}[loss], len(self.cuts)

        def sums(batches):
            total, n = np.zeros(len(self.trees)), 0
            for batch in batches:
                y, n = batch.column("__y").to_numpy(zero_copy_only=False), n + batch.num_rows
                for i, score in enumerate(self.rounds(_matrix(batch.column("__x"), width))):
                    total[i] += (np.abs(y - score) ** power).sum()
            yield pa.RecordBatch.from_pydict({"n": [n], "total": pa.array([total.tolist()], pa.list_(pa.float64()))})

        rows = df.select(F.col(self.label).cast("double").alias("__y"), vector_to_array(self.features).alias("__x"))
        parts = rows.mapInArrow(sums, "n BIGINT, total ARRAY<DOUBLE>").collect()
        return (np.sum([r["total"] for r in parts], axis=0) / max(1, sum(r["n"] for r in parts))).tolist()


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    if column.null_count:
        raise ValueError("feature vectors must not be null")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _parts(rows: DataFrame, label: str, features: str, max_bins: int) -> DataFrame:
    """Thresholds and blocks of binned rows. One task sorts the rows, so that draws fall on the same rows always."""

    def parts(batches):
        found = [(b.column("y").to_numpy(zero_copy_only=False), b.column("x")) for b in batches if b.num_rows]
        if not found:
            return
        y = np.concatenate([v for v, _ in found])
        if not np.isfinite(y).all():
            raise ValueError("labels must not be null, NaN or infinite")
        width = len(found[0][1][0])
        matrices = [_matrix(x, width) for _, x in found]
        if not all(np.isfinite(m).all() for m in matrices):
            raise ValueError("feature vectors to fit to must not contain NaN or infinite values")
        cuts = [thresholds(np.concatenate([m[:, f] for m in matrices]), max_bins) for f in range(width)]
        bins = np.concatenate([binned(m, cuts) for m in matrices], axis=1)
        for i in range(0, len(y), BLOCK_ROWS):
            own = pickle.dumps((cuts, y[i : i + BLOCK_ROWS], np.ascontiguousarray(bins[:, i : i + BLOCK_ROWS])))
            yield pa.RecordBatch.from_pydict({"part": pa.array([i // BLOCK_ROWS], pa.int32()), "content": pa.array([own], pa.binary())})

    plain = rows.select(F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x"))
    one = plain.repartition(1).sortWithinPartitions("y", "x")
    return written(one.mapInArrow(parts, "part INT, content BINARY"), "boosting-rows")


def fit_all(estimators: Sequence[GBTRegressor], rows: DataFrame) -> Iterator[BoostedTrees]:
    """A model per estimator, in their order and fetched one at a time. A task holds all rows for its estimator."""
    first = estimators[0]
    label, features, max_bins = (first.getOrDefault(name) for name in ("labelCol", "featuresCol", "maxBins"))
    if max_bins > 256 or any(e.getOrDefault("maxBins") != max_bins for e in estimators):
        raise ValueError("estimators need one number of bins, 256 at most")
    wanted = [json.dumps({p.name: e.getOrDefault(p) for p in e.params if p.name in SETTINGS and e.isDefined(p)}) for e in estimators]
    # The longest run first.
    order = sorted(range(len(wanted)), key=lambda i: -estimators[i].getMaxIter() * estimators[i].getMaxDepth())

    def grown(pairs):
        found = sorted(((place, part, content) for place, (part, content) in pairs), key=lambda v: v[1])
        if not found:
            return
        place, loaded = order[found[0][0]], [pickle.loads(content) for _, _, content in found]
        cuts, p = loaded[0][0], json.loads(wanted[place])
        label, bins = np.concatenate([v[1] for v in loaded]), np.concatenate([v[2] for v in loaded], axis=1)
        del loaded, found
        trees = boost(bins, label, np.array([len(c) for c in cuts]), p)
        yield place, bytearray(pickle.dumps((cuts, [(t.feature, t.cut, t.left, t.value, t.depth) for t in trees])))

    spark, places = rows.sparkSession, len(wanted)
    blocks = _parts(rows, label, features, max_bins).rdd
    dealt = blocks.flatMap(lambda r: [(i, (r["part"], bytes(r["content"]))) for i in range(places)]).partitionBy(places, lambda i: i)
    models = written(spark.createDataFrame(dealt.mapPartitions(grown), "place INT, content BINARY"), "boosted")
    for i, estimator in enumerate(estimators):
        found = models.filter(F.col("place") == i).select("content").first()
        if found is None:
            raise ValueError("no rows to fit to")
        cuts, trees = pickle.loads(bytes(found["content"]))
        yield BoostedTrees(cuts, [Tree(*t) for t in trees], estimator.getStepSize(), features, label)
