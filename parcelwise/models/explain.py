"""Model explanations as rescoring jobs: each variant of a row is a row, scored by the model."""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.models.arrays import on_arrays
from parcelwise.operators.ordering import rank_within
from parcelwise.operators.splits import hash_share
from parcelwise.scale import written

HASH_BUCKETS = 4096


def _names(names: Sequence[str], index: Column) -> Column:
    return F.array(*[F.lit(n) for n in names])[index]


def _matrix(column: pa.ListArray) -> np.ndarray:
    """A copy of a batch's feature arrays, which may be changed."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).copy()


def permutation_importance(
    model: Model, df: DataFrame, names: Sequence[str], keys: Sequence[str], label: str = "label", seed: int = 42
) -> DataFrame:
    """Rise of the mean absolute error when one feature is exchanged between rows.

    Rows are numbered along a seeded hash and every row takes the feature from the row half the
    frame away, so donors come from one equi-join on the number for all features together."""
    scorer, d = on_arrays(df.sparkSession, model), len(names)
    # Only features that the model uses are moved; exchanging others changes no prediction.
    used = [i for i in range(d) if scorer.uses(i)] or [0]
    x = vector_to_array("features")
    base = df.select(*keys, label, F.array(*[x[i] for i in used]).alias("x")).withColumn("__h", hash_share(keys, seed))
    bucket = F.floor(F.col("__h") * HASH_BUCKETS)
    ranked = rank_within(base, [], ["__h", *keys], "__pos", bucket)
    numbered = written(ranked.select("__pos", label, "x"), "numbered")
    n = df.count()
    donors = numbered.select(
        (F.pmod(F.col("__pos") - 1 + n // 2, F.lit(n)) + 1).alias("__pos"), F.col("x").alias("donor")
    )
    paired = numbered.join(donors, "__pos")

    def whole(column: pa.ListArray) -> np.ndarray:
        out = np.zeros((len(column), d))
        out[:, used] = _matrix(column)
        return out

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sums of the absolute error, of the rows as they are in the last place.
        n, total = 0, np.zeros(d + 1)
        for batch in batches:
            x, donor = whole(batch.column("x")), whole(batch.column("donor"))
            actual = batch.column(label).to_numpy(zero_copy_only=False)
            state = scorer.state(x)
            plain = np.abs(scorer.predictions(state) - actual).sum()
            n, total[d] = n + len(x), total[d] + plain
            for i in range(d):
                if not scorer.uses(i):
                    total[i] += plain
                    continue
                old = x[:, i].copy()
                x[:, i] = donor[:, i]
                total[i] += np.abs(scorer.predictions(scorer.changed(state, x, i, old)) - actual).sum()
                x[:, i] = old
        yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([n])], ["total", "n"])

    # One row of sums per task; a feature's rise is taken from the totals.
    known = paired.where(F.col(label).isNotNull()).select(label, "x", "donor")
    sums = known.mapInArrow(add, "total array<double>, n long")
    total = F.array(*[F.sum(F.col("total")[i]) for i in range(d + 1)])
    added = sums.agg(total.alias("total"), F.sum("n").alias("n"))
    rises = F.transform(F.slice("total", 1, d), lambda t: (t - F.col("total")[d]) / F.col("n"))
    return added.select(F.posexplode(rises).alias("i", "importance")).select(
        _names(names, F.col("i")).alias("feature"), "importance"
    )


def partial_dependence(
    model: Model, df: DataFrame, names: Sequence[str], feature: str, points: int = 50
) -> DataFrame:
    """Mean prediction with one feature set to each value of an even grid from its minimum to maximum.

    Grid values that no split of a tree model tells apart are scored once. A task sends one row of sums."""
    if feature not in names:
        raise ValueError(f"unknown feature {feature!r}")
    at = list(names).index(feature)
    base = df.select(vector_to_array("features").alias("x"))
    low, high = base.agg(F.min(F.col("x")[at]), F.max(F.col("x")[at])).first()
    step = (high - low) / (points - 1)
    grid = np.array([low + i * step for i in range(points)])
    scorer = on_arrays(df.sparkSession, model)
    _, first, group = np.unique(scorer.alike(at, grid), return_index=True, return_inverse=True)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(len(first))
        for batch in batches:
            x = _matrix(batch.column("x"))
            state, old = scorer.state(x), x[:, at].copy()
            for g, i in enumerate(first):
                x[:, at] = grid[i]
                total[g] += scorer.predictions(scorer.changed(state, x, at, old)).sum()
            n += len(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(points, dtype=np.int32)), pa.array(total[group]), pa.array(np.full(points, n))],
            ["point", "total", "n"],
        )

    sums = base.mapInArrow(add, "point int, total double, n long").groupBy("point")
    values = F.array(*[F.lit(float(v)) for v in grid])
    mean = sums.agg((F.sum("total") / F.sum("n")).alias("mean_prediction"))
    return mean.select("point", values[F.col("point")].alias("grid_value"), "mean_prediction")


def background_rows(df: DataFrame, keys: Sequence[str], rows: int = 100, seed: int = 42) -> list[list[float]]:
    """At most `rows` feature arrays, the first along a seeded hash of the row key."""
    chosen = df.select(vector_to_array("features").alias("x"), hash_share(keys, seed).alias("h"))
    return [list(r["x"]) for r in chosen.orderBy("h").limit(rows).select("x").collect()]


def attributions(
    model: Model,
    df: DataFrame,
    names: Sequence[str],
    keys: Sequence[str],
    background: Sequence[Sequence[float]],
    permutations: int = 8,
    seed: int = 42,
) -> DataFrame:
    """Sampled Shapley values: (keys, feature, value, base_value); base + sum of values = prediction.

    Every background row takes part equally: there are as many permutations as background rows, or
    the next multiple of them, and the base value is the mean prediction over all background rows.

    A permutation turns a background row into the explained row one feature at a time. Each step counts for the
    feature just changed. All steps of a row are taken where the row is, so nothing is copied or shuffled."""
    d = len(names)
    draw = random.Random(seed)
    permutations = -(-permutations // len(background)) * len(background)
    orders = [draw.sample(range(d), d) for _ in range(permutations)]
    scorer, others = on_arrays(df.sparkSession, model), np.array(background, float)
    labels = pa.array([*names, "base_value"])

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"))
            values = np.zeros((len(x), d + 1))
            for m, order in enumerate(orders):
                at = np.repeat(others[m % len(others)][None], len(x), axis=0)
                state = scorer.state(at)
                before = scorer.predictions(state)
                values[:, d] += before
                for i in filter(scorer.uses, order):
                    old = at[:, i].copy()
                    at[:, i] = x[:, i]
                    state = scorer.changed(state, at, i, old)
                    after = scorer.predictions(state)
                    values[:, i] += after - before
                    before = after
            row = pa.array(np.repeat(np.arange(len(x)), d + 1))
            feature = pa.array(np.tile(np.arange(d + 1), len(x)))
            columns = [batch.column(c).take(row) for c in keys]
            yield pa.RecordBatch.from_arrays(
                [*columns, labels.take(feature), pa.array(values.ravel() / permutations)], [*keys, "feature", "value"]
            )

    schema = df.select(*keys).schema.add("feature", "string").add("value", "double")
    return df.select(*keys, vector_to_array("features").alias("x")).mapInArrow(explain, schema)


def mean_attribution(attributed: DataFrame) -> DataFrame:
    """Features by the mean absolute value of their attributions; the base value is no feature."""
    real = attributed.filter(F.col("feature") != "base_value")
    return real.groupBy("feature").agg(F.avg(F.abs("value")).alias("importance"))


def interaction_strength(
    model: Model,
    df: DataFrame,
    names: Sequence[str],
    keys: Sequence[str],
    pair: tuple[str, str],
    background: Sequence[Sequence[float]],
) -> DataFrame:
    """Mean second difference of the prediction in two features against background rows."""
    a, b = (list(names).index(f) for f in pair)
    scorer, others = on_arrays(df.sparkSession, model), np.array(background, float)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"))
            state, old_a, old_b = scorer.state(x), x[:, a].copy(), x[:, b].copy()
            plain, total = scorer.predictions(state), np.zeros(len(x))
            for other in others:
                x[:, a] = other[a]
                first = scorer.changed(state, x, a, old_a)
                x[:, b] = other[b]
                both = scorer.predictions(scorer.changed(first, x, b, old_b))
                x[:, a] = old_a
                second = scorer.predictions(scorer.changed(state, x, b, old_b))
                x[:, b] = old_b
                total += plain - scorer.predictions(first) - second + both
            columns = [batch.column(c) for c in keys]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total / len(others))], [*keys, "interaction"])

    schema = df.select(*keys).schema.add("interaction", "double")
    return df.select(*keys, vector_to_array("features").alias("x")).mapInArrow(score, schema)
