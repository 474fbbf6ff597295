"""Population stability against fixed reference bins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.columns import nan_to_null
from parcelwise.operators.quantiles import quantile_values
from parcelwise.scale import MAX_GROUP_ROWS

EPSILON = 1e-4
"""Smallest share used for an empty bin."""


def bin_number(col: str, edges: Sequence[float]) -> Column:
    """Number of edges below the value, as a projection; null stays null."""
    place = F.lit(0)
    for edge in edges:
        place = place + (F.col(col) > F.lit(edge)).cast("int")
    return place


@dataclass(frozen=True)
class DriftBins:
    """Inner bin edges and reference shares per feature."""

    edges: dict[str, list[float]]
    shares: dict[str, list[float]]


def _edge_counts(edges: dict[str, list[float]]) -> list[Column]:
    """Values per feature and values above each edge: one comparison per edge and row."""
    counts = []
    for c, cuts in edges.items():
        counts.append(F.count(c).alias(f"{c}__0"))
        counts += [F.count_if(F.col(c) > F.lit(e)).alias(f"{c}__{i}") for i, e in enumerate(cuts, 1)]
    return counts


def _bin_counts(above: list) -> list:
    """Values per bin as differences of the counts above neighbouring edges."""
    return [n - following for n, following in zip(above, above[1:])] + [above[-1]]


def fit_drift_bins(
    reference: DataFrame, cols: Sequence[str], bins: int = 10, max_rows: int = MAX_GROUP_ROWS
) -> DriftBins:
    """Equal-share bins of the reference; repeated edges are merged."""
    found = quantile_values(reference, cols, [i / bins for i in range(1, bins)], max_rows=max_rows)
    edges = {c: sorted({v for v in values if v is not None}) for c, values in found.items()}
    row = nan_to_null(reference, cols).agg(*_edge_counts(edges)).first()
    shares = {}
    for c, cuts in edges.items():
        counts = _bin_counts([row[f"{c}__{i}"] for i in range(len(cuts) + 1)])
        total = sum(counts) or 1
        shares[c] = [n / total for n in counts]
    return DriftBins(edges, shares)


def drift_scores(
    current: DataFrame, fit: DriftBins, keys: Sequence[str | Column] = (), threshold: float = 0.2
) -> DataFrame:
    """Stability index per feature (and per key, such as the day) with the threshold flag.

    All features and bins are counted in one aggregation with a fixed number of counters."""
    counted = nan_to_null(current, list(fit.edges)).groupBy(*keys).agg(*_edge_counts(fit.edges))
    names = [c for c in counted.columns if "__" not in c]
    entries = []
    for c, reference in fit.shares.items():
        above = [F.col(f"{c}__{i}") for i in range(len(reference))]
        counts, total = _bin_counts(above), above[0]
        score = F.lit(0.0)
        for n, r in zip(counts, reference):
            share = F.greatest(F.try_divide(n.cast("double"), total), F.lit(EPSILON))
            expected = F.lit(max(r, EPSILON))
            score = score + (share - expected) * F.log(share / expected)
        entries.append(F.struct(F.lit(c).alias("feature_name"), total.alias("n"), score.alias("drift_score")))
    scores = counted.select(*names, F.inline(F.array(*entries))).filter(F.col("n") > 0)
    return scores.withColumn("drifted", F.col("drift_score") > threshold)
