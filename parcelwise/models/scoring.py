"""Batch scoring, prediction intervals and ensembles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.columns import sanitize
from parcelwise.functions.features import request_features
from parcelwise.models.estimators import predict_price
from parcelwise.operators.drift import bin_number
from parcelwise.operators.encoding import RobustScale, assemble
from parcelwise.operators.quantiles import quantile_values, quantiles
from parcelwise.scale import MAX_GROUP_ROWS
from parcelwise.schemas import REQUEST_VECTOR


def score_requests(
    df: DataFrame, model: Model, scale: RobustScale | None = None, vector: Sequence[str] = REQUEST_VECTOR
) -> DataFrame:
    """Requests with their predicted price; as many rows as came in, input columns unchanged."""
    kept = df.withColumn("__request", F.struct(*df.columns))
    ready = sanitize(request_features(kept), vector)
    if scale is not None:
        ready = scale.apply(ready)
    scored = predict_price(model, assemble(ready, vector))
    return scored.select("__request.*", "prediction")


def fixed_interval(df: DataFrame, share: float = 0.15, column: str = "prediction") -> DataFrame:
    return df.withColumns(
        {"lower": F.col(column) * (1 - F.lit(share)), "upper": F.col(column) * (1 + F.lit(share))}
    )


@dataclass(frozen=True)
class ResidualInterval:
    """Residual quantiles by prediction bin, measured on validation rows."""

    edges: list[float]
    offsets: dict[int, tuple[float, float]]

    def apply(self, df: DataFrame) -> DataFrame:
        low, high = F.lit(None).cast("double"), F.lit(None).cast("double")
        place = F.col("__bin")
        for b, (lo, hi) in self.offsets.items():
            low, high = F.when(place == b, lo).otherwise(low), F.when(place == b, hi).otherwise(high)
        return (
            df.withColumn("__bin", bin_number("prediction", self.edges))
            .withColumns({"lower": F.col("prediction") + low, "upper": F.col("prediction") + high})
            .drop("__bin")
        )


def fit_residual_interval(
    val: DataFrame, bins: int = 10, level: float = 0.95, max_rows: int = MAX_GROUP_ROWS
) -> ResidualInterval:
    cuts = quantile_values(val, ["prediction"], [i / bins for i in range(1, bins)], max_rows=max_rows)
    edges = sorted(set(cuts["prediction"]))
    tail = (1 - level) / 2
    binned = val.select(
        bin_number("prediction", edges).alias("bin"), (F.col("actual") - F.col("prediction")).alias("residual")
    )
    rows = quantiles(binned, ["residual"], [tail, 1 - tail], ["bin"], max_rows=max_rows).collect()
    return ResidualInterval(edges, {r["bin"]: tuple(r["residual"]) for r in rows})


def normalized_weights(weights: Sequence[float]) -> list[float]:
    total = sum(weights)
    return [w / total for w in weights]


def add_member(weights: Sequence[float], weight: float | None = None) -> list[float]:
    """Weights after one more member joins; its default weight is 1/n of the new size."""
    return normalized_weights([*weights, weight or 1.0 / (len(weights) + 1)])


def ensemble(df: DataFrame, members: dict[str, float]) -> DataFrame:
    """Weighted mean of member columns with the unweighted spread and mean ± 1.96 deviations."""
    weights = dict(zip(members, normalized_weights(list(members.values()))))
    mean = sum((F.col(c) * F.lit(w) for c, w in weights.items()), F.lit(0.0))
    plain = sum((F.col(c) for c in members), F.lit(0.0)) / len(members)
    squares = sum((F.pow(F.col(c) - plain, 2) for c in members), F.lit(0.0))
    with_mean = df.withColumns({"ensemble": mean, "variance": squares / len(members)})
    std = F.sqrt("variance")
    return with_mean.withColumns(
        {"std": std, "lower": F.col("ensemble") - 1.96 * std, "upper": F.col("ensemble") + 1.96 * std}
    )


def ensemble_long(predictions: DataFrame, weights: DataFrame, row: str = "row_id") -> DataFrame:
    """The same for members that arrive as rows (row, member, prediction) and a (member, weight) table.

    A member without a weight is an error, not a smaller ensemble."""
    missing = F.raise_error(F.concat(F.lit("no weight for member "), F.coalesce(F.col("member").cast("string"), F.lit("null"))))
    weighted = predictions.join(weights, "member", "left").withColumn("weight", F.coalesce("weight", missing.cast("double")))
    return weighted.groupBy(row).agg(
        (F.sum(F.col("weight") * F.col("prediction")) / F.sum("weight")).alias("ensemble"),
        F.var_pop("prediction").alias("variance"),
    )
