"""Regression metrics over prediction frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.operators.quantiles import quantiles
from parcelwise.scale import MAX_GROUP_ROWS, join_keys

# Error quantiles and relative-error bounds that are reported.
ERROR_QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9)
WITHIN_BOUNDS = (0.05, 0.10, 0.15, 0.20, 0.25)


def metric_columns(actual: str = "actual", prediction: str = "prediction") -> list[Column]:
    """MAE, RMSE, R2, MAPE and error moments; a zero actual is left out of MAPE and counted."""
    y, error = F.col(actual).cast("double"), F.col(prediction) - F.col(actual)
    sst = F.var_pop(y) * F.count(y)
    return [
        F.count(error).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(F.sum(error * error), sst)).alias("r2"),
        (F.avg(F.abs(F.try_divide(error, y))) * 100).alias("mape"),
        F.count_if(y == 0).alias("zero_actuals"),
        F.avg(error).alias("error_mean"),
        F.stddev_pop(error).alias("error_std"),
    ]


def within_columns(actual: str = "actual", prediction: str = "prediction") -> list[Column]:
    relative = F.abs(F.try_divide(F.col(prediction) - F.col(actual), F.col(actual).cast("double")))
    return [
        (F.avg(F.when(relative <= bound, 1.0).otherwise(0.0)) * 100).alias(f"within_{round(bound * 100)}pct")
        for bound in WITHIN_BOUNDS
    ]


def regression_metrics(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(*metric_columns())


def within_shares(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(*within_columns())


def error_quantiles(df: DataFrame, keys: Sequence[str] = (), max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    errors = df.select(*keys, (F.col("prediction") - F.col("actual")).alias("error"))
    found = quantiles(errors, ["error"], ERROR_QUANTILES, keys, max_rows=max_rows)
    return found.select(
        *keys, *[F.col("error")[i].alias(f"q{round(p * 100)}") for i, p in enumerate(ERROR_QUANTILES)]
    )


def segment_metrics(
    df: DataFrame, segment: str, min_rows: int = 10, max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """All metrics for segments with more than `min_rows` rows, in one pass over the rows."""
    flat = df.groupBy(segment).agg(*metric_columns(), *within_columns())
    return join_keys(flat.filter(F.col("n") > min_rows), error_quantiles(df, [segment], max_rows), [segment])


def fold_summary(folds: DataFrame, metrics: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Mean, population deviation, minimum and maximum of each metric over the folds."""
    long = folds.select(*keys, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        list(keys), list(metrics), "metric", "score"
    )
    return long.groupBy(*keys, "metric").agg(
        F.avg("score").alias("mean"),
        F.stddev_pop("score").alias("std"),
        F.min("score").alias("min"),
        F.max("score").alias("max"),
    )
