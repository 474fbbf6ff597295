"""Cross-validation and backtests: one fit per fold or period, metrics as frames."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.models.estimators import LABEL, predict_price, shared_rows
from parcelwise.operators.metrics import fold_summary, regression_metrics
from parcelwise.operators.splits import backtest_periods, period_rows

METRICS = ("mae", "rmse", "r2", "mape")


def cross_validate(
    df: DataFrame, folds: Sequence[tuple[int, int, int, int]], estimator: Estimator, position: str = "position"
) -> tuple[DataFrame, DataFrame]:
    """(metrics per fold, summary over folds). Folds are position ranges; rows are not copied."""
    data = shared_rows(df.select(position, "price", LABEL, "features"))
    try:
        parts = []
        for fold, train_end, start, end in folds:
            model = estimator.fit(data.filter(F.col(position) < train_end))
            val = data.filter((F.col(position) >= start) & (F.col(position) < end))
            m = regression_metrics(predict_price(model, val).withColumn("actual", F.col("price"))).first()
            parts.append((fold, train_end, end - start, *[m[name] for name in METRICS]))
    finally:
        data.unpersist()
    schema = "fold INT, train_size BIGINT, val_size BIGINT, " + ", ".join(f"{m} DOUBLE" for m in METRICS)
    table = df.sparkSession.createDataFrame(parts, schema)
    return table, fold_summary(table, METRICS)


def backtest(
    df: DataFrame,
    ts: str,
    start: datetime,
    end: datetime,
    estimator: Estimator,
    frequency: str = "monthly",
    min_train: int = 100,
    keep: Sequence[str] = ("price",),
) -> DataFrame:
    """Predictions of every test period by a model trained on all earlier rows."""
    data = shared_rows(df.select(ts, LABEL, "features"))
    periods = backtest_periods(df, ts, start, end, frequency, min_train).orderBy("period").collect()
    parts = []
    for p in periods:
        train, test = (period_rows(rows, ts, p["period_start"], p["period_end"])[i] for i, rows in enumerate((data, df)))
        scored = predict_price(estimator.fit(train), test)
        parts.append(
            scored.select(
                F.lit(p["period"]).alias("period"), ts, *keep, F.col("price").alias("actual"), "prediction"
            )
        )
    data.unpersist()
    if not parts:
        raise ValueError("no period has enough training and test rows")
    return reduce(DataFrame.unionByName, parts)
