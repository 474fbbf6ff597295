"""Backfill of features: fitted once, applied to what is new, day by day.

The features of a folder are fitted on its first batch (or given) and stored, so all batches share one
fit. A batch is every day that has a row newer than the mark, whole; its days are overwritten, then the mark
moves. A run that stops in between is repeated by the next one, with the same rows as result."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.models.store import load_features, save_features
from parcelwise.operators.encoding import FeatureFit
from parcelwise.scale import written

DAY = "day"

TASK_ROWS = 250_000
"""Rows that one task sorts by day before it writes them."""


def mark_of(spark: SparkSession, root: str) -> datetime | None:
    """Newest time that a backfill of this folder has finished, or None."""
    spark.createDataFrame([], "mark TIMESTAMP_NTZ").write.mode("ignore").parquet(f"{root}/mark/none")
    marks = spark.read.schema("mark TIMESTAMP_NTZ").option("recursiveFileLookup", True).parquet(f"{root}/mark")
    return marks.agg(F.max("mark")).first()[0]


def dealt_by_day(batch: DataFrame, rows: int) -> DataFrame:
    """A batch of so many rows with each day in one task, or in several if it has more than `TASK_ROWS`.

    Rows are moved before they get their features, when they are narrow, and a day is written as few files."""
    largest = batch.groupBy(DAY).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    pieces = F.pmod(F.xxhash64(*[c for c in batch.columns if c != DAY]), F.lit(-(-largest // TASK_ROWS)))
    cores = batch.sparkSession.sparkContext.defaultParallelism
    return batch.repartition(max(cores, -(-rows // TASK_ROWS)), DAY, pieces)


def backfill(rows: DataFrame, root: str, ts: str, fit: FeatureFit | None = None) -> int:
    """Bring the features in `root` up to the newest row; returns how many rows were written.

    Late rows of a day are taken with the day's next new row; those of days that get none stay out."""
    spark = rows.sparkSession
    last = mark_of(spark, root)
    dated = rows.filter(F.col(ts).isNotNull()).withColumn(DAY, F.to_date(ts))
    if last is not None:
        fresh = F.col(ts) > F.lit(last).cast(rows.schema[ts].dataType)
        days = dated.filter(fresh).select(DAY).distinct()
        # Days with new rows begin with the mark's own, which bounds the scan.
        dated = dated.filter(F.col(DAY) >= F.lit(last.date())).join(days, DAY, "left_semi")
    batch = written(dated, "backfill-batch")
    newest, n = batch.agg(F.max(ts), F.count(F.lit(1))).first()
    if not n:
        return 0
    stored = load_features(spark, f"{root}/features")
    if stored is None:
        save_features(fit or FeatureFit(exclude=("price", "property_id", ts, "created_at", DAY)).fit(batch), f"{root}/features")
        stored = load_features(spark, f"{root}/features")
    features = stored.apply(dealt_by_day(batch, n))
    features.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(f"{root}/rows")
    mark = spark.range(1).select(F.lit(newest).cast("timestamp_ntz").alias("mark"))
    mark.coalesce(1).write.mode("overwrite").parquet(f"{root}/mark/upto")
    return n


def backfilled(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/rows")
