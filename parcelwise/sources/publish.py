"""Feature publishing in long form and the tracking tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.operators.windows import latest_per_key
from parcelwise.schemas import TRACKING_TABLES


def online_features(df: DataFrame, key: str, features: Sequence[str], event: str, created: str) -> DataFrame:
    """Newest values per entity as (feature_name, entity_key, feature_value, timestamps) rows."""
    newest = latest_per_key(df.select(key, event, created, *features), [key], [event, created])
    ready = newest.select(
        F.col(key).cast("string").alias("entity_key"),
        F.col(event).alias("event_timestamp"),
        F.col(created).alias("created_timestamp"),
        *[F.col(f).cast("string").alias(f) for f in features],
    )
    ids = ["entity_key", "event_timestamp", "created_timestamp"]
    return ready.unpivot(ids, list(features), "feature_name", "feature_value")


def append_tracking(df: DataFrame, root: str, table: str, batch: str | None = None) -> None:
    """Append rows to a tracking table after putting them into its declared schema.

    A named batch, such as a run, replaces what an earlier try of it has written."""
    shape = df.sparkSession.createDataFrame([], TRACKING_TABLES[table]).schema
    cols = [
        F.col(f.name).cast(f.dataType).alias(f.name)
        if f.name in df.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in shape.fields
    ]
    df.select(*cols).write.mode("overwrite").parquet(f"{root}/{table}/{batch or uuid.uuid4().hex}")


def read_tracking(spark: SparkSession, root: str, table: str) -> DataFrame:
    reader = spark.read.schema(TRACKING_TABLES[table]).option("recursiveFileLookup", True)
    return reader.parquet(f"{root}/{table}")


def metric_rows(df: DataFrame, run_id: str, metrics: Sequence[str], timestamp: str, step: str) -> DataFrame:
    """One tracking `metrics` row per metric column of `df`."""
    long = df.select(run_id, timestamp, step, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        [run_id, timestamp, step], list(metrics), "key", "value"
    )
    return long.select(
        "key",
        "value",
        F.col(timestamp).cast("long").alias("timestamp"),
        F.col(run_id).cast("string").alias("run_id"),
        F.col(step).cast("long").alias("step"),
        F.coalesce(F.isnan("value"), F.lit(False)).alias("is_nan"),
    )


def with_feature_json(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return df.withColumn(out, F.to_json(F.struct(*features)))


def from_feature_json(df: DataFrame, schema: str, column: str = "features") -> DataFrame:
    return df.withColumn(column, F.from_json(column, schema))
