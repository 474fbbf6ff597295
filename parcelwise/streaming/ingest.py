"""Message ingestion: parse, validate, quarantine, raw and feature sinks, latest features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from parcelwise.functions.features import request_features
from parcelwise.operators.validation import request_reasons
from parcelwise.operators.windows import latest_per_key
from parcelwise.scale import fresh_path
from parcelwise.schemas import REQUEST_SCHEMA
from parcelwise.streaming.sources import BATCH_SECONDS

MALFORMED = "Malformed message"


def parse_messages(messages: DataFrame, schema: T.StructType = REQUEST_SCHEMA, reasons: Column | None = None) -> DataFrame:
    """Typed columns of the JSON value plus `reasons`, empty for a valid message.

    A value that is not JSON is kept as null columns with its own reason."""
    damaged = T.StructField("_damaged", T.StringType())
    full = T.StructType([*schema.fields, damaged])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_damaged"}
    # A generator keeps the filter on `reasons` above the parser, so each value is parsed once.
    flat = messages.select(*messages.columns, F.inline(F.array(F.from_json("value", full, options))))
    bad = F.col("_damaged").isNotNull() | F.col("value").isNull()
    checks = request_reasons() if reasons is None else reasons
    return flat.withColumn("reasons", F.when(bad, F.array(F.lit(MALFORMED))).otherwise(checks)).drop("_damaged")


def dedup_messages(messages: DataFrame, delay: str = "1 hour", keys: Sequence[str] = ("partition", "offset")) -> DataFrame:
    """Drop redelivered messages; state is kept for `delay` of event time."""
    return messages.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(list(keys))


def write_batch(batch: DataFrame, batch_id: int, root: str) -> None:
    """Raw, quarantine and feature rows of one batch, each replacing its own batch partition.

    A batch that is run again after a failure overwrites what it wrote before, so nothing doubles."""
    batch = batch.persist()
    try:
        valid = batch.filter(F.size("reasons") == 0).drop("reasons")
        outputs = {
            "raw": batch.select("value", "partition", "offset", "timestamp"),
            "quarantine": batch.filter(F.size("reasons") > 0),
            "features": request_features(valid).drop("value"),
        }
        for name, rows in outputs.items():
            rows.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")
    finally:
        batch.unpersist()


def start_ingest(
    messages: DataFrame, root: str, checkpoint: str | None = None, once: bool = False
) -> StreamingQuery:
    """Parse, validate and sink messages. Offsets are committed after the batch has been written."""
    trigger = {"availableNow": True} if once else {"processingTime": f"{BATCH_SECONDS} seconds"}
    return (
        parse_messages(messages)
        .writeStream.foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, root))
        .option("checkpointLocation", checkpoint or fresh_path(messages.sparkSession, "ingest"))
        .trigger(**trigger)
        .start()
    )


def start_latest_features(
    rows: DataFrame, key: str, order: Sequence[str], root: str, checkpoint: str | None = None, once: bool = False
) -> StreamingQuery:
    """Keep the newest row per key. Each batch adds its own newest rows as a change set of the
    size of the batch; `latest_features` resolves change sets, `compact_latest` folds them."""

    def add(batch: DataFrame, batch_id: int) -> None:
        latest_per_key(batch, [key], order).write.mode("overwrite").parquet(f"{root}/changes/batch_id={batch_id}")

    trigger = {"availableNow": True} if once else {"processingTime": f"{BATCH_SECONDS} seconds"}
    return (
        rows.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint or fresh_path(rows.sparkSession, "latest"))
        .trigger(**trigger)
        .start()
    )


def latest_features(
    spark: SparkSession, root: str, schema: T.StructType, key: str, order: Sequence[str], snapshot: int | None = None
) -> DataFrame:
    """Newest row per key from the snapshot up to batch `snapshot` and the change sets after it."""
    with_batch = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    changes = spark.read.schema(with_batch).parquet(f"{root}/changes")
    if snapshot is not None:
        changes = changes.filter(F.col("batch_id") > snapshot)
    rows = changes.drop("batch_id")
    if snapshot is not None:
        rows = rows.unionByName(spark.read.schema(schema).parquet(f"{root}/snapshot/upto={snapshot}"))
    return latest_per_key(rows, [key], order)


def compact_latest(
    spark: SparkSession, root: str, schema: T.StructType, key: str, order: Sequence[str], upto: int, since: int | None = None
) -> None:
    """Write the snapshot that replaces all change sets up to batch `upto`."""
    with_batch = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    changes = spark.read.schema(with_batch).parquet(f"{root}/changes").filter(F.col("batch_id") <= upto)
    if since is not None:
        changes = changes.filter(F.col("batch_id") > since)
    rows = changes.drop("batch_id")
    if since is not None:
        rows = rows.unionByName(spark.read.schema(schema).parquet(f"{root}/snapshot/upto={since}"))
    latest_per_key(rows, [key], order).write.mode("overwrite").parquet(f"{root}/snapshot/upto={upto}")
