"""Message streams with the columns value, partition, offset, timestamp."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from parcelwise.scale import fresh_path

MESSAGE_SCHEMA = "value STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
BATCH_SECONDS = 5


def kafka_messages(
    spark: SparkSession, servers: str, topic: str, max_messages: int | None = None, **options: str
) -> DataFrame:
    """Topic from the earliest offset. Needs the Kafka connector on the classpath.

    `max_messages` bounds a batch; without it a batch takes all there is."""
    bounds = {} if max_messages is None else {"maxOffsetsPerTrigger": str(max_messages)}
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**bounds, **options)
        .load()
        .select(F.col("value").cast("string").alias("value"), "partition", "offset", "timestamp")
    )


def file_messages(spark: SparkSession, path: str, max_files: int = 4) -> DataFrame:
    """The same columns from JSON files, `max_files` per batch."""
    return spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", max_files).json(path)


def start_to_files(df: DataFrame, path: str, checkpoint: str | None = None, once: bool = False) -> StreamingQuery:
    """Append a stream to Parquet files; the file sink commits each batch exactly once."""
    trigger = {"availableNow": True} if once else {"processingTime": f"{BATCH_SECONDS} seconds"}
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint or fresh_path(df.sparkSession, "stream"))
        .trigger(**trigger)
        .start()
    )


def drain_to_files(df: DataFrame, label: str) -> tuple[DataFrame, StreamingQuery]:
    """Process everything available now and return what was written, with the finished query."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    query = start_to_files(df, path, once=True)
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(path), query


def late_rows(query: StreamingQuery) -> int:
    """Rows the watermark dropped, summed over the recorded progress of a short query.

    Spark records the newest batches only. Where the first one is gone the sum would be too small, and
    this is an error: count such a query with `LateRows`."""
    recorded = query.recentProgress
    if recorded and recorded[0]["batchId"] > 0:
        raise ValueError("the first batches are no longer recorded; add a LateRows listener before the start")
    return sum(o["numRowsDroppedByWatermark"] for progress in recorded for o in progress["stateOperators"])


class LateRows(StreamingQueryListener):
    """Counts the rows that watermarks drop, per run of a query, over all its batches.

    Add it with `spark.streams.addListener` before the query starts; counts arrive after each batch."""

    def __init__(self) -> None:
        self.counts: Counter = Counter()

    def onQueryStarted(self, event) -> None:
        self.counts[str(event.runId)] += 0

    def onQueryProgress(self, event) -> None:
        dropped = sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)
        self.counts[str(event.progress.runId)] += dropped

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
