"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}

COMPILED_METHODS = ("spark.sql.codegen.hugeMethodLimit", "8000")
"""HotSpot never compiles a longer method: the wide feature projections would run in its interpreter. Spark then
falls back to projections in short methods for that part of a plan."""

DEFAULTS[COMPILED_METHODS[0]] = COMPILED_METHODS[1]


SHUFFLE_BYTES = 256 * 1024**2
"""Shuffle data one task should read."""


def shuffle_width(input_bytes: int, floor: int = 200) -> int:
    """Shuffle partitions for an input of this size; adaptive execution merges the small ones."""
    return max(floor, -(-input_bytes // SHUFFLE_BYTES))


def build_session(
    app: str = "parcelwise", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """Get or create a session. `master` stays unset on a cluster, where spark-submit names it.

    `input_bytes` sizes the shuffles: 100 TB gives some 400 000 partitions of 256 MB."""
    if input_bytes is not None:
        conf = {"spark.sql.shuffle.partitions": str(shuffle_width(input_bytes)), **conf}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
