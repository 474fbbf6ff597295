"""File scans and sinks: Parquet, CSV, many files under a prefix, input inventory."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def load_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, corrupt_column: str | None = None, **options
) -> DataFrame:
    """CSV with a header row. With `corrupt_column`, unreadable lines are kept there, not dropped."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    settings = {"header": True, "mode": "PERMISSIVE", **options}
    if corrupt_column:
        declared = T.StructType([*declared.fields, T.StructField(corrupt_column, T.StringType())])
        settings["columnNameOfCorruptRecord"] = corrupt_column
    return spark.read.schema(declared).options(**settings).csv(path)


def load_prefix(
    spark: SparkSession, prefix: str, schema: T.StructType | str, file_type: str = "parquet"
) -> DataFrame:
    """Every matching file below `prefix` as one frame; an empty frame if none matches.

    Columns that a file lacks read as null, so files written by older jobs still load."""
    reader = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*.{file_type}")
    )
    if file_type == "csv":
        reader = reader.option("header", True)
    return reader.format(file_type).load(prefix)


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def file_inventory(df: DataFrame) -> DataFrame:
    """Rows and bytes per input file of a file-backed frame."""
    return (
        df.select(
            F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_bytes")
        )
        .groupBy("file_path", "file_bytes")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def save_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Write Parquet; with partition columns an overwrite replaces only the partitions in `df`.

    Rows are first gathered by partition value, spread over several tasks when a value is hot."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
