"""Catalog and JDBC tables, caller-supplied queries and incremental reads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ingest_table(
    spark: SparkSession,
    name: str,
    columns: Sequence[str] | None = None,
    limit: int | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Projection of a catalog table. A limited read is repeatable when `order_by` is given."""
    df = spark.table(name)
    if columns:
        df = df.select(*columns)
    if order_by:
        df = df.orderBy(*order_by)
    return df if limit is None else df.limit(limit)


def ingest_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 16,
    properties: dict[str, str] | None = None,
    single_task: bool = False,
) -> DataFrame:
    """Database table, read by several tasks over ranges of `split_column`.

    Bounds that are not given are asked from the database. A read without a split column is one task's
    work whatever the table's size, so it has to be asked for."""
    if split_column is None:
        if not single_task:
            raise ValueError("name a split column, or set single_task for a small table")
        return spark.read.jdbc(url, table, properties=properties)
    if bounds is None:
        span = f"SELECT min({split_column}) AS low, max({split_column}) AS high FROM {table}"
        low, high = ingest_jdbc_query(spark, url, span, properties).first()
        bounds = (low or 0, high or 0)
    return spark.read.jdbc(
        url,
        table,
        column=split_column,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=partitions,
        properties=properties,
    )


def ingest_jdbc_query(spark: SparkSession, url: str, sql: str, properties: dict[str, str] | None = None) -> DataFrame:
    """Result of a query that the database runs; for results that one task can read."""
    return spark.read.format("jdbc").options(url=url, query=sql, **(properties or {})).load()


def ingest_query(spark: SparkSession, sql: str, args: dict[str, object] | None = None, **frames: DataFrame) -> DataFrame:
    """Run caller SQL over named frames; values are bound as parameters, never formatted in."""
    return spark.sql(sql, args=args or {}, **frames)


def ingest_incremental(df: DataFrame, ts: str, last: datetime, ordered: bool = True) -> DataFrame:
    """Rows newer than `last`. The filter reaches the scan; ordering is optional because it shuffles."""
    newer = df.filter(F.col(ts) > F.lit(last).cast(df.schema[ts].dataType))
    return newer.orderBy(ts) if ordered else newer


def high_water_mark(df: DataFrame, ts: str) -> DataFrame:
    """Newest timestamp and row count of a batch, stored with it as the next starting point."""
    return df.agg(F.max(ts).alias("high_water_mark"), F.count(F.lit(1)).alias("rows"))
