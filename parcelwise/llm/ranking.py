"""Gapless ranks within classes of which one may hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def rank_in_class(rows: DataFrame, cls: str, block: str, order: list[str], name: str = "rank") -> DataFrame:
    """`rows` with `name`, their position (from 0) in their class.

    `block` cuts every class into parts of bounded size that never change, such as the files of a
    written table. Rows are numbered within class and block; the counts of the blocks before, one
    row per class and block, are added. Rows with the same order columns are interchangeable."""
    own = Window.partitionBy(cls, block)
    counts = rows.groupBy(cls, block).agg(F.count(F.lit(1)).alias("__n"))
    before = counts.withColumn(
        "__before",
        F.sum("__n").over(Window.partitionBy(cls).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)),
    ).select(cls, block, F.coalesce("__before", F.lit(0)).alias("__before"))
    numbered = rows.withColumn("__r", F.row_number().over(own.orderBy(*order)))
    return (
        numbered.join(before, [cls, block])
        .withColumn(name, (F.col("__before") + F.col("__r") - 1).cast("long"))
        .drop("__before", "__r")
    )
