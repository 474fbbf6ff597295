"""Ordered computations that stay distributed when one key holds most of the rows.

A plain window sends every row of a key to one task. Keys above `max_rows` are therefore cut into
consecutive blocks; each block is processed on its own and a small table with one row per block
carries counts, sums or last values over to the following blocks. Without hot keys the plan is the
plain window. `order` lists ascending column names whose combination is unique per key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from parcelwise.scale import MAX_GROUP_ROWS, join_keys, largest_group, small_rows, written

BLOCK = "__block"


@dataclass(frozen=True)
class Blocks:
    df: DataFrame
    split: bool


def day_number(ts: Column) -> Column:
    """Calendar day as a number, the usual `bucket` for time-ordered keys."""
    return F.unix_date(F.to_date(ts)).cast("long")


def key_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key as `n`, held locally if the keys are few. Operators on the same keys can share it."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    local = small_rows(sizes)
    return sizes if local is None else local


def split_hot(
    df: DataFrame, keys: Sequence[str], max_rows: int, sizes: DataFrame | None = None
) -> tuple[DataFrame | None, DataFrame]:
    """(rows of keys above `max_rows` or None, remaining rows)."""
    if sizes is None:
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    hot = sizes.filter(F.col("n") > max_rows).select(*keys)
    local = small_rows(hot)
    if local is not None and local.isEmpty():
        return None, df
    side = hot if local is None else F.broadcast(local)
    return join_keys(df, side, keys, "left_semi"), join_keys(df, side, keys, "left_anti")


def ordered_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> Blocks:
    """Add BLOCK, ascending with `order` inside a key, so that (keys, BLOCK) groups are bounded.

    `bucket` is a whole number that never decreases along `order`, such as the day. It is used if
    no (key, bucket) group is too large; otherwise the hot rows are range-partitioned on keys and
    order and written once, which fixes the block of every row."""
    light = None
    heavy: DataFrame | None = df
    if keys:
        heavy, light = split_hot(df, keys, max_rows)
        if heavy is None:
            return Blocks(df.withColumn(BLOCK, F.lit(0).cast("long")), False)
    blocked = None
    if bucket is not None:
        low = F.lit(-(2**40)).cast("long")
        candidate = heavy.withColumn(BLOCK, F.coalesce(bucket.cast("long"), low))
        if largest_group(candidate, [*keys, BLOCK]) <= max_rows:
            blocked = candidate
    if blocked is None:
        parts = max(2, math.ceil(2 * heavy.count() / max_rows))
        ranged = heavy.repartitionByRange(parts, *keys, *order)
        blocked = written(ranged.withColumn(BLOCK, F.spark_partition_id().cast("long")), "blocks")
    if light is not None:
        blocked = blocked.unionByName(light.withColumn(BLOCK, F.lit(0).cast("long")))
    return Blocks(blocked, True)


def _before(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)


def _carried(df: DataFrame, per_block: DataFrame, keys: Sequence[str], carry: Column, name: str) -> DataFrame:
    """Join the value carried into each block; blocks without one are left out of the lookup."""
    local = small_rows(per_block)
    table = (per_block if local is None else local).withColumn(name, carry)
    table = table.filter(F.col(name).isNotNull()).select(*keys, BLOCK, name)
    return join_keys(df, table if local is None else F.broadcast(table), [*keys, BLOCK], "left")


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, str],
    bucket: Column | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add inclusive running totals `{output: input column}` along `order` within `keys`."""
    blocks = ordered_blocks(df, keys, order, bucket, max_rows)
    upto = Window.partitionBy(*keys, BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    result = blocks.df
    for out, value in values.items():
        result = result.withColumn(out, F.sum(value).over(upto))
    if blocks.split:
        per_block = blocks.df.groupBy(*keys, BLOCK).agg(
            *[F.sum(value).alias(f"__s_{out}") for out, value in values.items()]
        )
        carry = F.struct(*[F.sum(f"__s_{out}").over(_before(keys)).alias(out) for out in values])
        first = F.row_number().over(Window.partitionBy(*keys).orderBy(BLOCK)) == 1
        result = _carried(result, per_block, keys, F.when(~first, carry), "__carry")
        for out in values:
            moved = F.coalesce(F.col("__carry").getField(out), F.lit(0))
            result = result.withColumn(out, F.col(out) + moved)
        result = result.drop("__carry")
    return result.drop(BLOCK)


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str,
    bucket: Column | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add the 1-based row number along `order` within `keys` (of the whole frame without keys)."""
    blocks = ordered_blocks(df, keys, order, bucket, max_rows)
    place = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    result = blocks.df.withColumn(out, F.row_number().over(place).cast("long"))
    if blocks.split:
        per_block = blocks.df.groupBy(*keys, BLOCK).agg(F.count(F.lit(1)).alias("__n"))
        result = _carried(result, per_block, keys, F.sum("__n").over(_before(keys)), "__carry")
        result = result.withColumn(out, F.col(out) + F.coalesce("__carry", F.lit(0))).drop("__carry")
    return result.drop(BLOCK)


def last_known(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    bucket: Column | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add the newest non-null `value` at or before each row along `order` within `keys`."""
    blocks = ordered_blocks(df, keys, order, bucket, max_rows)
    upto = Window.partitionBy(*keys, BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    result = blocks.df.withColumn(out, F.last(value, ignorenulls=True).over(upto))
    if blocks.split:
        newest = F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*order)))
        per_block = blocks.df.groupBy(*keys, BLOCK).agg(newest.alias("__newest"))
        carry = F.last("__newest", ignorenulls=True).over(_before(keys))
        result = _carried(result, per_block, keys, carry, "__carry")
        result = result.withColumn(out, F.coalesce(out, "__carry")).drop("__carry")
    return result.drop(BLOCK)


def rolling_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    outputs: dict[str, tuple[str, int]],
    bucket: Column | None = None,
    max_rows: int = MAX_GROUP_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Add means over the previous n rows, current row excluded: `{output: (column, n)}`.

    Hot keys are cut by row number into blocks, each preceded by a copy of the longest frame."""

    def averaged(frame: DataFrame, by: Sequence[str], along: Sequence[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(*along)
        for out, (value, n) in outputs.items():
            frame = frame.withColumn(out, F.avg(value).over(w.rowsBetween(-n, -1)))
        return frame

    heavy, light = split_hot(df, keys, max_rows, sizes)
    if heavy is None:
        return averaged(df, keys, order)
    reach = max(n for _, n in outputs.values())
    size = max(max_rows, reach)
    ranked = rank_within(heavy, keys, order, "__rank", bucket, max_rows)
    place = (F.col("__rank") - 1) % size
    home = F.floor((F.col("__rank") - 1) / size).cast("long")
    targets = F.when(place >= size - reach, F.array(home, home + 1)).otherwise(F.array(home))
    copies = ranked.withColumn("__home", home).withColumn(BLOCK, F.explode(targets))
    rolled = averaged(copies, [*keys, BLOCK], ["__rank"]).filter(F.col(BLOCK) == F.col("__home"))
    return rolled.drop("__rank", "__home", BLOCK).unionByName(averaged(light, keys, order))
