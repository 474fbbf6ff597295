"""Rolling, ranking and calendar statistics along time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from parcelwise.operators.ordering import day_number, running_sum, split_hot
from parcelwise.scale import MAX_GROUP_ROWS, join_keys, lookup_side, written


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key along `order`, kept inside a mergeable aggregate."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("__newest"))
    return newest.select(*[c if c in keys else F.col(f"__newest.{c}").alias(c) for c in df.columns])


def percent_rank_within(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    max_rows: int = MAX_GROUP_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """(rank - 1) / (rows - 1) of `value` within the group, 0 for a single row.

    For hot keys the rank comes from running totals over counted values instead of one sort."""
    ranked = F.percent_rank().over(Window.partitionBy(*keys).orderBy(value))
    heavy, light = split_hot(df, keys, max_rows, sizes)
    if heavy is None:
        return df.withColumn(out, ranked)
    counts = written(heavy.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n")), "value-counts")
    totals = lookup_side(counts.groupBy(*keys).agg(F.sum("__n").alias("__total")))
    table = join_keys(running_sum(counts, keys, [value], {"__upto": "__n"}, max_rows=max_rows), totals, keys)
    below = (F.col("__upto") - F.col("__n")).cast("double")
    table = table.withColumn(out, F.coalesce(F.try_divide(below, F.col("__total") - 1), F.lit(0.0)))
    split = join_keys(heavy, table.select(*keys, value, out), [*keys, value])
    return split.unionByName(light.withColumn(out, ranked))


def daily_sums(df: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str]) -> DataFrame:
    """Sum and count of each value per key and calendar day."""
    aggs = []
    for v in values:
        aggs += [F.sum(v).alias(f"{v}__sum"), F.count(v).alias(f"{v}__n")]
    return df.groupBy(*keys, day_number(F.col(ts)).alias("__day")).agg(*aggs)


def day_range_mean(daily: DataFrame, keys: Sequence[str], value: str, start: int, end: int) -> Column:
    """Mean over the days [day + start, day + end] as a window over `daily_sums` rows."""
    w = Window.partitionBy(*keys).orderBy("__day").rangeBetween(start, end)
    return F.try_divide(F.sum(f"{value}__sum").over(w), F.sum(f"{value}__n").over(w))


def rolling_days(
    df: DataFrame, keys: Sequence[str], ts: str, outputs: dict[str, tuple[str, int]]
) -> DataFrame:
    """Add means over the previous n calendar days, current day excluded: `{output: (column, n)}`.

    Rows are summed per key and day before the window, so a group never exceeds the number of days
    whatever the number of sales."""
    daily = daily_sums(df, keys, ts, sorted({v for v, _ in outputs.values()}))
    means = daily.select(
        *keys,
        "__day",
        *[day_range_mean(daily, keys, v, -n, -1).alias(out) for out, (v, n) in outputs.items()],
    )
    # Written first: whether it is small enough to broadcast is then known without computing it twice.
    lookup = lookup_side(written(means, "daily-means"))
    keyed = df.withColumn("__day", day_number(F.col(ts)))
    return join_keys(keyed, lookup, [*keys, "__day"]).drop("__day")


def momentum(df: DataFrame, keys: Sequence[str], ts: str, value: str, days: int = 7) -> DataFrame:
    """Per key and day: mean of the last `days` days over the mean of the `days` before, minus 1."""
    daily = daily_sums(df, keys, ts, [value])
    recent = day_range_mean(daily, keys, value, 1 - days, 0)
    before = day_range_mean(daily, keys, value, 1 - 2 * days, -days)
    return daily.select(
        *keys,
        F.date_from_unix_date(F.col("__day").cast("int")).alias("day"),
        (F.try_divide(recent, before) - 1).alias("momentum"),
    )


def monthly_index(df: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    """Per key and month: mean, its ratio to the key's overall mean, growth on the same month last year.

    Last year's month is found by a range frame on the month number, so gaps give null, not a wrong
    month. The windows run over one row per key and month."""
    month = F.trunc(F.to_date(ts), "month").alias("month")
    monthly = df.groupBy(*keys, month).agg(F.sum(value).alias("__sum"), F.count(value).alias("__n"))
    number = F.year("month") * 12 + F.month("month")
    means = monthly.withColumns({"month_mean": F.try_divide("__sum", "__n"), "__number": number})
    everything = Window.partitionBy(*keys)
    year_ago = everything.orderBy("__number").rangeBetween(-12, -12)
    overall = F.try_divide(F.sum("__sum").over(everything), F.sum("__n").over(everything))
    return means.select(
        *keys,
        "month",
        "month_mean",
        F.try_divide("month_mean", overall).alias("seasonal_index"),
        (F.try_divide("month_mean", F.first("month_mean").over(year_ago)) - 1).alias("year_over_year_growth"),
    )
