"""Random and chronological splits, folds and backtest periods."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from parcelwise.operators.ordering import day_number, rank_within
from parcelwise.scale import MAX_GROUP_ROWS


def hash_share(keys: Sequence[str], seed: int = 42) -> Column:
    """Number in [0, 1) that depends on the row key and the seed only."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(2**32)


def random_split(
    df: DataFrame, keys: Sequence[str], train: float = 0.7, val: float = 0.1, seed: int = 42, out: str = "split"
) -> DataFrame:
    """Label rows train / val / test. The label of a row is the same in every partitioning and rerun."""
    share = hash_share(keys, seed)
    return df.withColumn(out, F.when(share < train, "train").when(share < train + val, "val").otherwise("test"))


def chronological_position(
    df: DataFrame, order: Sequence[str], ts: str, max_rows: int = MAX_GROUP_ROWS, total: int | None = None
) -> DataFrame:
    """Add `position` (0-based) and `fraction` of each row along `order`, which starts with `ts`.

    The rank is taken per day and moved by the number of rows on earlier days; days that are too
    large are range-partitioned, so no task sorts the whole frame."""
    ranked = rank_within(df, [], order, "__rank", day_number(F.col(ts)), max_rows)
    total = df.count() if total is None else total
    position = (F.col("__rank") - 1).cast("long")
    return ranked.withColumn("position", position).withColumn("fraction", position / F.lit(total)).drop("__rank")


def split_cuts(n: int, scheme: str = "holdout") -> tuple[int, int]:
    """First validation and first test position. holdout: 70/15/15; nested: 80 % of 80 %."""
    if scheme == "holdout":
        train = int(n * 0.7)
        return train, train + int((n - train) * 0.5)
    if scheme == "nested":
        test = int(n * 0.8)
        return int(test * 0.8), test
    raise ValueError(f"unknown scheme {scheme!r}")


def chronological_split(
    df: DataFrame, order: Sequence[str], ts: str, scheme: str = "holdout", max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    total = df.count()
    placed = chronological_position(df, order, ts, max_rows, total)
    val, test = split_cuts(total, scheme)
    label = F.when(F.col("position") < val, "train").when(F.col("position") < test, "val").otherwise("test")
    return placed.withColumn("split", label)


def fold_table(n: int, splits: int = 5, gap: int = 0) -> list[tuple[int, int, int, int]]:
    """(fold, train_end, val_start, val_end) of an expanding time-series split."""
    size = n // (splits + 1)
    if size == 0 or n - size * splits - gap <= 0:
        raise ValueError("too few rows for the folds")
    starts = [n - (splits - i) * size for i in range(splits)]
    return [(i, start - gap, start, start + size) for i, start in enumerate(starts)]


def assign_folds(df: DataFrame, folds: Sequence[tuple[int, int, int, int]], position: str = "position") -> DataFrame:
    """One row per fold a row takes part in, with its role; at most one copy per fold."""
    at = F.col(position)
    entries = [
        F.when(at < train_end, F.struct(F.lit(fold).alias("fold"), F.lit("train").alias("role"))).when(
            (at >= start) & (at < end), F.struct(F.lit(fold).alias("fold"), F.lit("val").alias("role"))
        )
        for fold, train_end, start, end in folds
    ]
    return df.select("*", F.inline(F.array_compact(F.array(*entries))))


def expanding_windows(
    df: DataFrame, initial: int = 1000, step: int = 100, width: int = 200, position: str = "position"
) -> DataFrame:
    """Validation rows of every expanding window, with the size of its training prefix.

    The training set of a window is the prefix `position < train_rows` and is not copied; a row is
    validated by at most width / step windows, found by arithmetic on its position."""
    at = F.col(position)
    newest = F.floor((at - initial) / step)
    oldest = F.greatest(F.floor((at - initial - width) / step) + 1, F.lit(0).cast("long"))
    used = df.filter(at >= initial)
    windows = used.withColumn("window", F.explode(F.sequence(oldest, newest)))
    return windows.withColumn("train_rows", F.lit(initial).cast("long") + F.col("window") * step)


def backtest_periods(
    df: DataFrame, ts: str, start: datetime, end: datetime, frequency: str = "monthly", min_train: int = 100
) -> DataFrame:
    """Periods with their test rows and the rows before them; thin or empty periods are left out.

    monthly: 30 days, weekly: 7 days, anything else: one period up to `end`."""
    days = {"monthly": 30, "weekly": 7}.get(frequency)
    last = F.lit(end).cast("timestamp_ntz")
    first = F.lit(start).cast("timestamp_ntz")
    micros = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(first.cast("timestamp"))
    if days is None:
        period = F.when(F.col(ts) < first, -1).when(F.col(ts) < last, 0)
        count = 1
    else:
        length = days * 86_400_000_000
        period = F.when(F.col(ts) < first, -1).otherwise(F.floor(micros / F.lit(length)))
        count = (end - start).days // days + 1
    counts = (
        df.withColumn("period", period.cast("int"))
        .filter(F.col("period") < count)
        .groupBy("period")
        .agg(F.count(F.lit(1)).alias("n_test"))
    )
    # One row per period of the date range, so this window stays small however many sales there are.
    earlier = Window.orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    train = counts.withColumn("n_train", F.coalesce(F.sum("n_test").over(earlier), F.lit(0)))
    span = F.make_dt_interval(F.col("period") * F.lit(days or 0))
    window_start = first + span
    window_end = last if days is None else window_start + F.make_dt_interval(F.lit(days))
    return train.filter((F.col("period") >= 0) & (F.col("n_train") > min_train) & (F.col("n_test") > 0)).select(
        "period", window_start.alias("period_start"), window_end.alias("period_end"), "n_train", "n_test"
    )


def period_rows(df: DataFrame, ts: str, start: datetime, end: datetime) -> tuple[DataFrame, DataFrame]:
    """(training rows before the period, test rows inside it)."""
    first, last = (F.lit(t).cast("timestamp_ntz") for t in (start, end))
    return df.filter(F.col(ts) < first), df.filter((F.col(ts) >= first) & (F.col(ts) < last))
