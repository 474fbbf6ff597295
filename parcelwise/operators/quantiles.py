"""Exact quantiles with linear interpolation, also for groups too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.columns import nan_to_null
from parcelwise.operators.ordering import running_sum
from parcelwise.scale import MAX_GROUP_ROWS, join_keys, largest_group, lookup_side, written

ACCURACY = 10_000
MARGIN = 3 / ACCURACY
"""Brackets reach three times the error bound of the sketch to both sides."""


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    keys: Sequence[str] = (),
    exact: bool = True,
    max_rows: int = MAX_GROUP_ROWS,
    stored: bool = False,
) -> DataFrame:
    """One row per group; every column of `cols` becomes the array of its quantiles at `probs`.

    Exact ones take several passes. `df`, which may be a join of large tables, is read once: its columns
    are written and the passes read the copy, unless `stored` says that it is such a copy already. Nulls and NaN are ignored. Groups within `max_rows` use `percentile`, which buffers the distinct values
    of a group in one task. Larger groups are read twice: a mergeable sketch brackets each quantile,
    then only the values inside the brackets are counted and ranked. Should a bracket miss, all
    values are counted instead. `exact=False` returns the sketch itself."""
    points = F.array(*[F.lit(float(p)) for p in probs])
    df = nan_to_null(df.select(*keys, *[c for c in cols if c not in keys]), cols)
    if not exact:
        sketch = [F.percentile_approx(F.col(c).cast("double"), points, 10 * ACCURACY).alias(c) for c in cols]
        return df.groupBy(*keys).agg(*sketch)
    if not stored:
        df = written(df, "quantile-columns")
    if largest_group(df, keys) <= max_rows:
        return df.groupBy(*keys).agg(*[F.percentile(c, points).alias(c) for c in cols])
    found = _from_brackets(df, cols, probs, list(keys), max_rows)
    # Groups without any value have no bracket; they stay, with null.
    return join_keys(df.select(*keys).distinct(), found, keys) if keys else found


def _from_brackets(df, cols, probs, keys, max_rows) -> DataFrame:
    infinity = float("inf")
    inner = sorted({x for p in probs for x in (p - MARGIN, p + MARGIN) if 0 < x < 1})
    sketch = [
        F.percentile_approx(F.col(c).cast("double"), [float(x) for x in inner], ACCURACY).alias(f"__q_{c}")
        for c in cols
    ]
    sizes = [F.count(c).alias(f"__n_{c}") for c in cols]
    brackets = written(df.groupBy(*keys).agg(*sketch, *sizes), "brackets")

    def edge(c: str, x: float) -> Column:
        if x <= 0 or x >= 1:
            return F.lit(-infinity if x <= 0 else infinity)
        return F.col(f"__q_{c}")[inner.index(x)]

    if keys:
        rows = join_keys(df.select(*keys, *cols), lookup_side(brackets), keys)
    else:
        only = brackets.first()
        rows = df.select(
            *cols,
            *[F.array(*[F.lit(v) for v in only[f"__q_{c}"] or []]).alias(f"__q_{c}") for c in cols],
            *[F.lit(only[f"__n_{c}"]).alias(f"__n_{c}") for c in cols],
        )
    # A row is kept once per bracket it lies in; rows below a bracket are only counted.
    spots = []
    for c in cols:
        value = F.col(c).cast("double")
        for i, p in enumerate(probs):
            low, high = edge(c, p - MARGIN), edge(c, p + MARGIN)
            spot = F.struct(
                F.lit(c).alias("column"),
                F.lit(i).alias("point"),
                F.col(f"__n_{c}").alias("total"),
                F.when(value >= low, value).alias("value"),
            )
            spots.append(F.when(value <= high, spot))
    found = rows.select(*keys, F.inline(F.array_compact(F.array(*spots))))
    by = [*keys, "column", "point"]
    counts = found.groupBy(*by, "total", "value").agg(F.count(F.lit(1)).alias("n"))
    # The null value sorts first and stands for everything below the bracket.
    ranked = running_sum(written(counts, "counts"), by, ["value"], {"upto": "n"}, max_rows=max_rows)
    picked = _interpolated(ranked, by, probs)
    picked = written(picked, "quantiles")
    if not picked.filter(F.col("value").isNull()).isEmpty():
        return _from_counts(df, cols, probs, keys, max_rows)
    return _wide(picked, cols, probs, keys)


def _from_counts(df, cols, probs, keys, max_rows) -> DataFrame:
    """Rank every distinct value of every column."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols]
    )
    long = df.select(*keys, F.inline(entries)).filter(F.col("value").isNotNull())
    by = [*keys, "column"]
    counts = written(long.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n")), "counts")
    totals = lookup_side(counts.groupBy(*by).agg(F.sum("n").alias("total")))
    ranked = join_keys(running_sum(counts, by, ["value"], {"upto": "n"}, max_rows=max_rows), totals, by)
    points = F.explode(F.array(*[F.lit(i) for i in range(len(probs))])).alias("point")
    return _wide(_interpolated(ranked.select("*", points), [*by, "point"], probs), cols, probs, keys)


def _interpolated(ranked: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(by, value) from distinct values with their count `n`, running count `upto` and group `total`."""
    p = F.array(*[F.lit(float(x)) for x in probs])[F.col("point")]
    pos = p * (F.col("total") - 1)
    lower, upper = F.floor(pos), F.ceil(pos)

    def at(rank: Column) -> Column:
        covers = (F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto"))
        return F.max(F.when(covers, F.col("value")))

    ends = ranked.groupBy(*by, "total").agg(at(lower).alias("lo"), at(upper).alias("hi"))
    mixed = (upper - pos) * F.col("lo") + (pos - lower) * F.col("hi")
    same = (lower == upper) | (F.col("lo") == F.col("hi"))
    return ends.select(*by, F.when(same, F.col("lo")).otherwise(mixed).alias("value"))


def _wide(picked: DataFrame, cols: Sequence[str], probs: Sequence[float], keys: Sequence[str]) -> DataFrame:
    def one(c: str, i: int) -> Column:
        return F.max(F.when((F.col("column") == c) & (F.col("point") == i), F.col("value")))

    def many(c: str) -> Column:
        return F.when(one(c, 0).isNotNull(), F.array(*[one(c, i) for i in range(len(probs))]))

    return picked.groupBy(*keys).agg(*[many(c).alias(c) for c in cols])


def quantile_values(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], max_rows: int = MAX_GROUP_ROWS, stored: bool = False
) -> dict[str, list[float]]:
    """Quantiles of the whole frame as Python numbers, for fitted statistics and filter bounds."""
    row = quantiles(df, cols, probs, max_rows=max_rows, stored=stored).first()
    return {c: list(row[c] or [None] * len(probs)) for c in cols}
