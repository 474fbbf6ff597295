"""Group statistics, profiles, histograms, correlations and counters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise.functions.columns import nan_to_null, numeric_columns
from parcelwise.operators.quantiles import quantiles
from parcelwise.scale import MAX_GROUP_ROWS, join_keys, largest_group, lookup_side


def group_stats(
    df: DataFrame, keys: Sequence[str] = ("zipcode",), digits: int | None = 2, max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Price mean, median, sample deviation, mean size and mean age per group; NaN counts as missing."""
    df = nan_to_null(df, ["price", "square_feet", "property_age"])
    means = [
        F.avg("price").alias("price_mean"),
        F.stddev_samp("price").alias("price_std"),
        F.avg("square_feet").alias("square_feet_mean"),
        F.avg("property_age").alias("property_age_mean"),
    ]
    if largest_group(df, keys) <= max_rows:
        stats = df.groupBy(*keys).agg(*means, F.median("price").alias("price_median"))
    else:
        medians = quantiles(df, ["price"], [0.5], keys, max_rows=max_rows)
        medians = medians.select(*keys, F.col("price")[0].alias("price_median"))
        stats = join_keys(df.groupBy(*keys).agg(*means), medians, keys)
    names = ["price_mean", "price_median", "price_std", "square_feet_mean", "property_age_mean"]
    cols = [F.col(n) if digits is None else F.round(n, digits).alias(n) for n in names]
    return stats.select(*keys, *cols)


@dataclass(frozen=True)
class GroupStats:
    """Group statistics fitted on one frame and joined to others; unseen groups get null."""

    keys: tuple[str, ...]
    table: DataFrame

    def apply(self, df: DataFrame) -> DataFrame:
        return join_keys(df, self.table, self.keys)


def fit_group_stats(df: DataFrame, keys: Sequence[str] = ("zipcode",)) -> GroupStats:
    return GroupStats(tuple(keys), lookup_side(group_stats(df, keys)))


def out_of_fold_stats(df: DataFrame, keys: Sequence[str], fold: str, folds: int) -> DataFrame:
    """`df` with the statistics of its group over all other folds: a row's own target is in none of them.

    Every row is counted for each fold but its own (column `fold`, from 0), in one aggregation."""
    others = F.filter(F.sequence(F.lit(0), F.lit(folds - 1)), lambda f: f != F.col(fold))
    needed = [*keys, "price", "square_feet", "property_age"]
    spread = df.select(*needed, F.explode(others).alias("__fold"))
    stats = group_stats(spread, [*keys, "__fold"]).withColumnRenamed("__fold", fold)
    return join_keys(df, lookup_side(stats), [*keys, fold])


def relative_price(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "price_vs_zip_avg": F.try_divide("price", "price_mean"),
            "price_vs_zip_median": F.try_divide("price", "price_median"),
        }
    )


def leave_one_out_mean(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Mean of the group without the row itself, so a target never explains itself."""
    clean = nan_to_null(df, [value])
    sums = clean.groupBy(*keys).agg(F.sum(value).alias("__sum"), F.count(value).alias("__n"))
    joined = join_keys(clean, lookup_side(sums), keys)
    alone = F.col(value).isNull()
    others = F.when(alone, F.try_divide("__sum", "__n")).otherwise(
        F.try_divide(F.col("__sum") - F.col(value), F.col("__n") - 1)
    )
    return joined.withColumn(out, others).drop("__sum", "__n")


def table_profile(df: DataFrame, date: str | None = None) -> DataFrame:
    """Long table (measure, column, value): rows, columns, kinds, nulls, duplicates, first/last date.

    Duplicate rows are found by a 256-bit digest of the row, which is what gets shuffled."""
    names = df.columns
    nulls = [F.sum(F.col(c).isNull().cast("long")).alias(f"null_{i}") for i, c in enumerate(names)]
    dates = []
    if date:
        dates = [F.min(date).cast("string").alias("min_date"), F.max(date).cast("string").alias("max_date")]
    flat = df.agg(F.count(F.lit(1)).alias("rows"), *nulls, *dates)
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    json = F.to_json(F.struct(*names), {"timestampFormat": micros, "timestampNTZFormat": micros})
    digest = F.sha2(json, 256)
    copies = df.groupBy(digest.alias("d")).agg(F.count(F.lit(1)).alias("n"))
    duplicates = copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))

    def entry(measure: str, column: str | None, value: Column) -> Column:
        return F.struct(
            F.lit(measure).alias("measure"),
            F.lit(column).cast("string").alias("column"),
            value.cast("string").alias("value"),
        )

    numeric = set(numeric_columns(df))
    entries = [entry("total_rows", None, F.col("rows")), entry("total_columns", None, F.lit(len(names)))]
    for i, field in enumerate(df.schema.fields):
        if field.name in numeric:
            kind = "numeric"
        else:
            kind = "categorical" if isinstance(field.dataType, T.StringType) else "other"
        entries.append(entry("missing_values", field.name, F.coalesce(F.col(f"null_{i}"), F.lit(0))))
        entries.append(entry("column_kind", field.name, F.lit(kind)))
    if date:
        entries += [entry("min_date", date, F.col("min_date")), entry("max_date", date, F.col("max_date"))]
    return flat.select(F.inline(F.array(*entries))).unionByName(
        duplicates.select(F.inline(F.array(entry("duplicate_rows", None, F.col("duplicates")))))
    )


def fixed_histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts per equal-width bin from minimum to maximum; the last bin includes the maximum.

    Null and NaN are in no bin."""
    df = nan_to_null(df, [column])
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None:
        return df.select(F.lit(0).alias("bin"), F.lit(0).cast("long").alias("n")).limit(0)
    width = (high - low) / bins if high > low else 1.0
    place = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "bin",
            (F.lit(low) + F.col("bin") * width).alias("bin_low"),
            (F.lit(low) + (F.col("bin") + 1) * width).alias("bin_high"),
            "n",
        )
    )


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair in one aggregation, as (column_a, column_b, correlation).

    A row counts for a pair if neither value is null or NaN."""
    df = nan_to_null(df, cols)
    pairs = list(combinations(cols, 2))
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    entries = [(c, c, F.lit(1.0)) for c in cols]
    for i, (a, b) in enumerate(pairs):
        entries += [(a, b, F.col(f"c{i}")), (b, a, F.col(f"c{i}"))]
    structs = [
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), v.alias("correlation"))
        for a, b, v in entries
    ]
    return row.select(F.inline(F.array(*structs)))


def latency_summary(
    df: DataFrame, ok: Column, latency: str, ts: str, max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Success rate, throughput and latency statistics of a request log; latencies of successes only.

    Percentiles interpolate inclusively."""
    total = df.agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(ok).alias("successes"),
        F.count_if(~ok).alias("failures"),
        (F.count_if(ok) / F.count(F.lit(1)) * 100).alias("success_rate"),
        F.try_divide(
            F.count(F.lit(1)).cast("double"), F.timestamp_diff("SECOND", F.min(ts), F.max(ts)).cast("double")
        ).alias("throughput"),
        F.min(F.when(ok, F.col(latency))).alias("latency_min"),
        F.max(F.when(ok, F.col(latency))).alias("latency_max"),
        F.avg(F.when(ok, F.col(latency))).alias("latency_mean"),
    )
    points = quantiles(df.filter(ok), [latency], [0.5, 0.95, 0.99], max_rows=max_rows).first()[0]
    names = ["latency_median", "latency_p95", "latency_p99"]
    found = points or [None] * 3
    return total.withColumns({n: F.lit(v).cast("double") for n, v in zip(names, found)})


def share_of_total(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per label combination and their share of all rows in percent."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t"))
    return counts.withColumn("share_pct", F.col("n") / total.select("t").scalar() * 100)


def labelled_counter(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    return df.groupBy(*labels).agg(F.count(F.lit(1)).alias("n"))


def feature_usage(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """How many rows supply each feature."""
    row = df.agg(*[F.count(f).alias(f) for f in features])
    return row.unpivot([], list(features), "feature", "n")


def bucketed_histogram(
    df: DataFrame, keys: Sequence[str], value: str, bounds: Sequence[float]
) -> DataFrame:
    """Cumulative counts per upper bound `le`, ending with infinity, plus sum and count per group."""
    hits = [F.count_if(F.col(value) <= b).alias(f"b{i}") for i, b in enumerate(bounds)]
    row = df.groupBy(*keys).agg(*hits, F.count(value).alias("n"), F.sum(value).alias("total"))
    entries = [F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").alias("cumulative")) for i, b in enumerate(bounds)]
    entries.append(F.struct(F.lit(float("inf")).alias("le"), F.col("n").alias("cumulative")))
    return row.select(*keys, F.inline(F.array(*entries)), "n", "total")


def hit_ratio(df: DataFrame, keys: Sequence[str], hit: Column) -> DataFrame:
    """hits / (hits + misses), 0 without lookups."""
    hits, misses = F.count_if(hit), F.count_if(~hit)
    return df.groupBy(*keys).agg(
        hits.alias("hits"),
        misses.alias("misses"),
        F.coalesce(F.try_divide(hits.cast("double"), hits + misses), F.lit(0.0)).alias("hit_ratio"),
    )


def cell_summary(df: DataFrame, cell: str) -> DataFrame:
    return df.groupBy(cell).agg(
        F.count(F.lit(1)).alias("n"), F.avg("price").alias("price_mean"), F.avg("square_feet").alias("sqft_mean")
    )
