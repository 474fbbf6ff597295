"""Deduplication, filling, filtering and imputation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.columns import nan_to_null, numeric_columns
from parcelwise.operators.quantiles import quantile_values, quantiles
from parcelwise.scale import MAX_GROUP_ROWS, join_keys, lookup_side, written
from parcelwise.schemas import CLEAN_DEFAULTS


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first along `order`.

    Written as a minimum over structs, which is combined before the shuffle, so a hot key sends one
    row per input task instead of all its rows."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("__first")
    kept = df.groupBy(*keys).agg(first)
    return kept.select(*[c if c in keys else F.col(f"__first.{c}").alias(c) for c in df.columns])


def fill_constants(df: DataFrame, defaults: dict[str, object] = CLEAN_DEFAULTS) -> DataFrame:
    return df.na.fill({c: v for c, v in defaults.items() if c in df.columns})


def domain_filter(df: DataFrame) -> DataFrame:
    """Plausible sizes, bedrooms and prices; a missing value does not pass."""
    return df.filter(
        (F.col("square_feet") > 100)
        & (F.col("square_feet") < 50000)
        & (F.col("bedrooms") <= 10)
        & (F.col("price") > 10000)
        & (F.col("price") < 10000000)
    )


def impute_by_group(
    df: DataFrame,
    keys: Sequence[str],
    medians: Sequence[str],
    constants: dict[str, object],
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Missing values, NaN among them, to the group median, then the overall median; other columns to constants."""
    df = nan_to_null(df, medians)
    slim = written(df.select(*dict.fromkeys([*keys, *medians])), "imputed-columns")
    per_group = quantiles(slim, medians, [0.5], keys, max_rows=max_rows, stored=True)
    per_group = per_group.select(*keys, *[F.col(c)[0].alias(f"__med_{c}") for c in medians])
    overall = quantile_values(slim, medians, [0.5], max_rows=max_rows, stored=True)
    joined = join_keys(df, lookup_side(per_group), keys)
    for c in medians:
        filled = F.coalesce(c, f"__med_{c}", F.lit(overall[c][0]))
        joined = joined.withColumn(c, filled.cast(df.schema[c].dataType))
    return joined.select(*df.columns).na.fill(constants)


@dataclass(frozen=True)
class MedianImputer:
    """Medians fitted once and applied to any later frame."""

    medians: dict[str, float]

    def apply(self, df: DataFrame) -> DataFrame:
        filled = {
            c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(m)) for c, m in self.medians.items() if c in df.columns
        }
        return df.withColumns(filled)


def fit_median_imputer(
    df: DataFrame, cols: Sequence[str] | None = None, max_rows: int = MAX_GROUP_ROWS
) -> MedianImputer:
    cols = numeric_columns(df) if cols is None else list(cols)
    found = quantile_values(df, cols, [0.5], max_rows=max_rows)
    return MedianImputer({c: v[0] for c, v in found.items()})


def trim_upper(
    df: DataFrame, cols: Sequence[str], prob: float = 0.99, max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Drop rows above the quantile of each column in turn; later columns see the earlier trims."""
    slim = written(df.select(*cols), "trimmed-columns")
    for c in cols:
        bound = quantile_values(slim, [c], [prob], max_rows=max_rows, stored=True)[c][0]
        df, slim = (rows.filter(F.col(c) <= F.lit(bound)) for rows in (df, slim))
    return df
