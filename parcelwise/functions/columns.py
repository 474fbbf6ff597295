"""Column-level helpers: missing values, column selection, row fingerprints."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise.schemas import FEATURE_GROUPS


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def float_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN counts as missing in this library; Spark alone would treat it as a large number."""
    floats = [c for c in float_columns(df) if cols is None or c in cols]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)) for c in floats})


def sanitize(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing to 0, +infinity to 1e6, -infinity to -1e6 over all numeric columns."""
    wanted = set(numeric_columns(df) if cols is None else cols)
    floats = set(float_columns(df))
    out = {}
    for c in df.columns:
        if c in wanted and c in floats:
            out[c] = finite(F.col(c))
        elif c in wanted:
            out[c] = F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType))
    return df.withColumns(out)


def finite(col: Column) -> Column:
    return (
        F.when(col.isNull() | F.isnan(col), 0.0)
        .when(col == float("inf"), 1e6)
        .when(col == float("-inf"), -1e6)
        .otherwise(col)
    )


def select_numeric(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    dropped = set(exclude)
    return df.select(*[c for c in numeric_columns(df) if c not in dropped])


def select_except(df: DataFrame, exclude: Iterable[str]) -> DataFrame:
    dropped = set(exclude)
    return df.select(*[c for c in df.columns if c not in dropped])


def select_ordered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Columns in a fixed order; a column that is absent is filled with 0."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(0.0).alias(c) for c in order])


def select_group(df: DataFrame, *groups: str) -> DataFrame:
    """Columns of named feature groups; an unknown group or absent column is an error."""
    cols = []
    for group in groups:
        if group not in FEATURE_GROUPS:
            raise ValueError(f"unknown feature group {group!r}")
        cols.extend(FEATURE_GROUPS[group])
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing for feature group: {missing}")
    return df.select(*cols)


def row_fingerprint(cols: Iterable[str]) -> Column:
    """md5 over `name=value` parts in name order; null and the text 'null' differ.

    Every value goes with its length, so no value can be taken for the start of the next part."""
    parts = []
    for c in sorted(cols):
        value = F.col(c).cast("string")
        told = F.concat(F.lit("v"), F.length(value).cast("string"), F.lit(":"), value)
        parts.append(F.concat(F.lit(f"{c}="), F.coalesce(told, F.lit("n"))))
    return F.md5(F.concat_ws("|", *parts))


def params_hash(params: Column) -> Column:
    """First 16 hex digits of the SHA-256 of a canonical parameter string."""
    return F.substring(F.sha2(params, 256), 1, 16)
