"""Derived features of a property sale.

Where the definition of a feature differs between training, batch and request scoring, each
definition is a named function or a `variant`.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.schemas import DEFAULT_YEAR, FEATURE_CATALOGUE


def _c(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def property_age(year_built: str | Column = "year_built", current_year: int = DEFAULT_YEAR) -> Column:
    return F.lit(current_year) - _c(year_built)


def age_features(df: DataFrame, current_year: int = DEFAULT_YEAR) -> DataFrame:
    age = property_age("year_built", current_year)
    return df.withColumns(
        {
            "property_age": age,
            "property_age_squared": age * age,
            "property_age_log": F.log1p(age.cast("double")),
        }
    )


def ratio_features(df: DataFrame) -> DataFrame:
    beds, baths, sqft = (F.col(c) for c in ("bedrooms", "bathrooms", "square_feet"))
    return df.withColumns(
        {
            "bed_bath_ratio": F.try_divide(beds, baths + 1),
            "bath_bedroom_ratio": F.try_divide(baths, beds + 1),
            "sqft_per_bedroom": F.try_divide(sqft, beds + 1),
            "sqft_per_room": F.try_divide(sqft, beds + baths + 1),
            "sqft_per_room_raw": F.try_divide(sqft, beds + baths),
        }
    )


def interaction_features(df: DataFrame, current_year: int = DEFAULT_YEAR) -> DataFrame:
    age = property_age("year_built", current_year)
    out = {
        "size_age_interaction": F.col("square_feet") * age,
        "bed_age_interaction": F.col("bedrooms") * age,
        "sqft_bedroom_interaction": F.col("square_feet") * F.col("bedrooms"),
        "age_condition_interaction": age * F.col("condition_score"),
    }
    if {"latitude", "longitude"} <= set(df.columns):
        out["lat_lon_interaction"] = F.col("latitude") * F.col("longitude")
    return df.withColumns(out)


def polynomial_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "sqft_squared": F.col("square_feet") * F.col("square_feet"),
            "bedrooms_squared": F.col("bedrooms") * F.col("bedrooms"),
            "lot_sqrt": F.sqrt("lot_size"),
        }
    )


def log_features(df: DataFrame) -> DataFrame:
    return df.withColumns({"log_sqft": F.log1p("square_feet"), "log_lot": F.log1p("lot_size")})


def log_target(price: str | Column = "price") -> Column:
    return F.log1p(_c(price))


def price_from_log(log_price: str | Column) -> Column:
    return F.expm1(_c(log_price))


def is_luxury(variant: str = "training") -> Column:
    """training: >4 beds and pool; request: at least 4 beds and pool; catalogue: >4 beds."""
    large = F.col("square_feet") > 3000
    if variant == "training":
        return large & (F.col("bedrooms") > 4) & F.col("pool").cast("boolean")
    if variant == "request":
        return large & (F.col("bedrooms") >= 4) & F.col("pool").cast("boolean")
    if variant == "catalogue":
        return large & (F.col("bedrooms") > 4)
    raise ValueError(f"unknown variant {variant!r}")


def flag_features(df: DataFrame, current_year: int = DEFAULT_YEAR, variant: str = "training") -> DataFrame:
    age = property_age("year_built", current_year)
    return df.withColumns(
        {
            "is_new_construction": flag(age < 5),
            "is_old": flag(age > 50),
            "is_luxury": flag(is_luxury(variant)),
        }
    )


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def price_room_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "price_per_sqft": F.try_divide("price", "square_feet"),
            "rooms_total": F.col("bedrooms") + F.col("bathrooms"),
        }
    )


def weighted_score(terms: Iterable[tuple[float, str | Column]]) -> Column:
    total = F.lit(0.0)
    for weight, term in terms:
        total = total + F.lit(float(weight)) * _c(term)
    return total


def location_score(school: str | Column, crime: str | Column, walk: str | Column) -> Column:
    return weighted_score([(0.4, school), (0.3, F.lit(100) - _c(crime)), (0.3, walk)])


def band(col: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the half-open band a value lies in: below edges[0], below edges[1], ..., the rest."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    value = _c(col)
    chain = F.when(value < edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:-1]):
        chain = chain.when(value < edge, label)
    return chain.when(value.isNotNull(), labels[-1])


def one_hot(df: DataFrame, label: Column, values: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumns({f"{prefix}{v}": flag(label == v) for v in values})


def condition_bands(df: DataFrame) -> DataFrame:
    label = band("condition_score", [5, 8], ["fair", "good", "excellent"])
    return one_hot(df, label, ["excellent", "good", "fair"], "condition_")


def age_bands(df: DataFrame, current_year: int = DEFAULT_YEAR) -> DataFrame:
    label = band(property_age("year_built", current_year), [10, 30], ["new", "medium", "old"])
    return one_hot(df, label, ["new", "medium", "old"], "age_")


def calendar_features(df: DataFrame, ts: str = "sale_date") -> DataFrame:
    return df.withColumns(
        {
            "sale_year": F.year(ts),
            "sale_month": F.month(ts),
            "sale_quarter": F.quarter(ts),
            "sale_day_of_week": F.weekday(ts),
        }
    )


def cyclic(col: str | Column, period: float) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * _c(col) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def cyclic_features(df: DataFrame) -> DataFrame:
    month_sin, month_cos = cyclic("sale_month", 12)
    dow_sin, dow_cos = cyclic("sale_day_of_week", 7)
    return df.withColumns(
        {"month_sin": month_sin, "month_cos": month_cos, "dow_sin": dow_sin, "dow_cos": dow_cos}
    )


def catalogue_features(df: DataFrame, catalogue=FEATURE_CATALOGUE) -> DataFrame:
    """Add features from (name, type, expression) entries; later ones may use earlier ones."""
    for name, kind, expression in catalogue:
        sql = re.sub(r"(\w+|\([^()]*\))\s*\*\*\s*(\w+)", r"power(\1, \2)", expression)
        df = df.withColumn(name, F.expr(sql).cast(kind))
    return df


def training_features(df: DataFrame, current_year: int = DEFAULT_YEAR) -> DataFrame:
    """All row-wise derived and calendar features of the training path."""
    df = age_features(df, current_year)
    df = ratio_features(df).drop("bath_bedroom_ratio", "sqft_per_room_raw")
    df = interaction_features(df, current_year).drop("sqft_bedroom_interaction", "age_condition_interaction")
    df = polynomial_features(df).drop("bedrooms_squared")
    df = flag_features(log_features(df), current_year, "training")
    return cyclic_features(calendar_features(df))


def request_defaults(df: DataFrame, lot_default: str = "fifth_of_size") -> DataFrame:
    """Missing request fields to their defaults; booleans to 0/1. NaN is missing. Lot size: 0.2·sqft or 0."""
    def number(c: str) -> Column:
        return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))

    sqft = F.coalesce(number("square_feet"), F.lit(0.0))
    lot = sqft * 0.2 if lot_default == "fifth_of_size" else F.lit(0.0)
    filled = {
        "square_feet": sqft,
        "bedrooms": F.coalesce(number("bedrooms"), F.lit(0.0)),
        "bathrooms": F.coalesce(number("bathrooms"), F.lit(0.0)),
        "year_built": F.coalesce(number("year_built"), F.lit(2000.0)),
        "lot_size": F.coalesce(number("lot_size"), lot),
        "pool": F.coalesce(number("pool"), F.lit(0.0)),
        "fireplace": F.coalesce(number("fireplace"), F.lit(0.0)),
        "garage_spaces": F.coalesce(number("garage_spaces"), F.lit(0.0)),
        "condition_score": F.coalesce(number("condition_score"), F.lit(5.0)),
    }
    return df.withColumns(filled)


def request_features(df: DataFrame, current_year: int = DEFAULT_YEAR) -> DataFrame:
    """Features of the request-scoring path, on top of `request_defaults`."""
    df = age_features(request_defaults(df), current_year).drop("property_age_log")
    df = ratio_features(df).drop("bed_bath_ratio", "sqft_per_room", "sqft_per_room_raw")
    df = log_features(df)
    df = flag_features(df, current_year, "request").withColumnRenamed("is_old", "is_old_property")
    df = interaction_features(df, current_year).drop("size_age_interaction", "bed_age_interaction")
    return age_bands(condition_bands(polynomial_features(df).drop("lot_sqrt")), current_year)


def batch_features(df: DataFrame, current_year: int = DEFAULT_YEAR) -> DataFrame:
    """Features of the batch-scoring path: lot default 0, bed/bath ratio, new/old flags."""
    df = age_features(request_defaults(df, lot_default="zero"), current_year).drop("property_age_log")
    df = ratio_features(df).drop("bath_bedroom_ratio", "sqft_per_room", "sqft_per_room_raw")
    df = df.withColumn("log_sqft", F.log1p("square_feet"))
    age = property_age("year_built", current_year)
    return df.withColumns({"is_new": flag(age < 5), "is_old": flag(age > 50)})
