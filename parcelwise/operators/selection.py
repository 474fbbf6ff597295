"""Top-k reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_features(scores: DataFrame, k: int = 20) -> DataFrame:
    """The k features of highest importance; equal scores in name order."""
    return scores.orderBy(F.desc("importance"), "feature").limit(k)


def top_factors(df: DataFrame, factors: list[str], k: int = 10, floor: float = 0.01) -> DataFrame:
    """Per row, the k contributions of largest magnitude above `floor`, with their sign.

    Works inside the row on an array, so no shuffle is needed."""
    entries = F.array(
        *[F.struct(F.abs(F.col(f)).alias("size"), F.lit(f).alias("feature"), F.col(f).alias("value")) for f in factors]
    )
    large = F.filter(entries, lambda e: e["size"] > floor)
    ordered = F.array_sort(
        large,
        lambda a, b: F.when(a["size"] > b["size"], -1)
        .when(a["size"] < b["size"], 1)
        .when(a["feature"] < b["feature"], -1)
        .otherwise(1),
    )
    rest = [c for c in df.columns if c not in factors]
    ranked = df.select(*rest, F.posexplode(F.slice(ordered, 1, k)).alias("__pos", "__factor"))
    return ranked.select(
        *rest,
        (F.col("__pos") + 1).alias("rank"),
        F.col("__factor.feature").alias("feature"),
        F.col("__factor.value").alias("value"),
        F.when(F.col("__factor.value") > 0, "positive").otherwise("negative").alias("contribution"),
    )
