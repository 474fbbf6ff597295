"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.scale import written


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b); root is the smallest node of the component.

    Each round hangs all neighbours of a node on the smallest of them, first upwards, then
    downwards, which takes a number of rounds logarithmic in the component size. Minima are combined
    before the shuffle and a hub's links are an ordinary skewed join side. Rounds are written to the
    shared folder, so a lost executor costs one round. Null ends and self links are ignored."""
    ends = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(ends.where("a > b").distinct(), "links")
    before = _signature(edges)
    while before[0]:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = written(small.union(least).distinct(), "links")
        after = _signature(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
