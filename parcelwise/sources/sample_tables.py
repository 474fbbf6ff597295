"""Property-sales shaped frames over the provided star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.schemas import TABLES

# Columns that order the sales of one property uniquely.
SALE_ORDER = ("sale_date", "l_orderkey", "l_linenumber")
# Unique order of all sales.
SALE_KEY = ("property_id", *SALE_ORDER)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """One row per sold line: property attributes, location and price."""
    return (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("l_partkey").alias("property_id"),
            "l_orderkey",
            "l_linenumber",
            F.col("l_shipdate").alias("sale_date"),
            F.col("l_extendedprice").alias("price"),
            (F.col("p_size") * 100).cast("double").alias("square_feet"),
            (F.lit(1) + F.col("l_partkey") % 6).cast("int").alias("bedrooms"),
            (F.lit(1) + F.lit(0.5) * (F.col("l_partkey") % 5)).alias("bathrooms"),
            (F.lit(1950) + F.col("l_partkey") % 75).cast("int").alias("year_built"),
            (F.col("p_size") * 250).cast("double").alias("lot_size"),
            (F.lit(10000) + F.col("s_nationkey") * 37).cast("string").alias("zipcode"),
            F.col("s_nationkey").alias("location_id"),
            (F.lit(25) + F.lit(0.9) * F.col("s_nationkey")).alias("latitude"),
            (F.lit(-120) + F.lit(1.7) * F.col("s_nationkey")).alias("longitude"),
            (F.col("l_returnflag") == "R").alias("pool"),
            (F.col("l_linestatus") == "O").alias("fireplace"),
            (F.col("l_linenumber") % 4).cast("int").alias("garage_spaces"),
            F.round(F.lit(1) + F.lit(90) * F.col("l_discount"), 2).alias("condition_score"),
        )
    )


def sales_dirty(spark: SparkSession, folder: str) -> DataFrame:
    """`sales` with missing values, inflated prices and malformed zipcodes at fixed places."""
    k = F.col("l_orderkey") + F.col("l_linenumber")
    return sales(spark, folder).withColumns(
        {
            "square_feet": F.when(k % 13 != 0, F.col("square_feet")),
            "year_built": F.when(k % 17 != 0, F.col("year_built")),
            "bedrooms": F.when(k % 19 != 0, F.col("bedrooms")),
            "price": F.when(k % 101 == 0, F.col("price") * 100).otherwise(F.col("price")),
            "zipcode": F.when(k % 103 == 0, F.lit("12")).otherwise(F.col("zipcode")),
        }
    )


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").alias("client"),
        "ts",
        F.col("event_type").alias("endpoint"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        F.col("value").alias("latency_ms"),
        F.concat(F.lit("v"), (F.col("event_id") % 3).cast("string")).alias("model_version"),
    )


def prediction_log(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions with the price that became known later; every tenth price is still missing."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.concat(F.lit("v"), (F.col("o_orderkey") % 3).cast("string")).alias("model_version"),
        F.col("o_orderpriority").alias("segment"),
        (F.col("o_totalprice") * (F.lit(0.9) + F.lit(0.01) * (F.col("o_orderkey") % 21))).alias("prediction"),
        F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice")).alias("actual"),
        F.col("o_orderdate").alias("ts"),
    )


def feature_history(spark: SparkSession, folder: str) -> DataFrame:
    """Feature rows keyed by customer with event and created times."""
    days = (F.col("o_orderkey") % 5).cast("int")
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("entity_id"),
        F.col("o_orderdate").alias("event_timestamp"),
        (F.col("o_orderdate") + F.make_interval(days=days)).alias("created_timestamp"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("amount"),
    )


def customer_ids(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("entity_id"))
