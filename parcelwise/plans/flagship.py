"""The batch feature job: clean, derive, roll, rank."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.functions.features import age_features, log_features, log_target, price_room_features
from parcelwise.operators.cleaning import domain_filter, fill_constants
from parcelwise.operators.encoding import frequency_index
from parcelwise.operators.ordering import day_number, key_sizes, rolling_rows
from parcelwise.operators.windows import percent_rank_within
from parcelwise.plans.catalog import DIRTY, DOMAIN, FILLED, ID, ID_SQL, ORDER_SQL, near, query, rnd, with_sales
from parcelwise.sources.sample_tables import sales_dirty


def feature_job(rows: DataFrame, order: list[str], max_rows: int | None = None) -> DataFrame:
    """Sales with derived, rolling and rank features per zipcode.

    The rolling means come first: they shuffle by zipcode and sort by date, and the rank reuses
    that shuffle with a second sort."""
    bound = {} if max_rows is None else {"max_rows": max_rows}
    clean = domain_filter(fill_constants(rows))
    derived = log_features(price_room_features(age_features(clean))).withColumn("log_price", log_target())
    # One count per zipcode serves the index and the search for hot zipcodes.
    sizes = key_sizes(clean, ["zipcode"])
    indexed = frequency_index(derived, "zipcode", "zipcode_index", sizes)
    rolled = rolling_rows(
        indexed,
        ["zipcode"],
        order,
        {"rolling_avg_price_30d": ("price", 30), "rolling_avg_price_90d": ("price", 90)},
        day_number(F.col("sale_date")),
        sizes=sizes,
        **bound,
    )
    return percent_rank_within(rolled, ["zipcode"], "price", "price_rank_zipcode", sizes=sizes, **bound)


ROLL = "avg(price) OVER (PARTITION BY zipcode ORDER BY {} ROWS BETWEEN {} PRECEDING AND 1 PRECEDING)"


@query(
    "flagship_feature_job",
    with_sales(
        f"""SELECT {ID_SQL}, zipcode, price, CAST(2024 - year_built AS INTEGER) AS property_age,
              {rnd("price / square_feet")} AS price_per_sqft, bedrooms + bathrooms AS rooms_total,
              {rnd("ln(1 + price)", 6)} AS log_price, zipcode_index,
              {rnd(ROLL.format(ORDER_SQL, 30))} AS rolling_avg_price_30d,
              {rnd(ROLL.format(ORDER_SQL, 90))} AS rolling_avg_price_90d,
              {rnd("percent_rank() OVER (PARTITION BY zipcode ORDER BY price)", 8)} AS price_rank_zipcode
            FROM clean JOIN (
              SELECT zipcode, CAST(row_number() OVER (ORDER BY count(*) DESC, zipcode) - 1 AS DOUBLE) AS zipcode_index
              FROM clean GROUP BY zipcode) USING (zipcode)""",
        DIRTY,
        FILLED,
        f"clean AS (SELECT * FROM filled WHERE {DOMAIN})",
    ),
)
def flagship(spark: SparkSession, folder: str) -> DataFrame:
    rows = feature_job(sales_dirty(spark, folder), ["sale_date", "property_id", "l_orderkey", "l_linenumber"])
    return rows.select(
        *ID,
        "zipcode",
        "price",
        "property_age",
        near("price_per_sqft").alias("price_per_sqft"),
        "rooms_total",
        near("log_price", 6).alias("log_price"),
        "zipcode_index",
        near("rolling_avg_price_30d").alias("rolling_avg_price_30d"),
        near("rolling_avg_price_90d").alias("rolling_avg_price_90d"),
        near("price_rank_zipcode", 8).alias("price_rank_zipcode"),
    )
