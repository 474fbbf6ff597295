"""Registry of the queries over the provided tables and of their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Added before rounding so that exact decimal ties fall the same way in every engine.
NUDGE = 1e-7


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that returns the same rows where SQL can express it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def near(col: str | Column, digits: int = 4) -> Column:
    value = F.col(col) if isinstance(col, str) else col
    return F.round(value.cast("double") + F.lit(NUDGE), digits)


def rnd(expression: str, digits: int = 4) -> str:
    """SQL text of `near`; adding zero turns a negative zero into zero."""
    return f"(round(CAST({expression} AS DOUBLE) + 1e-7, {digits}) + CAST(0 AS DOUBLE))"


SALES = """sales AS (
  SELECT l_partkey AS property_id, l_orderkey, l_linenumber,
         l_shipdate AS sale_date, l_extendedprice AS price,
         CAST(p_size * 100 AS DOUBLE) AS square_feet,
         CAST(1 + l_partkey % 6 AS INTEGER) AS bedrooms,
         CAST(1 + 0.5 * (l_partkey % 5) AS DOUBLE) AS bathrooms,
         CAST(1950 + l_partkey % 75 AS INTEGER) AS year_built,
         CAST(p_size * 250 AS DOUBLE) AS lot_size,
         CAST(10000 + s_nationkey * 37 AS VARCHAR) AS zipcode,
         s_nationkey AS location_id,
         CAST(25 AS DOUBLE) + CAST(0.9 AS DOUBLE) * s_nationkey AS latitude,
         CAST(-120 AS DOUBLE) + CAST(1.7 AS DOUBLE) * s_nationkey AS longitude,
         l_returnflag = 'R' AS pool,
         l_linestatus = 'O' AS fireplace,
         CAST(l_linenumber % 4 AS INTEGER) AS garage_spaces,
         round(CAST(1 AS DOUBLE) + CAST(90 AS DOUBLE) * l_discount, 2) AS condition_score
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""

DIRTY = """dirty AS (
  SELECT * REPLACE (
    CASE WHEN (l_orderkey + l_linenumber) % 13 <> 0 THEN square_feet END AS square_feet,
    CASE WHEN (l_orderkey + l_linenumber) % 17 <> 0 THEN year_built END AS year_built,
    CASE WHEN (l_orderkey + l_linenumber) % 19 <> 0 THEN bedrooms END AS bedrooms,
    CASE WHEN (l_orderkey + l_linenumber) % 101 = 0 THEN price * 100 ELSE price END AS price,
    CASE WHEN (l_orderkey + l_linenumber) % 103 = 0 THEN '12' ELSE zipcode END AS zipcode)
  FROM sales)"""

FILLED = """filled AS (
  SELECT * REPLACE (
    coalesce(square_feet, CAST(0 AS DOUBLE)) AS square_feet, coalesce(bedrooms, 2) AS bedrooms,
    coalesce(bathrooms, CAST(1.5 AS DOUBLE)) AS bathrooms, coalesce(year_built, 2000) AS year_built,
    coalesce(lot_size, CAST(0 AS DOUBLE)) AS lot_size,
    coalesce(condition_score, CAST(5 AS DOUBLE)) AS condition_score)
  FROM dirty)"""

DOMAIN = (
    "square_feet > 100 AND square_feet < 50000 AND bedrooms <= 10 AND price > 10000 AND price < 10000000"
)

REQUESTS = """log AS (
  SELECT event_id, user_id AS client, ts, event_type AS endpoint,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
         value AS latency_ms, 'v' || CAST(event_id % 3 AS VARCHAR) AS model_version
  FROM events)"""

PREDICTIONS = """predictions AS (
  SELECT o_orderkey AS request_id, 'v' || CAST(o_orderkey % 3 AS VARCHAR) AS model_version,
         o_orderpriority AS segment,
         o_totalprice * (CAST(0.9 AS DOUBLE) + CAST(0.01 AS DOUBLE) * (o_orderkey % 21)) AS prediction,
         CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS actual, o_orderdate AS ts
  FROM orders)"""

HISTORY = """history AS (
  SELECT o_custkey AS entity_id, o_orderdate AS event_timestamp,
         o_orderdate + to_days(CAST(o_orderkey % 5 AS INTEGER)) AS created_timestamp,
         o_orderkey AS order_id, o_totalprice AS amount
  FROM orders)"""

# Identifies one row of `sales`.
ID = ("property_id", "sale_date", "l_orderkey", "l_linenumber")
ID_SQL = ", ".join(ID)
ORDER_SQL = "sale_date, property_id, l_orderkey, l_linenumber"


# All columns of `sales`, and its numeric ones that identify nothing.
COLUMNS = (
    "property_id l_orderkey l_linenumber sale_date price square_feet bedrooms bathrooms year_built lot_size zipcode"
    " location_id latitude longitude pool fireplace garage_spaces condition_score"
).split()
NUMBERS = (
    "price square_feet bedrooms bathrooms year_built lot_size location_id latitude longitude garage_spaces condition_score"
).split()


def with_sales(body: str, *more: str) -> str:
    return "WITH " + ", ".join([SALES, *more]) + " " + body
