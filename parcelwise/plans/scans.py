"""Scans, sinks and incremental reads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from parcelwise.plans.catalog import HISTORY, ID, ID_SQL, PREDICTIONS, query, with_sales
from parcelwise.scale import fresh_path
from parcelwise.schemas import TABLES
from parcelwise.sources.files import concat, file_inventory, load_csv, load_parquet, load_prefix, save_parquet
from parcelwise.sources.publish import (
    append_tracking,
    from_feature_json,
    metric_rows,
    online_features,
    read_tracking,
    with_feature_json,
)
from parcelwise.sources.sample_tables import feature_history, prediction_log, sales, table
from parcelwise.sources.tables import high_water_mark, ingest_incremental, ingest_query, ingest_table

LAST = datetime(1998, 6, 1)


@query(
    "s1_parquet_scan",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-06-01'",
)
def parquet_scan(spark, folder):
    rows = load_parquet(spark, f"{folder}/lineitem.parquet", TABLES["lineitem"])
    recent = rows.filter(F.col("l_shipdate") >= F.lit(LAST).cast("timestamp_ntz"))
    return recent.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("s2_csv_scan", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def csv_scan(spark, folder):
    path = fresh_path(spark, "csv")
    table(spark, folder, "orders").write.option("header", True).csv(path)
    return load_csv(spark, path, TABLES["orders"])


@query(
    "s3_prefix_scan",
    """SELECT o_orderkey, o_totalprice,
       CASE WHEN o_orderdate >= TIMESTAMP '1998-06-01' THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def prefix_scan(spark, folder):
    root = fresh_path(spark, "prefix")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    cut = F.lit(LAST).cast("timestamp_ntz")
    orders.filter(F.col("o_orderdate") < cut).drop("o_orderpriority").write.parquet(f"{root}/before")
    orders.filter(F.col("o_orderdate") >= cut).write.parquet(f"{root}/after")
    schema = "o_orderkey BIGINT, o_totalprice DOUBLE, o_orderpriority STRING"
    return load_prefix(spark, root, schema)


@query(
    "s4_file_inventory",
    """SELECT 'lineitem.parquet' AS file_name, count(*) AS row_count FROM lineitem
       UNION ALL SELECT 'orders.parquet', count(*) FROM orders""",
)
def inventory(spark, folder):
    parts = [file_inventory(table(spark, folder, name)) for name in ("lineitem", "orders")]
    return concat(parts).select(
        F.substring_index("file_path", "/", -1).alias("file_name"), F.col("rows").alias("row_count")
    )


@query(
    "s5_parquet_round_trip",
    with_sales(f"SELECT {ID_SQL}, price, CAST(year(sale_date) AS INTEGER) AS sale_year FROM sales"),
)
def parquet_round_trip(spark, folder):
    path = fresh_path(spark, "sink")
    rows = sales(spark, folder).select(*ID, "price", F.year("sale_date").alias("sale_year"))
    save_parquet(rows, path, partition_by=["sale_year"])
    save_parquet(rows.filter(F.col("sale_year") >= 1998), path, partition_by=["sale_year"])
    return load_parquet(spark, path, rows.schema)


@query(
    "s6_table_projection",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500",
)
def table_projection(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("orders_in")
    return ingest_table(
        spark, "orders_in", ["o_orderkey", "o_totalprice"], 500, [F.desc("o_totalprice"), "o_orderkey"]
    )


@query(
    "s7_bound_query",
    """SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS top FROM orders
       WHERE o_totalprice > 100000 GROUP BY o_orderpriority""",
)
def bound_query(spark, folder):
    return ingest_query(
        spark,
        "SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS top FROM {orders} "
        "WHERE o_totalprice > :low GROUP BY o_orderpriority",
        {"low": 100000},
        orders=table(spark, folder, "orders"),
    )


@query(
    "s8_incremental_scan",
    """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate > TIMESTAMP '1998-06-01'
       ORDER BY o_orderdate""",
)
def incremental_scan(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return ingest_incremental(rows, "o_orderdate", LAST)


@query(
    "s8_high_water_mark",
    """SELECT max(o_orderdate) AS high_water_mark, count(*) AS row_count FROM orders
       WHERE o_orderdate > TIMESTAMP '1998-06-01'""",
)
def water_mark(spark, folder):
    batch = ingest_incremental(table(spark, folder, "orders"), "o_orderdate", LAST, ordered=False)
    return high_water_mark(batch, "o_orderdate").withColumnRenamed("rows", "row_count")


@query(
    "s10_online_features",
    f"""WITH {HISTORY}, newest AS (
          SELECT * FROM history QUALIFY row_number() OVER (
            PARTITION BY entity_id ORDER BY event_timestamp DESC, created_timestamp DESC, order_id DESC, amount DESC) = 1)
        SELECT CAST(entity_id AS VARCHAR) AS entity_key, event_timestamp, created_timestamp,
               'order_id' AS feature_name, CAST(order_id AS VARCHAR) AS feature_value FROM newest
        UNION ALL
        SELECT CAST(entity_id AS VARCHAR), event_timestamp, created_timestamp, 'amount', CAST(amount AS VARCHAR)
        FROM newest""",
)
def publish(spark, folder):
    rows = feature_history(spark, folder)
    return online_features(rows, "entity_id", ["order_id", "amount"], "event_timestamp", "created_timestamp")


@query(
    "s11_prediction_log_table",
    f"""WITH {PREDICTIONS}
        SELECT CAST(request_id AS VARCHAR) AS request_id, model_version, segment, prediction, actual AS actual_price,
               ts AS "timestamp" FROM predictions""",
)
def prediction_log_table(spark, folder):
    root = fresh_path(spark, "tracking")
    rows = prediction_log(spark, folder)
    logged = with_feature_json(rows, ["segment"]).select(
        "request_id",
        "model_version",
        "features",
        "prediction",
        F.col("actual").alias("actual_price"),
        F.col("ts").alias("timestamp"),
    )
    append_tracking(logged, root, "prediction_logs")
    back = from_feature_json(read_tracking(spark, root, "prediction_logs"), "segment STRING")
    return back.select(
        "request_id", "model_version", "features.segment", "prediction", "actual_price", "timestamp"
    )


@query(
    "s11_metrics_table",
    """SELECT key, value, CAST(0 AS BIGINT) AS "timestamp", run_id, CAST(0 AS BIGINT) AS step, false AS is_nan FROM (
         SELECT 'top_price' AS key, max(o_totalprice) AS value, CAST(o_custkey AS VARCHAR) AS run_id
         FROM orders GROUP BY o_custkey
         UNION ALL
         SELECT 'orders', CAST(count(*) AS DOUBLE), CAST(o_custkey AS VARCHAR) FROM orders GROUP BY o_custkey)""",
)
def metrics_table(spark, folder):
    root = fresh_path(spark, "tracking")
    runs = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(F.max("o_totalprice").alias("top_price"), F.count(F.lit(1)).alias("orders"))
        .withColumns({"at": F.lit(0), "step": F.lit(0)})
    )
    append_tracking(metric_rows(runs, "o_custkey", ["top_price", "orders"], "at", "step"), root, "metrics")
    return read_tracking(spark, root, "metrics")
