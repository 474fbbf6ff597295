"""Aggregations, metrics, windows, joins and top-k reports."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from parcelwise.functions.columns import numeric_columns, row_fingerprint
from parcelwise.functions.features import age_features, price_room_features
from parcelwise.operators import aggregates as agg
from parcelwise.operators import joins
from parcelwise.operators import metrics as met
from parcelwise.operators import windows as win
from parcelwise.operators.ordering import day_number, rolling_rows
from parcelwise.operators.selection import top_factors, top_features
from parcelwise.operators.splits import chronological_position
from parcelwise.plans.catalog import (
    COLUMNS,
    DIRTY,
    HISTORY,
    ID,
    ID_SQL,
    NUMBERS,
    ORDER_SQL,
    PREDICTIONS,
    REQUESTS,
    near,
    query,
    rnd,
    with_sales,
)
from parcelwise.schemas import PRICE_BOUNDS, REQUEST_SECONDS_BOUNDS, SIZE_BOUNDS
from parcelwise.sources.files import concat
from parcelwise.sources.sample_tables import (
    customer_ids,
    feature_history,
    prediction_log,
    request_log,
    sales,
    sales_dirty,
    table,
)

ORDER = ["sale_date", "property_id", "l_orderkey", "l_linenumber"]

# ---------------------------------------------------------------- aggregations


def _priced(spark, folder):
    return age_features(sales(spark, folder))


STATS_SQL = """SELECT zipcode, avg(price) AS price_mean, median(price) AS price_median, stddev_samp(price) AS price_std,
  avg(square_feet) AS square_feet_mean, avg(CAST(2024 - year_built AS DOUBLE)) AS property_age_mean
  FROM sales GROUP BY zipcode"""
STATS = ["price_mean", "price_median", "price_std", "square_feet_mean", "property_age_mean"]


@query(
    "a1_group_stats",
    with_sales("SELECT zipcode" + "".join(f", {rnd(c)} AS {c}" for c in STATS) + f" FROM ({STATS_SQL})"),
)
def a1(spark, folder):
    stats = agg.group_stats(_priced(spark, folder), digits=None)
    return stats.select("zipcode", *[near(c).alias(c) for c in STATS])


@query(
    "a2_relative_price",
    with_sales(
        f"""SELECT {ID_SQL}, {rnd("price / price_mean", 6)} AS price_vs_zip_avg,
              {rnd("price / price_median", 6)} AS price_vs_zip_median FROM sales JOIN ({STATS_SQL}) USING (zipcode)"""
    ),
)
def a2(spark, folder):
    rows = _priced(spark, folder)
    joined = agg.relative_price(joins.join_stats(rows, agg.group_stats(rows, digits=None), ["zipcode"]))
    cols = ["price_vs_zip_avg", "price_vs_zip_median"]
    return joined.select(*ID, *[near(c, 6).alias(c) for c in cols])


@query(
    "a2_leave_one_out_mean",
    with_sales(
        f"""SELECT {ID_SQL}, {rnd("(s - price) / (n - 1)")} AS others_mean FROM sales JOIN (
              SELECT zipcode, sum(price) AS s, count(price) AS n FROM sales GROUP BY zipcode) USING (zipcode)"""
    ),
)
def a2_loo(spark, folder):
    rows = agg.leave_one_out_mean(sales(spark, folder), ["zipcode"], "price", "others_mean")
    return rows.select(*ID, near("others_mean").alias("others_mean"))


PROFILED = COLUMNS
KINDS = {c: "numeric" if c in NUMBERS or (c in ID and c != "sale_date") else "other" for c in COLUMNS} | {"zipcode": "categorical"}


def _profile_sql() -> str:
    rows = [
        ("total_rows", None, "(SELECT count(*) FROM p)"),
        ("total_columns", None, str(len(PROFILED))),
        ("duplicate_rows", None, "(SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM p GROUP BY ALL))"),
        ("min_date", "sale_date", "(SELECT min(sale_date) FROM p)"),
        ("max_date", "sale_date", "(SELECT max(sale_date) FROM p)"),
    ]
    for c in PROFILED:
        rows.append(("missing_values", c, f"(SELECT count(*) - count({c}) FROM p)"))
        rows.append(("column_kind", c, f"'{KINDS[c]}'"))
    parts = [
        f"SELECT '{m}' AS measure, {'CAST(NULL AS VARCHAR)' if c is None else repr(c)} AS \"column\", "
        f"CAST({v} AS VARCHAR) AS value"
        for m, c, v in rows
    ]
    duplicates = "p AS (SELECT " + ", ".join(PROFILED) + " FROM dirty)"
    body = " UNION ALL ".join(parts).replace(
        "(SELECT count(*) AS n FROM p GROUP BY ALL)",
        "(SELECT count(*) AS n, " + ", ".join(PROFILED) + " FROM p GROUP BY ALL)",
    )
    return with_sales(body, DIRTY, duplicates)


@query("a3_table_profile", _profile_sql())
def a3(spark, folder):
    return agg.table_profile(sales_dirty(spark, folder), "sale_date")


@query(
    "a4_price_histogram",
    with_sales(
        f"""SELECT CAST(least(floor((price - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, count(*) AS n
            FROM sales, (SELECT min(price) AS lo, max(price) AS hi FROM sales) GROUP BY bin"""
    ),
)
def a4(spark, folder):
    return agg.fixed_histogram(sales(spark, folder), "price", 50).select("bin", "n")


@query(
    "a4_log_price_histogram",
    with_sales(
        """SELECT CAST(least(floor((v - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, count(*) AS n
           FROM logs, (SELECT min(v) AS lo, max(v) AS hi FROM logs) GROUP BY bin""",
        "logs AS (SELECT round(ln(1 + price), 9) AS v FROM sales)",
    ),
)
def a4_log(spark, folder):
    rows = sales(spark, folder).select(F.round(F.log1p("price"), 9).alias("v"))
    return agg.fixed_histogram(rows, "v", 50).select("bin", "n")


CORRELATED = NUMBERS


@query(
    "a5_correlation_matrix",
    with_sales(
        " UNION ALL ".join(
            f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
            + ("CAST(1 AS DOUBLE)" if a == b else rnd(f"corr({a}, {b})", 6))
            + " AS correlation FROM dirty"
            + (" LIMIT 1" if a == b else "")
            if a != b
            else f"SELECT '{a}', '{b}', CAST(1 AS DOUBLE)"
            for a in CORRELATED
            for b in reversed(CORRELATED)
        ),
        DIRTY,
    ),
)
def a5(spark, folder):
    rows = sales_dirty(spark, folder)
    cols = [c for c in numeric_columns(rows) if c not in ID]
    return agg.correlation_matrix(rows, cols).withColumn("correlation", near("correlation", 6))


METRIC_SQL = {
    "n": "count(actual)",
    "mae": rnd("avg(abs(prediction - actual))"),
    "rmse": rnd("sqrt(avg((prediction - actual) * (prediction - actual)))"),
    "r2": rnd("1 - sum((prediction - actual) * (prediction - actual)) / (var_pop(actual) * count(actual))", 6),
    "mape": rnd("avg(abs((prediction - actual) / actual)) * 100", 6),
    "zero_actuals": "count(*) FILTER (WHERE actual = 0)",
    "error_mean": rnd("avg(prediction - actual)"),
    "error_std": rnd("stddev_pop(prediction - actual)"),
}
METRIC_DIGITS = {"mae": 4, "rmse": 4, "r2": 6, "mape": 6, "error_mean": 4, "error_std": 4}
METRIC_COLUMNS = ", ".join(f"{v} AS {k}" for k, v in METRIC_SQL.items())
KNOWN = "known AS (SELECT * FROM predictions WHERE actual IS NOT NULL)"


def _known(spark, folder):
    return prediction_log(spark, folder).filter(F.col("actual").isNotNull())


def _rounded(df, keys=()):
    return df.select(
        *keys, *[near(c, METRIC_DIGITS[c]).alias(c) if c in METRIC_DIGITS else F.col(c) for c in METRIC_SQL]
    )


@query("a6_regression_metrics", f"WITH {PREDICTIONS}, {KNOWN} SELECT {METRIC_COLUMNS} FROM known")
def a6(spark, folder):
    return _rounded(met.regression_metrics(_known(spark, folder)))


QUANTILE_SQL = ", ".join(
    f"{rnd(f'quantile_cont(prediction - actual, {p})')} AS q{round(p * 100)}" for p in met.ERROR_QUANTILES
)
QUANTILE_NAMES = [f"q{round(p * 100)}" for p in met.ERROR_QUANTILES]


@query("a7_error_quantiles", f"WITH {PREDICTIONS}, {KNOWN} SELECT {QUANTILE_SQL} FROM known")
def a7(spark, folder):
    return met.error_quantiles(_known(spark, folder)).select(*[near(q).alias(q) for q in QUANTILE_NAMES])


# Bounds that no relative error of the fixture meets exactly.
WITHIN_SQL = ", ".join(
    rnd(f"avg(CASE WHEN abs((prediction - actual) / actual) <= {b} THEN 1.0 ELSE 0.0 END) * 100", 6)
    + f" AS within_{round(b * 100)}pct"
    for b in met.WITHIN_BOUNDS
)
WITHIN_NAMES = [f"within_{round(b * 100)}pct" for b in met.WITHIN_BOUNDS]
SHIFTED = "known AS (SELECT * REPLACE (prediction + 0.001 * actual AS prediction) FROM predictions WHERE actual IS NOT NULL)"


def _shifted(spark, folder):
    return _known(spark, folder).withColumn("prediction", F.col("prediction") + F.lit(0.001) * F.col("actual"))


@query("a8_within_shares", f"WITH {PREDICTIONS}, {SHIFTED} SELECT {WITHIN_SQL} FROM known")
def a8(spark, folder):
    return met.within_shares(_shifted(spark, folder)).select(*[near(c, 6).alias(c) for c in WITHIN_NAMES])


@query(
    "a9_segment_metrics",
    f"""WITH {PREDICTIONS}, {SHIFTED} SELECT segment, {METRIC_COLUMNS}, {WITHIN_SQL}, {QUANTILE_SQL} FROM known
        GROUP BY segment HAVING count(*) > 10""",
)
def a9(spark, folder):
    rows = met.segment_metrics(_shifted(spark, folder), "segment")
    extra = [near(c, 6).alias(c) for c in WITHIN_NAMES] + [near(q).alias(q) for q in QUANTILE_NAMES]
    shown = [near(c, METRIC_DIGITS[c]).alias(c) if c in METRIC_DIGITS else F.col(c) for c in METRIC_SQL]
    return rows.select("segment", *shown, *extra)


@query(
    "a10_fold_summary",
    f"""WITH {PREDICTIONS}, {KNOWN}, folds AS (
          SELECT request_id % 5 AS fold, avg(abs(prediction - actual)) AS mae,
                 sqrt(avg((prediction - actual) * (prediction - actual))) AS rmse FROM known GROUP BY fold),
        long AS (SELECT 'mae' AS metric, mae AS score FROM folds UNION ALL SELECT 'rmse', rmse FROM folds)
        SELECT metric, {rnd("avg(score)")} AS mean, {rnd("stddev_pop(score)")} AS std,
               {rnd("min(score)")} AS min, {rnd("max(score)")} AS max FROM long GROUP BY metric""",
)
def a10(spark, folder):
    folds = met.regression_metrics(_known(spark, folder).withColumn("fold", F.col("request_id") % 5), ["fold"])
    summary = met.fold_summary(folds, ["mae", "rmse"])
    return summary.select("metric", *[near(c).alias(c) for c in ("mean", "std", "min", "max")])


@query(
    "a11_request_summary",
    f"""WITH {REQUESTS} SELECT count(*) AS requests, count(*) FILTER (WHERE status < 400) AS successes,
          count(*) FILTER (WHERE status >= 400) AS failures,
          {rnd("count(*) FILTER (WHERE status < 400) * 100.0 / count(*)")} AS success_rate,
          {rnd("count(*) / CAST(date_sub('second', min(ts), max(ts)) AS DOUBLE)", 8)} AS throughput,
          min(latency_ms) FILTER (WHERE status < 400) AS latency_min,
          max(latency_ms) FILTER (WHERE status < 400) AS latency_max,
          {rnd("avg(latency_ms) FILTER (WHERE status < 400)")} AS latency_mean,
          {rnd("quantile_cont(latency_ms, 0.5) FILTER (WHERE status < 400)")} AS latency_median,
          {rnd("quantile_cont(latency_ms, 0.95) FILTER (WHERE status < 400)")} AS latency_p95,
          {rnd("quantile_cont(latency_ms, 0.99) FILTER (WHERE status < 400)")} AS latency_p99 FROM log""",
)
def a11(spark, folder):
    s = agg.latency_summary(request_log(spark, folder), F.col("status") < 400, "latency_ms", "ts")
    digits = {"success_rate": 4, "throughput": 8, "latency_mean": 4, "latency_median": 4, "latency_p95": 4, "latency_p99": 4}
    return s.select(*[near(c, digits[c]).alias(c) if c in digits else F.col(c) for c in s.columns])


@query(
    "a12_status_shares",
    f"""WITH {REQUESTS} SELECT status, count(*) AS n,
          {rnd("count(*) * 100.0 / (SELECT count(*) FROM log)")} AS share_pct FROM log GROUP BY status""",
)
def a12(spark, folder):
    return agg.share_of_total(request_log(spark, folder), ["status"]).withColumn("share_pct", near("share_pct"))


@query(
    "a13_labelled_counters",
    f"WITH {REQUESTS} SELECT model_version, status, count(*) AS n FROM log GROUP BY model_version, status",
)
def a13(spark, folder):
    return agg.labelled_counter(request_log(spark, folder), ["model_version", "status"])


@query("a13_zipcode_counter", with_sales("SELECT zipcode, count(*) AS n FROM sales GROUP BY zipcode"))
def a13_zip(spark, folder):
    return agg.labelled_counter(sales(spark, folder), ["zipcode"])


@query(
    "a13_feature_usage",
    with_sales(
        """SELECT 'square_feet' AS feature, count(square_feet) AS n FROM dirty UNION ALL
           SELECT 'bedrooms', count(bedrooms) FROM dirty UNION ALL SELECT 'year_built', count(year_built) FROM dirty""",
        DIRTY,
    ),
)
def a13_usage(spark, folder):
    return agg.feature_usage(sales_dirty(spark, folder), ["square_feet", "bedrooms", "year_built"])


@query(
    "a14_price_buckets",
    f"""SELECT o_orderpriority, le, CASE WHEN le = CAST('inf' AS DOUBLE) THEN count(*)
               ELSE count(*) FILTER (WHERE o_totalprice <= le) END AS cumulative, count(*) AS n,
          {rnd("sum(o_totalprice)", 2)} AS total
        FROM orders, (SELECT CAST(unnest([{", ".join(map(str, PRICE_BOUNDS))}, CAST('inf' AS DOUBLE)]) AS DOUBLE) AS le)
        GROUP BY o_orderpriority, le""",
)
def a14(spark, folder):
    rows = agg.bucketed_histogram(table(spark, folder, "orders"), ["o_orderpriority"], "o_totalprice", PRICE_BOUNDS)
    return rows.withColumn("total", near("total", 2))


@query(
    "a14_latency_buckets",
    f"""WITH {REQUESTS} SELECT endpoint, le, CASE WHEN le = CAST('inf' AS DOUBLE) THEN count(*)
               ELSE count(*) FILTER (WHERE latency_ms / 1000 <= le) END AS cumulative, count(*) AS n,
          {rnd("sum(latency_ms / 1000)", 4)} AS total
        FROM log, (SELECT CAST(unnest([{", ".join(map(str, REQUEST_SECONDS_BOUNDS))}, CAST('inf' AS DOUBLE)]) AS DOUBLE) AS le)
        GROUP BY endpoint, le""",
)
def a14_latency(spark, folder):
    rows = request_log(spark, folder).withColumn("seconds", F.col("latency_ms") / 1000)
    found = agg.bucketed_histogram(rows, ["endpoint"], "seconds", REQUEST_SECONDS_BOUNDS)
    return found.withColumn("total", near("total", 4))


@query(
    "a14_size_buckets",
    f"""SELECT lang, le, CASE WHEN le = CAST('inf' AS DOUBLE) THEN count(*)
               ELSE count(*) FILTER (WHERE strlen(text) <= le) END AS cumulative, count(*) AS n,
          CAST(sum(strlen(text)) AS BIGINT) AS total
        FROM documents, (SELECT CAST(unnest([{", ".join(map(str, SIZE_BOUNDS))}, CAST('inf' AS DOUBLE)]) AS DOUBLE) AS le)
        GROUP BY lang, le""",
)
def a14_size(spark, folder):
    bodies = spark.read.parquet(f"{folder}/documents.parquet").withColumn("bytes", F.octet_length("text").cast("long"))
    return agg.bucketed_histogram(bodies, ["lang"], "bytes", SIZE_BOUNDS)


@query(
    "a15_hit_ratio",
    f"""WITH {REQUESTS} SELECT model_version, count(*) FILTER (WHERE endpoint = 'view') AS hits,
          count(*) FILTER (WHERE endpoint <> 'view') AS misses,
          {rnd("count(*) FILTER (WHERE endpoint = 'view') / CAST(count(*) AS DOUBLE)", 6)} AS hit_ratio
        FROM log GROUP BY model_version""",
)
def a15(spark, folder):
    rows = agg.hit_ratio(request_log(spark, folder), ["model_version"], F.col("endpoint") == "view")
    return rows.withColumn("hit_ratio", near("hit_ratio", 6))


# ---------------------------------------------------------------- windows


@query(
    "w1_rolling_rows_property",
    with_sales(
        f"""SELECT {ID_SQL}, {rnd("avg(price) OVER (PARTITION BY property_id ORDER BY sale_date, l_orderkey, "
                                  "l_linenumber ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)")} AS rolling_avg_price_30
            FROM sales"""
    ),
)
def w1(spark, folder):
    rows = rolling_rows(
        sales(spark, folder).select(*ID, "price"),
        ["property_id"],
        ["sale_date", "l_orderkey", "l_linenumber"],
        {"rolling_avg_price_30": ("price", 30)},
        day_number(F.col("sale_date")),
    )
    return rows.select(*ID, near("rolling_avg_price_30").alias("rolling_avg_price_30"))


@query(
    "w2_rolling_rows_zipcode",
    with_sales(
        f"""SELECT {ID_SQL},
              {rnd(f"avg(price) OVER (PARTITION BY zipcode ORDER BY {ORDER_SQL} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)")} AS rolling_avg_price_30,
              {rnd(f"avg(price) OVER (PARTITION BY zipcode ORDER BY {ORDER_SQL} ROWS BETWEEN 90 PRECEDING AND 1 PRECEDING)")} AS rolling_avg_price_90
            FROM sales"""
    ),
)
def w2(spark, folder):
    rows = rolling_rows(
        sales(spark, folder).select(*ID, "price", "zipcode"),
        ["zipcode"],
        ORDER,
        {"rolling_avg_price_30": ("price", 30), "rolling_avg_price_90": ("price", 90)},
        day_number(F.col("sale_date")),
    )
    return rows.select(*ID, *[near(c).alias(c) for c in ("rolling_avg_price_30", "rolling_avg_price_90")])


@query(
    "w3_percent_rank",
    with_sales(
        f"""SELECT {ID_SQL}, {rnd("percent_rank() OVER (PARTITION BY zipcode ORDER BY price)", 8)} AS price_rank_zipcode
            FROM sales"""
    ),
)
def w3(spark, folder):
    rows = win.percent_rank_within(
        sales(spark, folder).select(*ID, "price", "zipcode"), ["zipcode"], "price", "price_rank_zipcode"
    )
    return rows.select(*ID, near("price_rank_zipcode", 8).alias("price_rank_zipcode"))


DAYS_30 = (
    "(PARTITION BY zipcode ORDER BY CAST(sale_date AS DATE) "
    "RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)"
)


@query(
    "w4_rolling_days",
    with_sales(
        f"""SELECT {ID_SQL}, {rnd(f"avg(price / square_feet) OVER {DAYS_30}")} AS price_per_sqft_rolling_30d,
              {rnd(f"avg(garage_spaces) OVER {DAYS_30}", 6)} AS garage_rolling_30d FROM sales"""
    ),
)
def w4(spark, folder):
    rows = win.rolling_days(
        price_room_features(sales(spark, folder)).select(*ID, "zipcode", "price_per_sqft", "garage_spaces"),
        ["zipcode"],
        "sale_date",
        {"price_per_sqft_rolling_30d": ("price_per_sqft", 30), "garage_rolling_30d": ("garage_spaces", 30)},
    )
    return rows.select(
        *ID,
        near("price_per_sqft_rolling_30d").alias("price_per_sqft_rolling_30d"),
        near("garage_rolling_30d", 6).alias("garage_rolling_30d"),
    )


@query(
    "w5_momentum",
    with_sales(
        f"""SELECT zipcode, day, {rnd("recent / before - 1", 6)} AS momentum FROM (
              SELECT zipcode, day,
                sum(s) OVER (w RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) /
                  sum(n) OVER (w RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS recent,
                sum(s) OVER (w RANGE BETWEEN INTERVAL 13 DAY PRECEDING AND INTERVAL 7 DAY PRECEDING) /
                  sum(n) OVER (w RANGE BETWEEN INTERVAL 13 DAY PRECEDING AND INTERVAL 7 DAY PRECEDING) AS before
              FROM (SELECT zipcode, CAST(sale_date AS DATE) AS day, sum(price) AS s, count(price) AS n
                    FROM sales GROUP BY zipcode, day)
              WINDOW w AS (PARTITION BY zipcode ORDER BY day))"""
    ),
)
def w5(spark, folder):
    rows = win.momentum(sales(spark, folder), ["zipcode"], "sale_date", "price")
    return rows.withColumn("momentum", near("momentum", 6))


@query(
    "w5_seasonal_and_yearly",
    with_sales(
        f"""SELECT m.zipcode, m.month, {rnd("m.v")} AS month_mean, {rnd("m.v / o.v", 6)} AS seasonal_index,
              {rnd("m.v / p.v - 1", 6)} AS year_over_year_growth
            FROM months m JOIN (SELECT zipcode, avg(price) AS v FROM sales GROUP BY zipcode) o USING (zipcode)
            LEFT JOIN months p ON p.zipcode = m.zipcode AND p.month = m.month - INTERVAL 1 YEAR""",
        """months AS (SELECT zipcode, CAST(date_trunc('month', sale_date) AS DATE) AS month, avg(price) AS v
                      FROM sales GROUP BY ALL)""",
    ),
)
def w5_months(spark, folder):
    rows = win.monthly_index(sales(spark, folder), ["zipcode"], "sale_date", "price")
    return rows.select(
        "zipcode",
        "month",
        near("month_mean").alias("month_mean"),
        near("seasonal_index", 6).alias("seasonal_index"),
        near("year_over_year_growth", 6).alias("year_over_year_growth"),
    )


@query(
    "w6_latest_per_entity",
    f"""WITH {HISTORY} SELECT * FROM history QUALIFY row_number() OVER (
          PARTITION BY entity_id ORDER BY event_timestamp DESC, created_timestamp DESC, order_id DESC) = 1""",
)
def w6(spark, folder):
    return win.latest_per_key(
        feature_history(spark, folder), ["entity_id"], ["event_timestamp", "created_timestamp", "order_id"]
    )


@query(
    "w7_chronological_position",
    with_sales(
        f"""SELECT {ID_SQL}, row_number() OVER (ORDER BY {ORDER_SQL}) - 1 AS position,
              {rnd(f"(row_number() OVER (ORDER BY {ORDER_SQL}) - 1) / CAST(count(*) OVER () AS DOUBLE)", 8)} AS fraction
            FROM sales"""
    ),
)
def w7(spark, folder):
    rows = chronological_position(sales(spark, folder).select(*ID), ORDER, "sale_date")
    return rows.withColumn("fraction", near("fraction", 8))


# ---------------------------------------------------------------- joins

SPINE_DATES = [datetime(1996, 1, 1), datetime(1998, 6, 1), datetime(2000, 1, 1), datetime(2001, 6, 15)]
SPINE = """spine AS (SELECT c_custkey AS entity_id, unnest([TIMESTAMP '1996-01-01', TIMESTAMP '1998-06-01',
  TIMESTAMP '2000-01-01', TIMESTAMP '2001-06-15']) AS event_timestamp FROM customer)"""


def _spine(spark, folder):
    return joins.entity_spine(customer_ids(spark, folder), SPINE_DATES)


def _history_view(spark, folder, ttl=180):
    return joins.FeatureView(
        "orders", feature_history(spark, folder), "entity_id", ("order_id", "amount"), timedelta(days=ttl)
    )


@query(
    "j1_group_stats_join",
    with_sales(
        f"""SELECT {ID_SQL}, {rnd("price_mean")} AS price_mean, {rnd("square_feet_mean")} AS square_feet_mean
            FROM sales LEFT JOIN ({STATS_SQL}) USING (zipcode)"""
    ),
)
def j1(spark, folder):
    rows = _priced(spark, folder)
    means = rows.groupBy("zipcode").agg(
        F.avg("price").alias("price_mean"), F.avg("square_feet").alias("square_feet_mean")
    )
    joined = joins.join_stats(rows, means, ["zipcode"])
    return joined.select(*ID, near("price_mean").alias("price_mean"), near("square_feet_mean").alias("square_feet_mean"))


def _asof_sql(columns: str, ttl: int) -> str:
    return f"""SELECT s.entity_id, s.event_timestamp, {columns}
        FROM spine s LEFT JOIN (
          SELECT s.entity_id, s.event_timestamp, h.order_id, h.amount
          FROM spine s JOIN history h ON h.entity_id = s.entity_id AND h.event_timestamp <= s.event_timestamp
            AND h.event_timestamp >= s.event_timestamp - INTERVAL {ttl} DAY
          QUALIFY row_number() OVER (PARTITION BY s.entity_id, s.event_timestamp
            ORDER BY h.event_timestamp DESC, h.created_timestamp DESC, h.order_id DESC) = 1) f
        ON f.entity_id = s.entity_id AND f.event_timestamp = s.event_timestamp"""


@query("j2_point_in_time", f"WITH {HISTORY}, {SPINE} " + _asof_sql("f.order_id, f.amount", 180))
def j2(spark, folder):
    return joins.point_in_time(_spine(spark, folder), _history_view(spark, folder))


@query(
    "j3_multi_view_features",
    f"""WITH {HISTORY}, {SPINE}, recent AS ({_asof_sql("f.amount AS orders__amount", 90)}),
        nation AS (SELECT s_nationkey AS nation_id, TIMESTAMP '1995-01-01' + to_days(CAST(s_suppkey % 900 AS INTEGER)) AS at,
                          s_suppkey, s_acctbal FROM supplier)
        SELECT r.entity_id, r.nation_id, r.event_timestamp, r.orders__amount, f.s_acctbal AS suppliers__s_acctbal
        FROM (SELECT recent.*, CAST(recent.entity_id % 25 AS INTEGER) AS nation_id FROM recent) r LEFT JOIN (
          SELECT k.nation_id, k.event_timestamp, n.s_acctbal
          FROM (SELECT DISTINCT CAST(entity_id % 25 AS INTEGER) AS nation_id, event_timestamp FROM spine) k
          JOIN nation n ON n.nation_id = k.nation_id AND n.at <= k.event_timestamp
          QUALIFY row_number() OVER (PARTITION BY k.nation_id, k.event_timestamp ORDER BY n.at DESC, n.s_acctbal DESC) = 1) f
        ON f.nation_id = r.nation_id AND f.event_timestamp = r.event_timestamp""",
)
def j3(spark, folder):
    days = (F.col("s_suppkey") % 900).cast("int")
    at = F.lit(datetime(1995, 1, 1)).cast("timestamp_ntz") + F.make_interval(days=days)
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_nationkey").alias("nation_id"),
        at.alias("event_timestamp"),
        at.alias("created_timestamp"),
        "s_acctbal",
    )
    views = [
        _history_view(spark, folder, 90),
        joins.FeatureView("suppliers", suppliers, "nation_id", ("s_acctbal",)),
    ]
    spine = _spine(spark, folder).withColumn("nation_id", (F.col("entity_id") % 25).cast("int"))
    return joins.historical_features(spine, views, ["orders:amount", "suppliers:s_acctbal"])


@query("j4_entity_spine", f"WITH {SPINE} SELECT * FROM spine")
def j4(spark, folder):
    return _spine(spark, folder)


def _two_tables(spark, folder):
    log = prediction_log(spark, folder)
    actuals = log.filter(F.col("actual").isNotNull()).select("request_id", "actual")
    return log.drop("actual"), actuals


@query(
    "j5_delayed_actuals",
    f"""WITH {PREDICTIONS} SELECT model_version, count(actual) AS matched, count(*) - count(actual) AS waiting,
          {rnd("avg(abs(prediction - actual))")} AS mae FROM predictions GROUP BY model_version""",
)
def j5(spark, folder):
    scored = joins.delayed_metrics(*_two_tables(spark, folder), "request_id", ["model_version"])
    return scored.select("model_version", F.col("n").alias("matched"), "waiting", near("mae").alias("mae"))


REUSE = """asked AS (SELECT event_id, ts, md5(concat_ws('|', 'endpoint=v' || length(event_type) || ':' || event_type,
               'user_id=v' || length(CAST(user_id AS VARCHAR)) || ':' || CAST(user_id AS VARCHAR))) AS fingerprint
             FROM events),
  results AS (SELECT fingerprint, ts + INTERVAL 20 MINUTE AS result_ts, CAST(event_id AS DOUBLE) AS price FROM asked)"""


@query(
    "j6_reuse_or_score",
    f"""WITH {REUSE}, hits AS (
          SELECT a.event_id, r.price FROM asked a JOIN results r ON r.fingerprint = a.fingerprint
            AND r.result_ts <= a.ts AND r.result_ts >= a.ts - INTERVAL 1 HOUR
          QUALIFY row_number() OVER (PARTITION BY a.event_id ORDER BY r.result_ts DESC, r.price DESC) = 1)
        SELECT a.event_id, a.ts, a.fingerprint, coalesce(h.price, CAST(-1 AS DOUBLE)) AS price,
               h.price IS NOT NULL AS reused
        FROM asked a LEFT JOIN hits h USING (event_id)""",
)
def j6(spark, folder):
    named = request_log(spark, folder).withColumnRenamed("client", "user_id")
    asked = named.select("event_id", "ts", row_fingerprint(["endpoint", "user_id"]).alias("fingerprint"))
    # Every request had a result twenty minutes after it was asked.
    ready = (F.col("ts") + F.make_interval(mins=F.lit(20))).alias("result_ts")
    results = asked.select("fingerprint", ready, F.col("event_id").cast("double").alias("price"))
    return joins.reuse_or_score(
        asked, results, "fingerprint", lambda missed: missed.withColumn("price", F.lit(-1.0)), ["price"]
    )


@query(
    "j7_version_comparison",
    """SELECT c_custkey AS version, c_mktsegment AS stage, mae, CAST(c_custkey AS VARCHAR) AS run_id FROM customer
       JOIN (SELECT o_custkey, max(o_totalprice) AS mae FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""",
)
def j7(spark, folder):
    versions = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("version"),
        F.col("c_mktsegment").alias("stage"),
        F.col("c_custkey").cast("string").alias("run_id"),
    )
    runs = table(spark, folder, "orders").groupBy(F.col("o_custkey").cast("string").alias("run_id"))
    metrics = runs.agg(F.max("o_totalprice").alias("value")).withColumn("key", F.lit("mae"))
    return joins.compare_versions(versions, metrics, "mae")


@query(
    "j8_shared_columns",
    with_sales(
        """SELECT is_reference, count(*) AS n, sum(square_feet) AS square_feet FROM (
             SELECT sale_date < TIMESTAMP '1998-06-01' AS is_reference, square_feet FROM sales) GROUP BY is_reference"""
    ),
)
def j8(spark, folder):
    rows = sales(spark, folder)
    old = F.col("sale_date") < F.lit("1998-06-01").cast("timestamp_ntz")
    both = joins.tag_and_union(rows.filter(~old).drop("price"), rows.filter(old), ["price", "square_feet", "pool"])
    return both.groupBy("is_reference").agg(F.count(F.lit(1)).alias("n"), F.sum("square_feet").alias("square_feet"))


# ---------------------------------------------------------------- top-k, order, concatenation


@query(
    "t1_top_features",
    f"""SELECT p_brand || ' ' || p_type AS feature, {rnd("avg(p_retailprice)")} AS importance FROM part
        GROUP BY feature ORDER BY importance DESC, feature LIMIT 20""",
)
def t1(spark, folder):
    name = F.concat_ws(" ", "p_brand", "p_type").alias("feature")
    scores = table(spark, folder, "part").groupBy(name).agg(near(F.avg("p_retailprice")).alias("importance"))
    return top_features(scores)


@query(
    "t2_top_factors",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(rank AS INTEGER) AS rank, feature, value,
         CASE WHEN value > 0 THEN 'positive' ELSE 'negative' END AS contribution
       FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY abs(value) DESC, feature) AS rank FROM (
         SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                unnest(['discount', 'quantity', 'tax']) AS feature,
                unnest([-l_discount, (l_quantity - 25) / CAST(50 AS DOUBLE), l_tax]) AS value FROM lineitem)
       WHERE abs(value) > 0.01) WHERE rank <= 2""",
)
def t2(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        (-F.col("l_discount")).alias("discount"),
        ((F.col("l_quantity") - 25) / 50).alias("quantity"),
        F.col("l_tax").alias("tax"),
    )
    return top_factors(rows, ["discount", "quantity", "tax"], k=2)


@query(
    "t3_order_and_limit",
    "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 1000",
)
def t3(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return rows.orderBy(F.desc("o_orderdate"), "o_orderkey").limit(1000)


@query(
    "t4_concat_frames",
    """SELECT c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_nationkey, s_acctbal, NULL FROM supplier""",
)
def t4(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation")
    )
    return concat([customers, suppliers])
