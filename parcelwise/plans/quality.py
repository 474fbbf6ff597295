"""Validation, drift, alerts and triggers."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.operators import alerts
from parcelwise.operators import drift as dr
from parcelwise.operators import validation as val
from parcelwise.operators.aggregates import bucketed_histogram
from parcelwise.plans.catalog import (
    COLUMNS,
    DIRTY,
    ID,
    ID_SQL,
    PREDICTIONS,
    REQUESTS,
    near,
    query,
    rnd,
    with_sales,
)
from parcelwise.schemas import LATENCY_BOUNDS, REQUEST_RANGES, REQUEST_REQUIRED, SALE_RULES
from parcelwise.sources.sample_tables import prediction_log, request_log, sales, sales_dirty, table

CUT = "1998-06-01"
RANGED = [r for r in SALE_RULES if r.low is not None]


def _before_after(rows):
    """(rows from the cut on, rows before it)."""
    old = F.col("sale_date") < F.lit(CUT).cast("timestamp_ntz")
    return rows.filter(~old), rows.filter(old)


def _check_sql(expectation: str, column: str, unexpected: str, total: str = "count(*)") -> str:
    return (
        f"SELECT '{expectation}' AS expectation, '{column}' AS \"column\", ({unexpected}) = 0 AS success, "
        f"CAST({unexpected} AS BIGINT) AS unexpected_count, "
        f"{rnd(f'coalesce(({unexpected}) * 100.0 / nullif({total}, 0), 0)', 6)} AS unexpected_percent FROM dirty"
    )


def _range_sql(r) -> str:
    return _check_sql("range", r.column, f"count(*) FILTER (WHERE {r.column} < {r.low} OR {r.column} > {r.high})")


UNIQUE_SQL = _check_sql("unique", "property_id", "count(property_id) - count(DISTINCT property_id)")


def _shown(results):
    return results.withColumn("unexpected_percent", near("unexpected_percent", 6))


@query("v3_range_checks", with_sales(" UNION ALL ".join(_range_sql(r) for r in RANGED), DIRTY))
def v3(spark, folder):
    return _shown(val.range_checks(sales_dirty(spark, folder)))


@query(
    "v4_pattern_checks",
    with_sales(
        _check_sql("pattern", "zipcode", "count(*) FILTER (WHERE NOT regexp_matches(zipcode, '^[0-9]{5}$'))"), DIRTY
    ),
)
def v4(spark, folder):
    return _shown(val.pattern_checks(sales_dirty(spark, folder)))


@query("v5_unique_checks", with_sales(UNIQUE_SQL, DIRTY))
def v5(spark, folder):
    return _shown(val.unique_checks(sales_dirty(spark, folder), ["property_id"]))


NOT_NULL = ["square_feet", "bedrooms", "year_built", "price"]


@query(
    "v6_not_null_checks",
    with_sales(" UNION ALL ".join(_check_sql("not_null", c, f"count(*) - count({c})") for c in NOT_NULL), DIRTY),
)
def v6(spark, folder):
    return _shown(val.not_null_checks(sales_dirty(spark, folder), NOT_NULL))


SUITE = [r for r in SALE_RULES if r.required and r.pattern is None]
SUITE_SQL = " UNION ALL ".join(
    [_check_sql("exists", r.column, "0", "1").replace(" FROM dirty", "") for r in SUITE]
    + [_range_sql(r) for r in SUITE if r.low is not None]
    + [_check_sql("not_null", r.column, f"count(*) - count({r.column})") for r in SUITE]
    + [UNIQUE_SQL]
)


@query("v7_expectation_suite", with_sales(SUITE_SQL, DIRTY))
def v7(spark, folder):
    return _shown(val.expectation_suite(sales_dirty(spark, folder)))


@query(
    "v7_suite_summary",
    with_sales(
        f"""SELECT bool_and(success) AS success, {rnd("avg(CAST(success AS INTEGER)) * 100")} AS success_percent,
              count(*) AS evaluated_expectations, count(*) FILTER (WHERE NOT success) AS failed_expectations
            FROM ({SUITE_SQL})""",
        DIRTY,
    ),
)
def v7_summary(spark, folder):
    summary = val.suite_summary(val.expectation_suite(sales_dirty(spark, folder)))
    return summary.withColumn("success_percent", near("success_percent"))


@query(
    "v8_missing_shares",
    with_sales(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {rnd(f'1 - count({c}) / CAST(count(*) AS DOUBLE)', 8)} AS missing_share FROM dirty"
            for c in COLUMNS
        )
        + ") WHERE missing_share > 0.05",
        DIRTY,
    ),
)
def v8(spark, folder):
    shares = val.missing_shares(sales_dirty(spark, folder), 0.05)
    return shares.withColumn("missing_share", near("missing_share", 8))


OUTLIER_COLUMNS = ["price", "square_feet"]


def _outlier_sql(fences: str) -> str:
    return with_sales(
        " UNION ALL ".join(
            f"SELECT {ID_SQL}, '{c}' AS \"column\", {c} AS value, {rnd('low')} AS low, {rnd('high')} AS high "
            f"FROM dirty, ({fences.format(c=c)}) WHERE {c} < low OR {c} > high"
            for c in OUTLIER_COLUMNS
        ),
        DIRTY,
    )


def _fenced(rows):
    return rows.withColumns({"low": near("low"), "high": near("high")})


@query(
    "v9_outliers_iqr",
    _outlier_sql(
        "SELECT q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM (SELECT quantile_cont({c}, 0.25) AS q1,"
        " quantile_cont({c}, 0.75) AS q3 FROM dirty)"
    ),
)
def v9(spark, folder):
    return _fenced(val.outliers_iqr(sales_dirty(spark, folder), ID, OUTLIER_COLUMNS))


@query(
    "v10_outliers_zscore",
    _outlier_sql("SELECT avg({c}) - 3 * stddev_pop({c}) AS low, avg({c}) + 3 * stddev_pop({c}) AS high FROM dirty"),
)
def v10(spark, folder):
    return _fenced(val.outliers_zscore(sales_dirty(spark, folder), ID, OUTLIER_COLUMNS))


REASON_SQL = "[x for x in [{}] if x IS NOT NULL]".format(
    ", ".join(
        [f"CASE WHEN {c} IS NULL THEN 'Missing required field: {c}' END" for c in REQUEST_REQUIRED]
        + [
            f"CASE WHEN {c} < {low} OR {c} > {high} THEN '{c} must be between {low} and {high}' END"
            for c, (low, high) in REQUEST_RANGES.items()
        ]
    )
)


@query(
    "v11_request_quarantine",
    with_sales(
        f"""SELECT {ID_SQL}, array_to_string({REASON_SQL}, '; ') AS reasons FROM requests WHERE len({REASON_SQL}) > 0""",
        DIRTY,
        "requests AS (SELECT * REPLACE (condition_score + 2 AS condition_score) FROM dirty)",
    ),
)
def v11(spark, folder):
    rows = sales_dirty(spark, folder).withColumn("condition_score", F.col("condition_score") + 2)
    _, bad = val.validate_requests(rows)
    return bad.select(*ID, F.concat_ws("; ", "reasons").alias("reasons"))


@query(
    "v11_valid_requests",
    with_sales(f"SELECT {ID_SQL} FROM dirty WHERE len({REASON_SQL}) = 0", DIRTY),
)
def v11_valid(spark, folder):
    return val.validate_requests(sales_dirty(spark, folder))[0].select(*ID)


SERVICE_SQL = """list_filter([
  CASE WHEN square_feet IS NULL THEN 'square_feet is required' END,
  CASE WHEN bedrooms IS NULL THEN 'bedrooms is required' END,
  CASE WHEN bathrooms IS NULL THEN 'bathrooms is required' END,
  CASE WHEN year_built IS NULL THEN 'year_built is required' END,
  CASE WHEN zipcode IS NULL THEN 'zipcode is required' END,
  CASE WHEN square_feet > 50000 THEN 'square_feet is out of range' END,
  CASE WHEN bedrooms NOT BETWEEN 0 AND 20 THEN 'bedrooms is out of range' END,
  CASE WHEN bathrooms NOT BETWEEN 0 AND 15 THEN 'bathrooms is out of range' END,
  CASE WHEN year_built NOT BETWEEN 1800 AND 2024 THEN 'year_built is out of range' END,
  CASE WHEN latitude NOT BETWEEN -90 AND 90 THEN 'latitude is out of range' END,
  CASE WHEN longitude NOT BETWEEN -180 AND 180 THEN 'longitude is out of range' END,
  CASE WHEN garage_spaces NOT BETWEEN 0 AND 10 THEN 'garage_spaces is out of range' END,
  CASE WHEN condition_score NOT BETWEEN 1 AND 10 THEN 'condition_score is out of range' END,
  CASE WHEN square_feet <= 0 THEN 'square_feet is not above 0' END,
  CASE WHEN lot_size <= 0 THEN 'lot_size is not above 0' END,
  CASE WHEN NOT regexp_matches(zipcode, '^[0-9]{5}$') THEN 'zipcode is no zipcode' END], lambda x: x IS NOT NULL)"""


@query(
    "v11_service_rules",
    with_sales(
        f"SELECT {ID_SQL}, array_to_string({SERVICE_SQL}, '; ') AS reasons FROM requests",
        DIRTY,
        "requests AS (SELECT * REPLACE (condition_score + 2 AS condition_score, latitude * 2 AS latitude) FROM dirty)",
    ),
)
def v11_service(spark, folder):
    rows = sales_dirty(spark, folder).withColumns(
        {"condition_score": F.col("condition_score") + 2, "latitude": F.col("latitude") * 2}
    )
    return rows.select(*ID, F.concat_ws("; ", val.service_reasons()).alias("reasons"))


KS_COLUMNS = ["price", "square_feet", "condition_score"]


def _ks_statistic_sql(rows: str) -> str:
    return f"""SELECT "column", max(abs(a / CAST(ta AS DOUBLE) - b / CAST(tb AS DOUBLE))) AS d,
          CAST(max(ta) AS BIGINT) AS n_current, CAST(max(tb) AS BIGINT) AS n_reference
        FROM (SELECT "column", sum(na) OVER (PARTITION BY "column" ORDER BY value) AS a,
                     sum(nb) OVER (PARTITION BY "column" ORDER BY value) AS b,
                     sum(na) OVER (PARTITION BY "column") AS ta, sum(nb) OVER (PARTITION BY "column") AS tb
              FROM (SELECT "column", value, count(*) FILTER (WHERE NOT old) AS na, count(*) FILTER (WHERE old) AS nb
                    FROM {rows} WHERE value IS NOT NULL GROUP BY "column", value))
        GROUP BY "column" """


def _long_sql(cols) -> str:
    return " UNION ALL ".join(
        f"SELECT sale_date < TIMESTAMP '{CUT}' AS old, '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM dirty"
        for c in cols
    )


@query(
    "v12_kolmogorov_smirnov",
    with_sales(
        f"""SELECT "column", {rnd("d", 8)} AS ks_statistic, n_current, n_reference,
              CASE WHEN x < 0.2 THEN CAST(1 AS DOUBLE) ELSE {rnd("least(greatest(2 * s, 0), 1)", 6)} END AS p_value
            FROM (SELECT *, (SELECT sum((CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * x * x))
                             FROM (SELECT unnest(range(1, 101)) AS k)) AS s
                  FROM (SELECT *, sqrt(CAST(n_current AS DOUBLE) * n_reference / (n_current + n_reference)) * d AS x
                        FROM ({_ks_statistic_sql("long")})))""",
        DIRTY,
        f"long AS ({_long_sql(KS_COLUMNS)})",
    ),
)
def v12(spark, folder):
    result = val.ks_two_sample(*_before_after(sales_dirty(spark, folder)), KS_COLUMNS)
    p = F.when(F.col("p_value") == 1.0, 1.0).otherwise(near("p_value", 6))
    return result.withColumns({"ks_statistic": near("ks_statistic", 8), "p_value": p})


REPORTED = ["property_id", "sale_date", "square_feet", "bedrooms", "year_built", "price", "zipcode"]
REPORT_NUMERIC = ["square_feet", "bedrooms", "year_built", "price"]


def _report_sql() -> str:
    rules = [r for r in SALE_RULES if r.column in REPORTED]
    unknown = "CAST(NULL AS BOOLEAN)"
    shape = [("required_column", r.column, r.column in REPORTED) for r in SALE_RULES if r.required]
    shape += [("column_type", r.column, True) for r in rules]
    parts = [
        f"SELECT '{c}' AS \"check\", '{n}' AS \"column\", CAST({0 if ok else 1} AS DOUBLE) AS value, {ok} AS passed"
        for c, n, ok in shape
    ]
    checks = [_range_sql(r) for r in rules if r.low is not None] + [UNIQUE_SQL]
    parts += [
        f'SELECT expectation, "column", CAST(unexpected_count AS DOUBLE), success FROM ({c.replace("FROM dirty", "FROM cur")})'
        for c in checks
    ]
    parts += [
        f"SELECT 'missing_share', '{c}', {rnd(f'1 - count({c}) / CAST(count(*) AS DOUBLE)', 8)}, {unknown} FROM cur"
        for c in REPORTED
    ]
    parts += [
        f"SELECT 'outliers', '{c}', CAST(count(*) AS DOUBLE), {unknown} FROM cur, (SELECT quantile_cont({c}, 0.25) AS q1, "
        f"quantile_cont({c}, 0.75) AS q3 FROM cur) WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1) "
        "HAVING count(*) > 0"
        for c in REPORT_NUMERIC
    ]
    parts.append(f"SELECT 'drift', \"column\", {rnd('d', 8)}, {unknown} FROM ({_ks_statistic_sql('long')})")
    return with_sales(
        " UNION ALL ".join(parts),
        DIRTY,
        f"cur AS (SELECT * FROM dirty WHERE sale_date >= TIMESTAMP '{CUT}')",
        f"long AS ({_long_sql(REPORT_NUMERIC)})",
    )


def _reported(spark, folder):
    rows = sales_dirty(spark, folder).withColumn("property_id", F.col("property_id").cast("string"))
    return rows.select(*REPORTED)


@query("v13_validation_report", _report_sql())
def v13(spark, folder):
    current, reference = _before_after(_reported(spark, folder))
    report = val.validation_report(current, ["property_id"], reference)
    shares = F.col("check").isin("missing_share", "drift")
    return report.withColumn("value", F.when(shares, near("value", 8)).otherwise(F.col("value")))


@query(
    "v13_overall_valid",
    with_sales(
        """SELECT count(*) FILTER (WHERE price < 10000 OR price > 10000000) = 0
                  AND count(property_id) = count(DISTINCT property_id) AS overall_valid FROM known""",
        DIRTY,
        """known AS (SELECT max(price) AS price, property_id FROM dirty WHERE price BETWEEN 10000 AND 10000000
                     GROUP BY property_id)""",
    ),
)
def v13_overall(spark, folder):
    rows = _reported(spark, folder).filter(F.col("price").between(10000, 10000000))
    best = rows.groupBy("property_id").agg(*[F.max(c).alias(c) for c in REPORTED if c != "property_id"])
    ready = best.withColumn("bathrooms", F.lit(1.0))
    return val.overall_valid(val.validation_report(ready, ["property_id"]))


@query(
    "v14_chi_square_drift",
    f"""WITH cells AS (
          SELECT o_orderpriority AS value, count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '{CUT}') AS a,
                 count(*) FILTER (WHERE o_orderdate < TIMESTAMP '{CUT}') AS b FROM orders GROUP BY value),
        t AS (SELECT sum(a) AS ta, sum(b) AS tb FROM cells),
        e AS (SELECT a, b, (a + b) * ta / CAST(ta + tb AS DOUBLE) AS ea, (a + b) * tb / CAST(ta + tb AS DOUBLE) AS eb FROM cells, t)
        SELECT 'o_orderpriority' AS "column",
               {rnd("sum((a - ea) * (a - ea) / ea + (b - eb) * (b - eb) / eb)", 6)} AS chi_square,
               count(*) - 1 AS degrees_of_freedom FROM e""",
)
def v14(spark, folder):
    rows = table(spark, folder, "orders")
    old = F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz")
    result = val.chi_square_drift(rows.filter(~old), rows.filter(old), ["o_orderpriority"])
    return result.withColumn("chi_square", near("chi_square", 6))


# ---------------------------------------------------------------- drift

DRIFTED = ["price", "square_feet"]


def _edges_sql(c: str) -> str:
    points = ", ".join(f"{i / 10}" for i in range(1, 10))
    return f"edges_{c} AS (SELECT list_sort(list_distinct(quantile_cont({c}, [{points}]))) AS e FROM sales WHERE old)"


def _place_sql(c: str) -> str:
    return f"list_sum([CASE WHEN {c} > x THEN 1 ELSE 0 END for x in e])"


DRIFT_BASE = (
    "tagged AS (SELECT *, sale_date < TIMESTAMP '%s' AS old FROM sales)" % CUT,
    *[_edges_sql(c).replace("FROM sales", "FROM tagged") for c in DRIFTED],
    *[
        f"bins_{c} AS (SELECT old, sale_date, CAST({_place_sql(c)} AS INTEGER) AS bin FROM tagged, edges_{c})"
        for c in DRIFTED
    ],
    *[f"all_{c} AS (SELECT unnest(range(len(e) + 1)) AS bin FROM edges_{c})" for c in DRIFTED],
    *[
        f"ref_{c} AS (SELECT b.bin, greatest(count(r.bin) / CAST((SELECT count(*) FROM bins_{c} WHERE old) AS DOUBLE), 1e-4) AS r"
        f" FROM all_{c} b LEFT JOIN (SELECT bin FROM bins_{c} WHERE old) r ON r.bin = b.bin GROUP BY b.bin)"
        for c in DRIFTED
    ],
)


@query(
    "d1_stability_index",
    with_sales(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS feature_name, CAST(max(t) AS BIGINT) AS n, {rnd("sum((s - r) * ln(s / r))", 8)} AS drift_score,
                  sum((s - r) * ln(s / r)) > 0.2 AS drifted
                FROM (SELECT f.bin, f.r, (SELECT count(*) FROM bins_{c} WHERE NOT old) AS t,
                        greatest(count(b.bin) / CAST((SELECT count(*) FROM bins_{c} WHERE NOT old) AS DOUBLE), 1e-4) AS s
                      FROM ref_{c} f LEFT JOIN (SELECT bin FROM bins_{c} WHERE NOT old) b ON b.bin = f.bin
                      GROUP BY f.bin, f.r)"""
            for c in DRIFTED
        ),
        *DRIFT_BASE,
    ),
)
def d1(spark, folder):
    current, reference = _before_after(sales(spark, folder))
    scores = dr.drift_scores(current, dr.fit_drift_bins(reference, DRIFTED))
    return scores.withColumn("drift_score", near("drift_score", 8))


@query(
    "d2_drift_per_day",
    with_sales(
        " UNION ALL ".join(
            f"""SELECT day, '{c}' AS feature_name, CAST(max(t) AS BIGINT) AS n,
                  {rnd("sum((s - r) * ln(s / r))", 6)} AS drift_score, sum((s - r) * ln(s / r)) > 0.2 AS drifted
                FROM (SELECT d.day, d.t, f.bin, f.r, greatest(coalesce(k.n, 0) / CAST(d.t AS DOUBLE), 1e-4) AS s
                      FROM (SELECT CAST(sale_date AS DATE) AS day, count(*) AS t FROM bins_{c} WHERE NOT old GROUP BY day) d
                      CROSS JOIN ref_{c} f
                      LEFT JOIN (SELECT CAST(sale_date AS DATE) AS day, bin, count(*) AS n FROM bins_{c} WHERE NOT old GROUP BY ALL) k
                        ON k.day = d.day AND k.bin = f.bin)
                GROUP BY day"""
            for c in DRIFTED
        ),
        *DRIFT_BASE,
    ),
)
def d2(spark, folder):
    current, reference = _before_after(sales(spark, folder))
    fit = dr.fit_drift_bins(reference, DRIFTED)
    scores = dr.drift_scores(current, fit, [F.to_date("sale_date").alias("day")])
    return scores.withColumn("drift_score", near("drift_score", 6))


# ---------------------------------------------------------------- triggers and alerts


@query(
    "d3_performance_trigger",
    f"""WITH {PREDICTIONS} SELECT time_bucket(INTERVAL 30 DAY, ts, TIMESTAMP '1970-01-01') AS window_start,
          count(*) AS n, {rnd("avg(abs(prediction - actual))")} AS mae, avg(abs(prediction - actual)) > 12000 AS triggered
        FROM predictions WHERE actual IS NOT NULL GROUP BY window_start""",
)
def d3(spark, folder):
    rows = alerts.performance_trigger(prediction_log(spark, folder), "ts", "30 days", 12000)
    return rows.withColumn("mae", near("mae"))


@query(
    "d4_new_data_trigger",
    f"""SELECT max(o_orderdate) AS newest, count(*) AS new_rows, count(*) > 0 AS triggered FROM orders
        WHERE o_orderdate > TIMESTAMP '{CUT}'""",
)
def d4(spark, folder):
    return alerts.new_data_trigger(table(spark, folder, "orders"), "o_orderdate", datetime(1998, 6, 1))


@query(
    "d5_event_trigger",
    """SELECT date_trunc('hour', ts) AS window_start, count(*) AS n, true AS triggered FROM events
       WHERE event_type = 'purchase' GROUP BY window_start""",
)
def d5(spark, folder):
    return alerts.event_trigger(table(spark, folder, "events"), "purchase")


@query(
    "d6_composite_trigger",
    """SELECT user_id, bool_and(value > 5) AS all_hold, bool_or(value > 40) AS any_holds, false AS other_operator
       FROM events GROUP BY user_id""",
)
def d6(spark, folder):
    rows = table(spark, folder, "events")
    low = rows.withColumn("triggered", F.col("value") > 5)
    high = rows.withColumn("triggered", F.col("value") > 40)
    named = [
        alerts.composite_trigger(low, ["user_id"], "AND").withColumnRenamed("should_run", "all_hold"),
        alerts.composite_trigger(high, ["user_id"], "OR").withColumnRenamed("should_run", "any_holds"),
        alerts.composite_trigger(low, ["user_id"], "XOR").withColumnRenamed("should_run", "other_operator"),
    ]
    return named[0].join(named[1], "user_id").join(named[2], "user_id")


# Five one-minute-spaced window starts per event.
SLID = f"""{REQUESTS}, slid AS (
  SELECT *, date_trunc('minute', ts) - to_minutes(CAST(k AS INTEGER)) AS window_start
  FROM log, (SELECT unnest(range(5)) AS k))"""


@query(
    "d7_request_rate",
    f"""WITH {SLID} SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS n,
          {rnd("count(*) / CAST(300 AS DOUBLE)", 8)} AS rate FROM slid GROUP BY window_start""",
)
def d7(spark, folder):
    return alerts.request_rate(request_log(spark, folder)).withColumn("rate", near("rate", 8))


BOUND_LIST = ", ".join(f"CAST({b} AS DOUBLE)" for b in LATENCY_BOUNDS)


def _bucket_quantile_sql(source: str, keys: str, q: float) -> str:
    """Quantile per group of `source` (keys, v = seconds) from its cumulative buckets."""
    return f"""SELECT {keys}, {rnd("min_by(q, le)", 8)} AS quantile, CAST(max(n) AS BIGINT) AS n FROM (
      SELECT *, CASE WHEN le = CAST('inf' AS DOUBLE) THEN low ELSE low + (le - low) * ({q} * n - below) / (cumulative - below) END AS q
      FROM (SELECT *, lag(cumulative, 1, 0) OVER (PARTITION BY {keys} ORDER BY le) AS below,
                   lag(le, 1, CAST(0 AS DOUBLE)) OVER (PARTITION BY {keys} ORDER BY le) AS low
            FROM (SELECT {keys}, le, count(*) AS n, count(*) FILTER (WHERE le = CAST('inf' AS DOUBLE) OR v <= le) AS cumulative
                  FROM {source}, (SELECT unnest([{BOUND_LIST}, CAST('inf' AS DOUBLE)]) AS le) GROUP BY {keys}, le)))
    WHERE cumulative >= {q} * n GROUP BY {keys}"""


@query(
    "d8_bucket_quantile",
    f"WITH {REQUESTS}, timed AS (SELECT endpoint, latency_ms / 1000 AS v FROM log) "
    + _bucket_quantile_sql("timed", "endpoint", 0.95),
)
def d8(spark, folder):
    timed = request_log(spark, folder).withColumn("seconds", F.col("latency_ms") / 1000)
    buckets = bucketed_histogram(timed, ["endpoint"], "seconds", LATENCY_BOUNDS)
    return alerts.bucket_quantile(buckets, ["endpoint"], 0.95).withColumn("quantile", near("quantile", 8))


@query(
    "d8_bucket_quantile_per_window",
    f"WITH {SLID}, timed AS (SELECT window_start, latency_ms / 1000 AS v FROM slid) "
    + _bucket_quantile_sql("timed", "window_start", 0.95),
)
def d8_windows(spark, folder):
    buckets = alerts.windowed_buckets(request_log(spark, folder), "ts", F.col("latency_ms") / 1000)
    return alerts.bucket_quantile(buckets, ["window_start"], 0.95).withColumn("quantile", near("quantile", 8))


ERROR_SQL = f"""{SLID}, ratios AS (
  SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS n,
         count(*) FILTER (WHERE status BETWEEN 500 AND 599) AS errors FROM slid GROUP BY window_start)"""


@query(
    "d9_error_ratio",
    f"""WITH {ERROR_SQL} SELECT *, {rnd("errors / CAST(n AS DOUBLE)", 8)} AS error_ratio,
          errors / CAST(n AS DOUBLE) > 0.05 AS breached FROM ratios""",
)
def d9(spark, folder):
    return alerts.error_ratio(request_log(spark, folder)).withColumn("error_ratio", near("error_ratio", 8))


@query(
    "d10_firing_alerts",
    f"""WITH {ERROR_SQL}, hot AS (
          SELECT window_end, epoch_us(window_end) // 60000000 AS tick FROM ratios WHERE errors / CAST(n AS DOUBLE) > 0.05),
        islands AS (SELECT *, tick - row_number() OVER (ORDER BY tick) AS island FROM hot)
        SELECT 'HighErrorRate' AS rule, min(window_end) AS since, max(window_end) AS until,
               CAST((max(tick) - min(tick)) * 60 AS BIGINT) AS seconds
        FROM islands GROUP BY island HAVING (max(tick) - min(tick)) * 60 >= 120""",
)
def d10(spark, folder):
    ratios = alerts.error_ratio(request_log(spark, folder)).withColumn("rule", F.lit("HighErrorRate"))
    return alerts.firing(ratios, "rule", "window_end", F.col("breached"), step=60, lasting=120)


DAILY = 86_400
# Thresholds at which the given tables have alerts; durations are those of the rules.
BOARD_RULES = tuple(
    replace(r, threshold=limit, step=step)
    for r in alerts.ALERT_RULES
    for name, limit, step in (
        ("HighLatency", 0.05, 60),
        ("HighErrorRate", 0.05, 60),
        ("ModelPerformanceDegradation", 12_000.0, DAILY),
        ("DataDrift", 0.2, DAILY),
    )
    if r.name == name
)
RULE_ROWS = ", ".join(
    f"('{r.name}', '{r.metric}', CAST({r.threshold} AS DOUBLE), {r.lasting}, CAST({r.step} AS BIGINT), '{r.severity}')" for r in BOARD_RULES
)


def _drift_series_sql(c: str) -> str:
    return f"""SELECT day, sum((s - r) * ln(s / r)) AS v
      FROM (SELECT d.day, f.bin, f.r, greatest(coalesce(k.n, 0) / CAST(d.t AS DOUBLE), 1e-4) AS s
            FROM (SELECT CAST(sale_date AS DATE) AS day, count(*) AS t FROM bins_{c} WHERE NOT old GROUP BY day) d
            CROSS JOIN ref_{c} f
            LEFT JOIN (SELECT CAST(sale_date AS DATE) AS day, bin, count(*) AS n FROM bins_{c} WHERE NOT old GROUP BY ALL) k
              ON k.day = d.day AND k.bin = f.bin) GROUP BY day"""


@query(
    "d10_alert_table",
    with_sales(
        """SELECT rule, min(ts) AS since, max(ts) AS until, CAST((max(tick) - min(tick)) * any_value(step) AS BIGINT) AS seconds,
             any_value(severity) AS severity
           FROM (SELECT *, tick - row_number() OVER (PARTITION BY rule ORDER BY tick) AS island FROM holding)
           GROUP BY rule, island HAVING (max(tick) - min(tick)) * any_value(step) >= any_value(lasting)""",
        *DRIFT_BASE,
        ERROR_SQL,
        PREDICTIONS,
        f"""latencies AS ({_bucket_quantile_sql("(SELECT window_start, latency_ms / 1000 AS v FROM slid)", "window_start", 0.95)})""",
        f"""series AS (
             SELECT 'latency_p95' AS metric, window_start + INTERVAL 5 MINUTE AS ts, quantile AS v FROM latencies
             UNION ALL SELECT 'error_rate', window_end, errors / CAST(n AS DOUBLE) FROM ratios
             UNION ALL SELECT 'mae', date_trunc('day', ts), avg(abs(prediction - actual)) FROM predictions
               WHERE actual IS NOT NULL GROUP BY ALL
             UNION ALL SELECT 'drift_score', CAST(day AS TIMESTAMP), max(v)
               FROM ({" UNION ALL ".join(map(_drift_series_sql, DRIFTED))}) GROUP BY day)""",
        f"rules AS (SELECT * FROM (VALUES {RULE_ROWS}) r(rule, metric, threshold, lasting, step, severity))",
        """holding AS (SELECT rule, ts, epoch_us(ts) // (step * 1000000) AS tick, lasting, step, severity
             FROM series JOIN rules USING (metric) WHERE v > threshold)""",
    ),
)
def d10_table(spark, folder):
    """All rules that have a series here: latency and errors per minute, model error and drift per day."""
    log = request_log(spark, folder)
    buckets = alerts.windowed_buckets(log, "ts", F.col("latency_ms") / 1000)
    latency = alerts.bucket_quantile(buckets, ["window_start"], 0.95)
    end = F.col("window_start") + F.expr("INTERVAL 5 MINUTES")
    daily = prediction_log(spark, folder).filter("actual is not null").groupBy(F.date_trunc("day", "ts").alias("ts"))
    current, reference = _before_after(sales(spark, folder))
    drift = dr.drift_scores(current, dr.fit_drift_bins(reference, DRIFTED), [F.to_date("sale_date").alias("day")])
    series = {
        "latency_p95": latency.select(end.alias("ts"), near("quantile", 8).alias("value")),
        "error_rate": alerts.error_ratio(log).select(F.col("window_end").alias("ts"), F.col("error_ratio").alias("value")),
        "mae": daily.agg(F.avg(F.abs(F.col("prediction") - F.col("actual"))).alias("value")),
        "drift_score": drift.groupBy(F.col("day").alias("ts")).agg(F.max("drift_score").alias("value")),
    }
    rows = [
        df.select(F.lit(m).alias("metric"), F.col("ts").cast("timestamp_ntz").alias("ts"), "value") for m, df in series.items()
    ]
    return alerts.alert_table(reduce(DataFrame.unionByName, rows), BOARD_RULES)


@query(
    "d11_threshold_board",
    f"""WITH {REQUESTS}, m AS (
          SELECT model_version, max(latency_ms) AS latency_ms, avg(CASE WHEN status >= 500 THEN 1.0 ELSE 0.0 END) AS error_rate
          FROM log GROUP BY model_version)
        SELECT model_version, 'latency_ms' AS metric, {rnd("latency_ms", 6)} AS value, 'above' AS direction,
               CAST(500 AS DOUBLE) AS threshold, latency_ms > 500 AS breached FROM m
        UNION ALL SELECT model_version, 'error_rate', {rnd("error_rate", 6)}, 'above', CAST(0.05 AS DOUBLE), error_rate > 0.05 FROM m""",
)
def d11(spark, folder):
    per_version = (
        request_log(spark, folder)
        .groupBy("model_version")
        .agg(
            F.max("latency_ms").alias("latency_ms"),
            F.avg(F.when(F.col("status") >= 500, 1.0).otherwise(0.0)).alias("error_rate"),
        )
    )
    long = per_version.unpivot(["model_version"], ["latency_ms", "error_rate"], "metric", "value")
    return alerts.threshold_board(long).withColumn("value", near("value", 6))


@query(
    "d12_requests_in_progress",
    f"""WITH {REQUESTS}, spans AS (
          SELECT endpoint, ts, ts + to_seconds(CAST(round(latency_ms * 100) AS BIGINT)) AS done FROM log),
        deltas AS (SELECT endpoint, instant, sum(d) AS d FROM (
          SELECT endpoint, ts AS instant, 1 AS d FROM spans UNION ALL SELECT endpoint, done, -1 FROM spans)
          GROUP BY endpoint, instant)
        SELECT endpoint, instant, CAST(sum(d) OVER (PARTITION BY endpoint ORDER BY instant) AS BIGINT) AS in_progress
        FROM deltas""",
)
def d12(spark, folder):
    seconds = F.round(F.col("latency_ms") * 100).cast("int")
    done = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    return alerts.in_progress(request_log(spark, folder).withColumn("done", done), ["endpoint"], "ts", "done")


@query(
    "d13_slow_requests",
    f"WITH {REQUESTS} SELECT event_id, ts, endpoint, latency_ms FROM log WHERE latency_ms > 30",
)
def d13(spark, folder):
    slow = alerts.slow_requests(request_log(spark, folder), limit_ms=30)
    return slow.select("event_id", "ts", "endpoint", "latency_ms")
