"""Cleaning, row-wise features, encoding and scaling."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from parcelwise.functions import features as feats
from parcelwise.functions.columns import (
    numeric_columns,
    params_hash,
    row_fingerprint,
    sanitize,
    select_group,
    select_numeric,
    select_ordered,
)
from parcelwise.models.store import load_features
from parcelwise.operators.aggregates import cell_summary
from parcelwise.operators.cleaning import (
    domain_filter,
    fill_constants,
    fit_median_imputer,
    impute_by_group,
    keep_first,
    trim_upper,
)
from parcelwise.operators.encoding import (
    FeatureFit,
    assemble,
    explained_variance,
    fit_pca,
    fit_robust_scale,
    fit_top_categories,
    frequency_index,
    grid_cells,
    one_hot_vector,
)
from parcelwise.plans.catalog import DIRTY, DOMAIN, FILLED, ID, ID_SQL, NUMBERS, near, query, rnd, with_sales
from parcelwise.scale import fresh_path, written
from parcelwise.schemas import BATCH_VECTOR, REQUEST_VECTOR, SERVICE_VECTOR
from parcelwise.sources.backfill import DAY, backfill, backfilled
from parcelwise.sources.sample_tables import SALE_ORDER, sales, sales_dirty, table

# ---------------------------------------------------------------- cleaning


@query(
    "c1_keep_first",
    with_sales(
        f"""SELECT {ID_SQL}, price, zipcode FROM sales QUALIFY row_number() OVER (
            PARTITION BY property_id ORDER BY sale_date, l_orderkey, l_linenumber) = 1"""
    ),
)
def c1(spark, folder):
    first = keep_first(sales(spark, folder), ["property_id"], list(SALE_ORDER))
    return first.select(*ID, "price", "zipcode")


COLUMNS = "square_feet, bedrooms, bathrooms, year_built, lot_size, condition_score, price"


@query("c2_fill_constants", with_sales(f"SELECT {ID_SQL}, {COLUMNS} FROM filled", DIRTY, FILLED))
def c2(spark, folder):
    return fill_constants(sales_dirty(spark, folder)).select(*ID, *COLUMNS.split(", "))


@query(
    "c3_domain_filter",
    with_sales(f"SELECT {ID_SQL}, {COLUMNS} FROM filled WHERE {DOMAIN}", DIRTY, FILLED),
)
def c3(spark, folder):
    return domain_filter(fill_constants(sales_dirty(spark, folder))).select(*ID, *COLUMNS.split(", "))


@query(
    "c4_impute_by_group_median",
    with_sales(
        f"""SELECT {ID_SQL}, zipcode,
              coalesce(square_feet, median(square_feet) OVER (PARTITION BY zipcode),
                       (SELECT median(square_feet) FROM dirty)) AS square_feet,
              CAST(trunc(coalesce(year_built, median(year_built) OVER (PARTITION BY zipcode),
                       (SELECT median(year_built) FROM dirty))) AS INTEGER) AS year_built,
              coalesce(bedrooms, 2) AS bedrooms, bathrooms
            FROM dirty""",
        DIRTY,
    ),
)
def c4(spark, folder):
    filled = impute_by_group(
        sales_dirty(spark, folder), ["zipcode"], ["square_feet", "year_built"], {"bedrooms": 2, "bathrooms": 1.5}
    )
    return filled.select(*ID, "zipcode", "square_feet", "year_built", "bedrooms", "bathrooms")


@query(
    "c5_impute_global_median",
    with_sales(
        f"SELECT {ID_SQL}, "
        + ", ".join(f"coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM dirty)) AS {c}" for c in NUMBERS)
        + " FROM dirty",
        DIRTY,
    ),
)
def c5(spark, folder):
    dirty = sales_dirty(spark, folder)
    cols = [c for c in numeric_columns(dirty) if c not in ID]
    return fit_median_imputer(dirty, cols).apply(dirty).select(*ID, *[F.col(c).cast("double").alias(c) for c in cols])


@query(
    "c6_trim_upper_quantiles",
    with_sales(
        f"""SELECT {ID_SQL}, square_feet, price FROM once
            WHERE price <= (SELECT quantile_cont(price, 0.99) FROM once)""",
        DIRTY,
        """once AS (SELECT * FROM dirty WHERE square_feet <= (SELECT quantile_cont(square_feet, 0.99) FROM dirty))""",
    ),
)
def c6(spark, folder):
    return trim_upper(sales_dirty(spark, folder), ["square_feet", "price"]).select(*ID, "square_feet", "price")


@query(
    "c7_sanitize_non_finite",
    with_sales(
        f"""SELECT {ID_SQL}, CASE WHEN v IS NULL OR isnan(v) THEN CAST(0 AS DOUBLE)
              WHEN v = CAST('inf' AS DOUBLE) THEN CAST(1e6 AS DOUBLE)
              WHEN v = CAST('-inf' AS DOUBLE) THEN CAST(-1e6 AS DOUBLE) ELSE v END AS v
            FROM (SELECT *, CASE WHEN l_orderkey % 5 = 0 THEN CAST('nan' AS DOUBLE)
              WHEN l_orderkey % 7 = 0 THEN CAST('inf' AS DOUBLE) WHEN l_orderkey % 11 = 0 THEN CAST('-inf' AS DOUBLE)
              WHEN l_orderkey % 13 <> 0 THEN price END AS v FROM sales)"""
    ),
)
def c7(spark, folder):
    k = F.col("l_orderkey")
    v = (
        F.when(k % 5 == 0, float("nan"))
        .when(k % 7 == 0, float("inf"))
        .when(k % 11 == 0, float("-inf"))
        .when(k % 13 != 0, F.col("price"))
    )
    return sanitize(sales(spark, folder).select(*ID, v.alias("v")), ["v"])


@query(
    "c8_request_defaults",
    with_sales(
        f"""SELECT {ID_SQL}, coalesce(square_feet, CAST(0 AS DOUBLE)) AS square_feet,
              coalesce(CAST(bedrooms AS DOUBLE), 0) AS bedrooms, coalesce(CAST(year_built AS DOUBLE), 2000) AS year_built,
              CASE WHEN l_linenumber = 1 THEN coalesce(square_feet, CAST(0 AS DOUBLE)) * CAST(0.2 AS DOUBLE) ELSE lot_size END AS lot_size,
              CAST(pool AS DOUBLE) AS pool, CAST(fireplace AS DOUBLE) AS fireplace,
              CAST(garage_spaces AS DOUBLE) AS garage_spaces, condition_score
            FROM dirty""",
        DIRTY,
    ),
)
def c8(spark, folder):
    rows = sales_dirty(spark, folder).withColumn(
        "lot_size", F.when(F.col("l_linenumber") != 1, F.col("lot_size"))
    )
    cols = ["square_feet", "bedrooms", "year_built", "lot_size", "pool", "fireplace", "garage_spaces", "condition_score"]
    return feats.request_defaults(rows).select(*ID, *cols)


@query(
    "c9_column_selection",
    with_sales(
        """SELECT property_id, l_orderkey, l_linenumber, square_feet, bedrooms, bathrooms, year_built, lot_size,
             location_id, latitude, longitude, garage_spaces, condition_score FROM sales"""
    ),
)
def c9(spark, folder):
    return select_numeric(sales(spark, folder), exclude=["price"])


# ---------------------------------------------------------------- row-wise features


@query("f1_property_age", with_sales(f"SELECT {ID_SQL}, CAST(2024 - year_built AS INTEGER) AS property_age FROM sales"))
def f1(spark, folder):
    return sales(spark, folder).select(*ID, feats.property_age().alias("property_age"))


@query(
    "f2_age_powers",
    with_sales(
        f"""SELECT {ID_SQL}, CAST((2024 - year_built) * (2024 - year_built) AS INTEGER) AS property_age_squared,
              {rnd("ln(1 + CAST(2024 - year_built AS DOUBLE))", 6)} AS property_age_log FROM sales"""
    ),
)
def f2(spark, folder):
    rows = feats.age_features(sales(spark, folder))
    return rows.select(*ID, "property_age_squared", near("property_age_log", 6).alias("property_age_log"))


RATIOS = ["bed_bath_ratio", "bath_bedroom_ratio", "sqft_per_bedroom", "sqft_per_room", "sqft_per_room_raw"]


@query(
    "f3_ratios",
    with_sales(
        f"""SELECT {ID_SQL}, {rnd("bedrooms / (bathrooms + 1)")} AS bed_bath_ratio,
              {rnd("bathrooms / (bedrooms + 1)")} AS bath_bedroom_ratio,
              {rnd("square_feet / (bedrooms + 1)")} AS sqft_per_bedroom,
              {rnd("square_feet / (bedrooms + bathrooms + 1)")} AS sqft_per_room,
              {rnd("square_feet / (bedrooms + bathrooms)")} AS sqft_per_room_raw FROM sales"""
    ),
)
def f3(spark, folder):
    return feats.ratio_features(sales(spark, folder)).select(*ID, *[near(c).alias(c) for c in RATIOS])


INTERACTIONS = [
    "size_age_interaction", "bed_age_interaction", "sqft_bedroom_interaction", "age_condition_interaction",
    "lat_lon_interaction",
]


@query(
    "f4_interactions",
    with_sales(
        f"""SELECT {ID_SQL}, {rnd("square_feet * (2024 - year_built)")} AS size_age_interaction,
              {rnd("bedrooms * (2024 - year_built)")} AS bed_age_interaction,
              {rnd("square_feet * bedrooms")} AS sqft_bedroom_interaction,
              {rnd("(2024 - year_built) * condition_score")} AS age_condition_interaction,
              {rnd("latitude * longitude")} AS lat_lon_interaction FROM sales"""
    ),
)
def f4(spark, folder):
    return feats.interaction_features(sales(spark, folder)).select(*ID, *[near(c).alias(c) for c in INTERACTIONS])


@query(
    "f5_polynomials",
    with_sales(
        f"""SELECT {ID_SQL}, square_feet * square_feet AS sqft_squared,
              CAST(bedrooms * bedrooms AS INTEGER) AS bedrooms_squared, {rnd("sqrt(lot_size)")} AS lot_sqrt FROM sales"""
    ),
)
def f5(spark, folder):
    rows = feats.polynomial_features(sales(spark, folder))
    return rows.select(*ID, "sqft_squared", "bedrooms_squared", near("lot_sqrt").alias("lot_sqrt"))


@query(
    "f6_logs",
    with_sales(
        f"""SELECT {ID_SQL}, {rnd("ln(1 + square_feet)", 6)} AS log_sqft, {rnd("ln(1 + lot_size)", 6)} AS log_lot,
              {rnd("ln(1 + price)", 6)} AS log_price FROM sales"""
    ),
)
def f6(spark, folder):
    rows = feats.log_features(sales(spark, folder))
    return rows.select(
        *ID,
        near("log_sqft", 6).alias("log_sqft"),
        near("log_lot", 6).alias("log_lot"),
        near(feats.log_target(), 6).alias("log_price"),
    )


@query(
    "f7_flags",
    with_sales(
        f"""SELECT {ID_SQL}, CAST(2024 - year_built < 5 AS INTEGER) AS is_new_construction,
              CAST(2024 - year_built > 50 AS INTEGER) AS is_old,
              CAST(square_feet > 3000 AND bedrooms > 4 AND pool AS INTEGER) AS is_luxury,
              CAST(square_feet > 3000 AND bedrooms >= 4 AND pool AS INTEGER) AS is_luxury_request,
              CAST(square_feet > 3000 AND bedrooms > 4 AS INTEGER) AS is_luxury_catalogue FROM sales"""
    ),
)
def f7(spark, folder):
    rows = feats.flag_features(sales(spark, folder))
    return rows.select(
        *ID,
        "is_new_construction",
        "is_old",
        "is_luxury",
        feats.flag(feats.is_luxury("request")).alias("is_luxury_request"),
        feats.flag(feats.is_luxury("catalogue")).alias("is_luxury_catalogue"),
    )


@query(
    "f8_price_per_sqft",
    with_sales(
        f"""SELECT {ID_SQL}, {rnd("price / square_feet")} AS price_per_sqft, bedrooms + bathrooms AS rooms_total
            FROM sales"""
    ),
)
def f8(spark, folder):
    rows = feats.price_room_features(sales(spark, folder))
    return rows.select(*ID, near("price_per_sqft").alias("price_per_sqft"), "rooms_total")


@query(
    "f9_location_score",
    """SELECT s_suppkey, round(CAST(0.4 AS DOUBLE) * (s_suppkey % 101) + CAST(0.3 AS DOUBLE) * (100 - s_nationkey)
         + CAST(0.3 AS DOUBLE) * (s_suppkey % 97) + 1e-7, 4) AS location_score FROM supplier""",
)
def f9(spark, folder):
    score = feats.location_score(F.col("s_suppkey") % 101, F.col("s_nationkey"), F.col("s_suppkey") % 97)
    return table(spark, folder, "supplier").select("s_suppkey", near(score).alias("location_score"))


@query(
    "f10_condition_bands",
    with_sales(
        f"""SELECT {ID_SQL}, CAST(condition_score >= 8 AS INTEGER) AS condition_excellent,
              CAST(condition_score >= 5 AND condition_score < 8 AS INTEGER) AS condition_good,
              CAST(condition_score < 5 AS INTEGER) AS condition_fair FROM sales"""
    ),
)
def f10(spark, folder):
    rows = feats.condition_bands(sales(spark, folder))
    return rows.select(*ID, "condition_excellent", "condition_good", "condition_fair")


@query(
    "f11_age_bands",
    with_sales(
        f"""SELECT {ID_SQL}, CAST(2024 - year_built < 10 AS INTEGER) AS age_new,
              CAST(2024 - year_built >= 10 AND 2024 - year_built < 30 AS INTEGER) AS age_medium,
              CAST(2024 - year_built >= 30 AS INTEGER) AS age_old FROM sales"""
    ),
)
def f11(spark, folder):
    return feats.age_bands(sales(spark, folder)).select(*ID, "age_new", "age_medium", "age_old")


CALENDAR_SQL = """CAST(year(sale_date) AS INTEGER) AS sale_year, CAST(month(sale_date) AS INTEGER) AS sale_month,
  CAST(quarter(sale_date) AS INTEGER) AS sale_quarter, CAST(isodow(sale_date) - 1 AS INTEGER) AS sale_day_of_week"""


@query("f12_calendar_parts", with_sales(f"SELECT {ID_SQL}, {CALENDAR_SQL} FROM sales"))
def f12(spark, folder):
    rows = feats.calendar_features(sales(spark, folder))
    return rows.select(*ID, "sale_year", "sale_month", "sale_quarter", "sale_day_of_week")


@query(
    "f13_cyclic_encoding",
    with_sales(
        f"""SELECT {ID_SQL}, {rnd("sin(2 * pi() * month(sale_date) / 12)", 6)} AS month_sin,
              {rnd("cos(2 * pi() * month(sale_date) / 12)", 6)} AS month_cos,
              {rnd("sin(2 * pi() * (isodow(sale_date) - 1) / 7)", 6)} AS dow_sin,
              {rnd("cos(2 * pi() * (isodow(sale_date) - 1) / 7)", 6)} AS dow_cos FROM sales"""
    ),
)
def f13(spark, folder):
    rows = feats.cyclic_features(feats.calendar_features(sales(spark, folder)))
    return rows.select(*ID, *[near(c, 6).alias(c) for c in ("month_sin", "month_cos", "dow_sin", "dow_cos")])


@query(
    "f14_target_transform",
    with_sales(
        f"""SELECT {ID_SQL}, {rnd("ln(1 + price)", 6)} AS log_price, {rnd("exp(ln(1 + price)) - 1")} AS price_back
            FROM sales"""
    ),
)
def f14(spark, folder):
    rows = sales(spark, folder).withColumn("log_price", feats.log_target())
    return rows.select(
        *ID, near("log_price", 6).alias("log_price"), near(feats.price_from_log("log_price")).alias("price_back")
    )


@query(
    "f15_declared_features",
    with_sales(
        f"""SELECT {ID_SQL}, CAST(2024 - year_built AS INTEGER) AS property_age,
              CAST((2024 - year_built) * (2024 - year_built) AS INTEGER) AS property_age_squared,
              {rnd("square_feet / (bedrooms + 1)")} AS sqft_per_bedroom,
              {rnd("bedrooms / (bathrooms + 1)")} AS bed_bath_ratio, {rnd("ln(1 + square_feet)", 6)} AS log_sqft,
              2024 - year_built < 5 AS is_new_construction, square_feet > 3000 AND bedrooms > 4 AS is_luxury FROM sales"""
    ),
)
def f15(spark, folder):
    rows = feats.catalogue_features(sales(spark, folder))
    return rows.select(
        *ID,
        "property_age",
        "property_age_squared",
        near("sqft_per_bedroom").alias("sqft_per_bedroom"),
        near("bed_bath_ratio").alias("bed_bath_ratio"),
        near("log_sqft", 6).alias("log_sqft"),
        "is_new_construction",
        "is_luxury",
    )


FINGERPRINTED = ["square_feet", "bedrooms", "bathrooms", "zipcode", "pool"]
FINGERPRINT_SQL = "md5(concat_ws('|', {}))".format(
    ", ".join(f"'{c}=' || coalesce('v' || length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), 'n')" for c in sorted(FINGERPRINTED))
)


@query(
    "f16_row_fingerprint",
    with_sales(
        f"""SELECT {ID_SQL}, {FINGERPRINT_SQL} AS fingerprint,
              substr(sha256('zip=' || zipcode), 1, 16) AS params_hash FROM dirty""",
        DIRTY,
    ),
)
def f16(spark, folder):
    return sales_dirty(spark, folder).select(
        *ID,
        row_fingerprint(FINGERPRINTED).alias("fingerprint"),
        params_hash(F.concat(F.lit("zip="), "zipcode")).alias("params_hash"),
    )


@query(
    "f17_feature_groups",
    with_sales(
        f"""SELECT square_feet, bedrooms, bathrooms, year_built, lot_size, pool, fireplace, garage_spaces,
              condition_score, CAST(2024 - year_built AS INTEGER) AS property_age,
              CAST((2024 - year_built) * (2024 - year_built) AS INTEGER) AS property_age_squared,
              {rnd("square_feet / (bedrooms + 1)")} AS sqft_per_bedroom FROM sales"""
    ),
)
def f17(spark, folder):
    rows = feats.ratio_features(feats.age_features(sales(spark, folder)))
    rows = rows.withColumn("sqft_per_bedroom", near("sqft_per_bedroom"))
    return select_group(rows, "property", "amenities", "derived")


# ---------------------------------------------------------------- encoding, scaling, geography


@query(
    "e1_frequency_index",
    with_sales(
        f"""SELECT {ID_SQL}, zipcode, zipcode_index FROM dirty JOIN (
              SELECT zipcode, CAST(row_number() OVER (ORDER BY n DESC, zipcode) - 1 AS DOUBLE) AS zipcode_index
              FROM (SELECT zipcode, count(*) AS n FROM dirty GROUP BY zipcode)) USING (zipcode)""",
        DIRTY,
    ),
)
def e1(spark, folder):
    rows = frequency_index(sales_dirty(spark, folder), "zipcode", "zipcode_index")
    return rows.select(*ID, "zipcode", "zipcode_index")


@query(
    "e2_one_hot_vector",
    with_sales(
        """SELECT zipcode, CAST(rn AS DOUBLE) AS zipcode_index, CASE WHEN rn < m THEN 1 ELSE 0 END AS active,
             CASE WHEN rn < m THEN CAST(rn AS INTEGER) END AS position, n
           FROM (SELECT zipcode, n, row_number() OVER (ORDER BY n DESC, zipcode) - 1 AS rn, count(*) OVER () - 1 AS m
                 FROM (SELECT zipcode, count(*) AS n FROM sales GROUP BY zipcode))"""
    ),
)
def e2(spark, folder):
    rows = sales(spark, folder).select("zipcode")
    encoded = one_hot_vector(rows, "zipcode", "zipcode_encoded").transform(rows)
    values = vector_to_array("zipcode_encoded")
    at = F.array_position(values, 1.0).cast("int") - 1
    return (
        encoded.withColumns({"active": F.when(at >= 0, 1).otherwise(0), "position": F.when(at >= 0, at)})
        .groupBy("zipcode", "zipcode_index", "active", "position")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "e3_top_categories",
    with_sales(
        """SELECT category, CAST(sum(n) AS BIGINT) AS n FROM (
             SELECT CASE WHEN row_number() OVER (ORDER BY n DESC, zipcode) <= 10 THEN 'zipcode_' || zipcode
                    ELSE 'zipcode_other' END AS category, n
             FROM (SELECT zipcode, count(*) AS n FROM sales GROUP BY zipcode)
             UNION ALL SELECT 'zipcode_other', 0) GROUP BY category"""
    ),
)
def e3(spark, folder):
    rows = sales(spark, folder).select("zipcode")
    coded = fit_top_categories(rows, "zipcode", 10).apply(rows).drop("zipcode")
    totals = coded.agg(*[F.sum(c).alias(c) for c in coded.columns])
    return totals.unpivot([], coded.columns, "category", "n")


@query(
    "e4_robust_scale",
    with_sales(
        "SELECT "
        + ID_SQL
        + "".join(
            ", "
            + rnd(
                f"(CAST({c} AS DOUBLE) - (SELECT median({c}) FROM sales)) / "
                f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.75) - quantile_cont(CAST({c} AS DOUBLE), 0.25) FROM sales)",
                6,
            )
            + f" AS {c}"
            for c in NUMBERS
        )
        + " FROM sales"
    ),
)
def e4(spark, folder):
    rows = sales(spark, folder)
    cols = [c for c in numeric_columns(rows) if c not in ID]
    scaled = fit_robust_scale(rows, cols).apply(rows)
    return scaled.select(*ID, *[near(c, 6).alias(c) for c in cols])


@query("e5_principal_components")
def e5(spark, folder):
    rows = table(spark, folder, "embeddings").select(
        "vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("values")
    )
    from pyspark.ml.functions import array_to_vector

    vectors = rows.select("vec_id", array_to_vector("values").alias("features"))
    model = fit_pca(vectors, "features", "projected", 50)
    return model.transform(vectors).select("vec_id", vector_to_array("projected").alias("projected"))


@query(
    "e6_assembled_vector",
    with_sales(
        f"""SELECT {ID_SQL}, 3 AS width, square_feet AS first_value, bathrooms AS last_value,
              square_feet + bedrooms + bathrooms AS total FROM sales"""
    ),
)
def e6(spark, folder):
    rows = select_ordered(sales(spark, folder), [*ID, "square_feet", "bedrooms", "bathrooms"])
    values = vector_to_array("features")
    return assemble(rows, ["square_feet", "bedrooms", "bathrooms"]).select(
        *ID,
        F.size(values).alias("width"),
        values[0].alias("first_value"),
        values[2].alias("last_value"),
        F.aggregate(values, F.lit(0.0), lambda a, v: a + v).alias("total"),
    )


@query(
    "e7_grid_cells",
    with_sales(
        f"""SELECT cell_fine, count(*) AS n, {rnd("avg(price)", 3)} AS price_mean, {rnd("avg(square_feet)")} AS sqft_mean
            FROM (SELECT *, CAST(CAST(floor((latitude + 90) / 1) AS BIGINT) AS VARCHAR) || '_' ||
                    CAST(CAST(floor((longitude + 180) / 1) AS BIGINT) AS VARCHAR) AS cell_fine FROM sales)
            GROUP BY cell_fine"""
    ),
)
def e7(spark, folder):
    cells = cell_summary(grid_cells(sales(spark, folder)), "cell_fine")
    return cells.select("cell_fine", "n", near("price_mean", 3).alias("price_mean"), near("sqft_mean").alias("sqft_mean"))


@query("e8_fit_then_apply")
def e8(spark, folder):
    rows = written(keep_first(sales(spark, folder), list(ID), list(SALE_ORDER)), "sales")
    old = F.col("sale_date") < F.lit(FIT_CUT).cast("timestamp_ntz")
    fit = FeatureFit(exclude=(*ID, "price"), components=10).fit(rows.filter(old))
    return fit.apply(rows).select(*ID, vector_to_array("projected").alias("projected"))


FITTED = ["square_feet", "property_age", "sale_month", "price_std"]
FIT_CUT = "1995-04-01"


def _scaled_sql(c: str) -> str:
    middle, spread = f"median({c})", f"quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"
    past = f"FROM prepared WHERE sale_date < TIMESTAMP '{FIT_CUT}'"
    return rnd(f"({c} - (SELECT {middle} {past})) / (SELECT CASE WHEN {spread} = 0 THEN 1 ELSE {spread} END {past})", 6)


@query(
    "e8_fit_on_past_apply_to_all",
    with_sales(
        f"SELECT {ID_SQL}, " + ", ".join(f"{_scaled_sql(c)} AS {c}" for c in FITTED) + " FROM prepared",
        """firsts AS (SELECT * FROM sales QUALIFY row_number() OVER (
             PARTITION BY property_id, l_orderkey, l_linenumber, sale_date ORDER BY sale_date) = 1)""",
        f"""stats AS (SELECT zipcode, round(stddev_samp(price), 2) AS price_std FROM firsts
              WHERE sale_date < TIMESTAMP '{FIT_CUT}' GROUP BY zipcode)""",
        """prepared AS (SELECT firsts.* REPLACE (square_feet AS square_feet), coalesce(price_std, 0) AS price_std,
             CAST(2024 - year_built AS DOUBLE) AS property_age, CAST(month(sale_date) AS DOUBLE) AS sale_month
           FROM firsts LEFT JOIN stats USING (zipcode))""",
    ),
)
def e8_past(spark, folder):
    rows = written(keep_first(sales(spark, folder), list(ID), list(SALE_ORDER)), "sales")
    past = rows.filter(F.col("sale_date") < F.lit(FIT_CUT).cast("timestamp_ntz"))
    fit = FeatureFit(exclude=(*ID, "price")).fit(past)
    values = vector_to_array("features")
    return fit.apply(rows).select(
        *ID, *[near(values[fit.columns.index(c)], 6).alias(c) for c in FITTED]
    )


PAST_SQL = f"sale_date < TIMESTAMP '{FIT_CUT}'"
FIRSTS_SQL = """firsts AS (SELECT * FROM sales QUALIFY row_number() OVER (
  PARTITION BY property_id, l_orderkey, l_linenumber, sale_date ORDER BY sale_date) = 1)"""
WHOLE_STATS_SQL = f"""stats AS (SELECT zipcode, round(stddev_samp(price), 2) AS price_std FROM firsts
  WHERE {PAST_SQL} GROUP BY zipcode)"""


@query(
    "e8_training_rows_out_of_fold",
    with_sales(
        f"SELECT {ID_SQL}, " + ", ".join(f"{_scaled_sql(c)} AS {c}" for c in FITTED) + " FROM prepared",
        FIRSTS_SQL,
        WHOLE_STATS_SQL,
        f"""others AS (SELECT fold, zipcode, round(stddev_samp(price), 2) AS price_std
              FROM firsts JOIN (SELECT unnest(range(5)) AS fold) ON l_orderkey % 5 <> fold WHERE {PAST_SQL} GROUP BY ALL)""",
        f"""prepared AS (SELECT firsts.*, coalesce(CASE WHEN {PAST_SQL} THEN o.price_std ELSE s.price_std END, 0) AS price_std,
             CAST(2024 - year_built AS DOUBLE) AS property_age, CAST(month(sale_date) AS DOUBLE) AS sale_month
           FROM firsts LEFT JOIN stats s ON s.zipcode = firsts.zipcode
           LEFT JOIN others o ON o.zipcode = firsts.zipcode AND o.fold = l_orderkey % 5)""",
    ),
)
def e8_out_of_fold(spark, folder):
    """Sales before the cut as training rows, later ones as rows to be scored."""
    rows = written(keep_first(sales(spark, folder), list(ID), list(SALE_ORDER)), "sales")
    old = F.col("sale_date") < F.lit(FIT_CUT).cast("timestamp_ntz")
    fit = FeatureFit(exclude=(*ID, "price"))
    training = fit.fit_training(rows.filter(old), F.col("l_orderkey") % 5)
    both = training.unionByName(fit.apply(rows.filter(~old)))
    values = vector_to_array("features")
    return both.select(*ID, *[near(values[fit.columns.index(c)], 6).alias(c) for c in FITTED])


BACKFILL_SQL = f"""prepared AS (SELECT firsts.* REPLACE (square_feet AS square_feet), coalesce(price_std, 0) AS price_std,
    CAST(2024 - year_built AS DOUBLE) AS property_age, CAST(month(sale_date) AS DOUBLE) AS sale_month
  FROM firsts LEFT JOIN stats USING (zipcode))"""


@query(
    "s8_backfill",
    with_sales(
        f"SELECT {ID_SQL}, CAST(sale_date AS DATE) AS day, "
        + ", ".join(f"{_scaled_sql(c)} AS {c}" for c in FITTED)
        + " FROM prepared",
        FIRSTS_SQL,
        WHOLE_STATS_SQL,
        BACKFILL_SQL,
    ),
)
def s8_backfill(spark, folder):
    """A first batch that the features are fitted on, all later sales in a second one, and a third without new rows."""
    rows = written(keep_first(sales(spark, folder), list(ID), list(SALE_ORDER)), "sales")
    root = fresh_path(spark, "backfill")
    old = F.col("sale_date") < F.lit(FIT_CUT).cast("timestamp_ntz")
    fit = FeatureFit(exclude=(*ID, "price", DAY))
    fit.fit(rows.filter(old).withColumn(DAY, F.to_date("sale_date")))
    for known in (rows.filter(old), rows, rows):
        backfill(known, root, "sale_date", fit)
    columns = load_features(spark, f"{root}/features").columns
    values = vector_to_array("features")
    return backfilled(spark, root).select(*ID, DAY, *[near(values[columns.index(c)], 6).alias(c) for c in FITTED])


@query(
    "e5_explained_variance",
    with_sales(
        f"""SELECT component, {rnd("share", 6)} AS explained FROM (
              SELECT unnest([1, 2]) AS component, (a + c) / 2 AS mid, sqrt(((a - c) / 2) ** 2 + b ** 2) AS off,
                ((a + c) / 2 + CASE WHEN component = 1 THEN 1 ELSE -1 END * off) / (a + c) AS share
              FROM (SELECT covar_samp(bathrooms, bathrooms) AS a, covar_samp(bathrooms, condition_score) AS b,
                      covar_samp(condition_score, condition_score) AS c FROM sales))"""
    ),
)
def e5_variance(spark, folder):
    vectors = assemble(sales(spark, folder), ["bathrooms", "condition_score"])
    shares = explained_variance(fit_pca(vectors, "features", "projected"))
    table = spark.createDataFrame(list(enumerate(shares, 1)), "component INT, explained DOUBLE")
    return table.withColumn("explained", near("explained", 6))


VECTOR_PARTS = (
    "square_feet + bedrooms + bathrooms + year_built + {lot} + CAST(pool AS INTEGER) + CAST(fireplace AS INTEGER) "
    "+ garage_spaces + condition_score + (2024 - year_built) + (2024 - year_built) * (2024 - year_built) "
    "+ square_feet / (bedrooms + 1)"
)
BATCH_SQL = (
    VECTOR_PARTS.format(lot="coalesce(lot_size, 0)") + " + bedrooms / (bathrooms + 1) + ln(1 + square_feet) "
    "+ CAST(2024 - year_built < 5 AS INTEGER) + CAST(2024 - year_built > 50 AS INTEGER)"
)
SERVICE_SUM_SQL = VECTOR_PARTS.format(lot="coalesce(lot_size, square_feet * 0.2)") + " + bathrooms / (bedrooms + 1)"
NO_LOT = "lots AS (SELECT * REPLACE (CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE lot_size END AS lot_size) FROM sales)"


def _vector_sum(df, width):
    values = vector_to_array("features")
    return assemble(df, width).select(
        *ID, F.size(values).alias("width"), near(F.aggregate(values, F.lit(0.0), lambda a, v: a + v), 3).alias("total")
    )


def _without_some_lots(spark, folder):
    lot = F.when(F.col("l_linenumber") % 3 != 0, F.col("lot_size"))
    return sales(spark, folder).withColumn("lot_size", lot)


@query(
    "e6_batch_vector",
    with_sales(f"SELECT {ID_SQL}, {len(BATCH_VECTOR)} AS width, {rnd(BATCH_SQL, 3)} AS total FROM lots", NO_LOT),
)
def batch_vector(spark, folder):
    return _vector_sum(feats.batch_features(_without_some_lots(spark, folder)), BATCH_VECTOR)


@query(
    "e6_service_vector",
    with_sales(f"SELECT {ID_SQL}, {len(SERVICE_VECTOR)} AS width, {rnd(SERVICE_SUM_SQL, 3)} AS total FROM lots", NO_LOT),
)
def service_vector(spark, folder):
    rows = feats.request_features(_without_some_lots(spark, folder))
    return _vector_sum(rows, SERVICE_VECTOR)


@query(
    "e6_request_vector",
    with_sales(
        f"""SELECT {ID_SQL}, {len(REQUEST_VECTOR)} AS width,
              {rnd("square_feet + bedrooms + bathrooms + year_built + lot_size + CAST(pool AS INTEGER) "
                   "+ CAST(fireplace AS INTEGER) + garage_spaces + condition_score + (2024 - year_built) "
                   "+ (2024 - year_built) * (2024 - year_built) + square_feet / (bedrooms + 1) "
                   "+ bathrooms / (bedrooms + 1) + ln(1 + square_feet) + ln(1 + lot_size) "
                   "+ CAST(2024 - year_built < 5 AS INTEGER) + CAST(2024 - year_built > 50 AS INTEGER) "
                   "+ CAST(square_feet > 3000 AND bedrooms >= 4 AND pool AS INTEGER) + square_feet * bedrooms "
                   "+ (2024 - year_built) * condition_score", 3)} AS total
            FROM sales"""
    ),
)
def request_vector(spark, folder):
    rows = sanitize(feats.request_features(sales(spark, folder)), REQUEST_VECTOR)
    values = vector_to_array("features")
    return assemble(rows, REQUEST_VECTOR).select(
        *ID,
        F.size(values).alias("width"),
        near(F.aggregate(values, F.lit(0.0), lambda a, v: a + v), 3).alias("total"),
    )
