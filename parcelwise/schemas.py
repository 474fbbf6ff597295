"""Declared schemas, column rules and other fixed values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

DEFAULT_YEAR = 2024

# Schemas of the provided tables (declared, so a read never infers).
TABLES = {
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
    " l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,"
    " l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
}


@dataclass(frozen=True)
class Rule:
    """What a column of the property-sales table must satisfy."""

    column: str
    family: str
    required: bool = False
    unique: bool = False
    low: float | None = None
    high: float | None = None
    pattern: str | None = None
    default: object = None


# Column rules of the property-sales table.
SALE_RULES = (
    Rule("property_id", "string", required=True, unique=True),
    Rule("square_feet", "float", required=True, low=100, high=50000),
    Rule("bedrooms", "int", required=True, low=0, high=10),
    Rule("bathrooms", "float", required=True, low=0, high=10),
    Rule("year_built", "int", required=True, low=1800, high=2024),
    Rule("lot_size", "float", low=0, high=100000, default=0.0),
    Rule("zipcode", "string", required=True, pattern=r"^\d{5}$"),
    Rule("latitude", "float", low=-90, high=90),
    Rule("longitude", "float", low=-180, high=180),
    Rule("price", "float", required=True, low=10000, high=10000000),
)

# Accepted ranges and required fields of a scoring request.
REQUEST_RANGES = {
    "square_feet": (100, 50000),
    "bedrooms": (0, 10),
    "bathrooms": (0, 10),
    "year_built": (1800, 2024),
    "lot_size": (0, 100000),
    "garage_spaces": (0, 10),
    "condition_score": (1, 10),
}
REQUEST_REQUIRED = ("square_feet", "bedrooms", "bathrooms", "year_built")

# Constants that replace missing values before the domain filter.
CLEAN_DEFAULTS = {
    "square_feet": 0.0,
    "bedrooms": 2,
    "bathrooms": 1.5,
    "year_built": 2000,
    "lot_size": 0.0,
    "condition_score": 5.0,
}

# Named feature sets.
FEATURE_GROUPS = {
    "property": ("square_feet", "bedrooms", "bathrooms", "year_built", "lot_size"),
    "amenities": ("pool", "fireplace", "garage_spaces", "condition_score"),
    "derived": ("property_age", "property_age_squared", "sqft_per_bedroom"),
    "temporal": ("month_sin", "month_cos", "dow_sin", "dow_cos"),
}

# Order of the columns in the feature vectors of the scoring paths.
REQUEST_VECTOR = (
    "square_feet", "bedrooms", "bathrooms", "year_built", "lot_size", "pool", "fireplace",
    "garage_spaces", "condition_score", "property_age", "property_age_squared", "sqft_per_bedroom",
    "bath_bedroom_ratio", "log_sqft", "log_lot", "is_new_construction", "is_old_property",
    "is_luxury", "sqft_bedroom_interaction", "age_condition_interaction",
)
BATCH_VECTOR = (
    "square_feet", "bedrooms", "bathrooms", "year_built", "lot_size", "pool", "fireplace",
    "garage_spaces", "condition_score", "property_age", "property_age_squared", "sqft_per_bedroom",
    "bed_bath_ratio", "log_sqft", "is_new", "is_old",
)

SERVICE_VECTOR = (
    "square_feet", "bedrooms", "bathrooms", "year_built", "lot_size", "pool", "fireplace",
    "garage_spaces", "condition_score", "property_age", "property_age_squared", "sqft_per_bedroom",
    "bath_bedroom_ratio",
)

# Derived-feature catalogue (name, type, expression).
FEATURE_CATALOGUE = (
    ("property_age", "int", "2024 - year_built"),
    ("property_age_squared", "int", "property_age ** 2"),
    ("sqft_per_bedroom", "double", "square_feet / (bedrooms + 1)"),
    ("bed_bath_ratio", "double", "bedrooms / (bathrooms + 1)"),
    ("log_sqft", "double", "log1p(square_feet)"),
    ("is_new_construction", "boolean", "property_age < 5"),
    ("is_luxury", "boolean", "square_feet > 3000 and bedrooms > 4"),
)

# Histogram bounds and monitoring thresholds.
LATENCY_BOUNDS = (0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)
REQUEST_SECONDS_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
SIZE_BOUNDS = (100.0, 1000.0, 10000.0, 100000.0, 1000000.0)
PRICE_BOUNDS = (
    100000.0, 250000.0, 500000.0, 750000.0, 1000000.0, 1500000.0, 2000000.0, 3000000.0, 5000000.0,
)
THRESHOLDS = (
    ("latency_ms", "above", 500.0),
    ("error_rate", "above", 0.05),
    ("accuracy", "below", 0.85),
    ("drift_score", "above", 0.2),
    ("cache_hit_ratio", "below", 0.3),
)

# Ranges of the second request rule set; None is open. Its size and lot are above 0.
SERVICE_RANGES = {
    "square_feet": (None, 50000),
    "bedrooms": (0, 20),
    "bathrooms": (0, 15),
    "year_built": (1800, 2024),
    "latitude": (-90, 90),
    "longitude": (-180, 180),
    "garage_spaces": (0, 10),
    "condition_score": (1, 10),
}
SERVICE_POSITIVE = ("square_feet", "lot_size")
SERVICE_REQUIRED = ("square_feet", "bedrooms", "bathrooms", "year_built", "zipcode")
ZIPCODE_PATTERN = "^[0-9]{5}$"

# Request and message payload.
REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("property_id", T.StringType()),
        T.StructField("square_feet", T.DoubleType()),
        T.StructField("bedrooms", T.IntegerType()),
        T.StructField("bathrooms", T.DoubleType()),
        T.StructField("year_built", T.IntegerType()),
        T.StructField("lot_size", T.DoubleType()),
        T.StructField("pool", T.BooleanType()),
        T.StructField("fireplace", T.BooleanType()),
        T.StructField("garage_spaces", T.IntegerType()),
        T.StructField("condition_score", T.DoubleType()),
    ]
)

# Run-tracking, feature-registry, prediction-log and model-metadata tables.
TRACKING_TABLES = {
    "experiments": "experiment_id INT, name STRING, artifact_location STRING, lifecycle_stage STRING,"
    " creation_time BIGINT, last_update_time BIGINT",
    "runs": "run_id STRING, experiment_id INT, status STRING, source_type STRING, source_name STRING,"
    " user_id STRING, start_time BIGINT, end_time BIGINT, source_version STRING, lifecycle_stage STRING,"
    " artifact_uri STRING",
    "metrics": "key STRING, value DOUBLE, timestamp BIGINT, run_id STRING, step BIGINT, is_nan BOOLEAN",
    "params": "key STRING, value STRING, run_id STRING",
    "tags": "key STRING, value STRING, run_id STRING",
    "feature_registry": "feature_view_name STRING, entities STRING, features STRING, source STRING, ttl BIGINT",
    "online_features": "feature_name STRING, entity_key STRING, feature_value STRING,"
    " event_timestamp TIMESTAMP_NTZ, created_timestamp TIMESTAMP_NTZ",
    "model_metadata": "model_name STRING, model_version STRING, training_date TIMESTAMP_NTZ,"
    " metrics MAP<STRING, DOUBLE>, parameters MAP<STRING, STRING>, feature_names ARRAY<STRING>, status STRING",
    "prediction_logs": "request_id STRING, model_version STRING, features STRING, prediction DOUBLE,"
    " actual_price DOUBLE, latency_ms DOUBLE, timestamp TIMESTAMP_NTZ",
    "data_drift_metrics": "feature_name STRING, drift_score DOUBLE, timestamp TIMESTAMP_NTZ",
}
