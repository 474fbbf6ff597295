"""NaN is missing in every numeric operator, and small and forced-large plans agree on it."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parcelwise import scale
from parcelwise.functions.columns import row_fingerprint
from parcelwise.functions.features import request_defaults
from parcelwise.operators import aggregates, cleaning, validation
from parcelwise.operators.quantiles import quantiles

NAN = float("nan")
SCHEMA = "id INT, zipcode STRING, price DOUBLE, square_feet DOUBLE, property_age DOUBLE"


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, "a", float(i), 10.0 * i, 5.0) for i in range(1, 51)]
    rows += [(51, "a", NAN, NAN, None), (52, "b", NAN, None, NAN), (53, "b", None, 1.0, 1.0), (54, None, 7.0, 2.0, 3.0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_group_statistics_do_not_depend_on_size(frame):
    small, large = (aggregates.group_stats(frame, max_rows=n) for n in (10**6, 2))
    assert rows_of(small) == rows_of(large)
    found = {r.zipcode: r.price_median for r in small.collect()}
    assert found == {"a": 25.5, "b": None, None: 7.0}


@pytest.mark.parametrize("max_rows", [10**6, 2])
def test_groups_without_values_stay(frame, max_rows):
    found = {r.zipcode: r for r in quantiles(frame, ["price", "square_feet"], [0.5], ["zipcode"], max_rows=max_rows).collect()}
    assert set(found) == {"a", "b", None}
    assert found["b"].price is None and found["b"].square_feet == [1.0]
    assert quantiles(frame.limit(0), ["price"], [0.5], ["zipcode"], max_rows=max_rows).count() == 0


@pytest.mark.parametrize("max_rows", [10**6, 2])
def test_imputation_fills_nan(frame, max_rows):
    filled = cleaning.impute_by_group(frame, ["zipcode"], ["price"], {}, max_rows=max_rows)
    found = {r.id: r.price for r in filled.where("id > 50").collect()}
    assert found == {51: 25.5, 52: 25.0, 53: 25.0, 54: 7.0}
    imputer = cleaning.fit_median_imputer(frame, ["price"], max_rows=max_rows)
    assert {r.price for r in imputer.apply(frame).where("id in (51, 52, 53)").collect()} == {25.0}


def test_outliers_ignore_nan(frame):
    assert validation.outliers_zscore(frame, ["id"], ["price"]).count() == 0
    assert validation.outliers_iqr(frame, ["id"], ["price"]).count() == 0
    one = frame.withColumn("price", F.when(F.col("id") == 1, 1e6).otherwise(F.col("price")))
    assert [r.id for r in validation.outliers_zscore(one, ["id"], ["price"]).collect()] == [1]
    assert [r.id for r in validation.outliers_iqr(one, ["id"], ["price"]).collect()] == [1]


def test_histogram_and_correlation_ignore_nan(frame):
    bins = {r.bin: r.n for r in aggregates.fixed_histogram(frame.where("zipcode = 'a'"), "price", 7).collect()}
    assert sum(bins.values()) == 50 and set(bins) == set(range(7))
    matrix = aggregates.correlation_matrix(frame.where("zipcode = 'a'"), ["price", "square_feet"]).collect()
    assert all(abs(r.correlation - 1) < 1e-9 for r in matrix)


def test_leave_one_out_ignores_nan(frame):
    found = aggregates.leave_one_out_mean(frame.where("id in (1, 3, 51)"), ["zipcode"], "price", "others")
    assert {r.id: r.others for r in found.collect()} == {1: 3.0, 3: 1.0, 51: 2.0}


def test_request_defaults_replace_nan(spark):
    names = ["square_feet", "bedrooms", "bathrooms", "year_built", "lot_size", "pool", "fireplace", "garage_spaces"]
    row = spark.createDataFrame([(NAN,) * 9], ", ".join(f"{n} DOUBLE" for n in [*names, "condition_score"]))
    got = request_defaults(row).first()
    assert (got.square_feet, got.year_built, got.condition_score, got.lot_size) == (0.0, 2000.0, 5.0, 0.0)


def test_rows_a_microsecond_apart_are_no_duplicates(spark):
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(microseconds=n), 1) for n in (0, 1, 998, 998)]
    df = spark.createDataFrame(rows, "ts TIMESTAMP_NTZ, v INT")
    both = df.withColumn("zoned", F.col("ts").cast("timestamp"))
    for frame in (df, both, both.drop("ts")):
        found = {r.measure: r.value for r in aggregates.table_profile(frame).collect()}
        assert found["duplicate_rows"] == "1"


def test_fingerprint_keeps_parts_apart(spark):
    rows = [("x|b=v1:y", "z"), ("x", "y|b=v1:z"), ("x", None), ("x", "n")]
    df = spark.createDataFrame(rows, "a STRING, b STRING")
    assert df.select(row_fingerprint(["a", "b"])).distinct().count() == 4


def test_lookups_are_bounded_by_rows_and_bytes(spark):
    df = spark.range(2000, numPartitions=16).select("id", F.repeat(F.lit("x"), 100).alias("wide"))
    assert scale.small_rows(df, 2000).count() == 2000
    assert scale.small_rows(df, 1999) is None
    assert scale.small_rows(df, 2000, max_bytes=100_000) is None
    nested = df.select(F.struct("id", "wide").alias("s"), F.array("wide").alias("a"))
    assert scale.small_rows(nested, 2000, max_bytes=200_000) is None
    assert scale.small_rows(nested, 2000).count() == 2000


def test_a_large_lookup_sends_nothing_to_one_task(spark):
    """Counting happens where the rows are: only one row per partition is shuffled."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lookup", "bounded")
    side = scale.lookup_side(spark.range(200_000, numPartitions=16).select("id"), 1000)
    jobs = tracker.getJobIdsForGroup("lookup")
    tasks = sum(tracker.getStageInfo(s).numTasks for j in jobs for s in tracker.getJobInfo(j).stageIds)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert side.count() == 200_000 and tasks >= 16
    assert "Limit" not in side._jdf.queryExecution().toString()
