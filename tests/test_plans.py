"""Plan shape of single operators. Rules for all queries are checked in test_queries.py."""

import __spark_entry__
import pytest
from pyspark.sql import functions as F

from compare import TESTDATA, plan
from parcelwise.plans import QUERIES
from parcelwise.scale import fresh_path, lookup_side, shared_folder
from parcelwise.session import COMPILED_METHODS, DEFAULTS

FOLDER = f"{TESTDATA}/sf0.001"
def test_only_admission_runs_python(spark):
    assert "FlatMapGroupsInPandas" in plan(QUERIES["k7_admissions_table"](spark, FOLDER))


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["s1_parquet_scan"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in text
    assert "l_comment" not in text and "l_tax" not in text
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,30.0)]" in plan(QUERIES["d13_slow_requests"](spark, FOLDER))


def test_rolling_means_share_one_shuffle_and_sort(spark):
    text = plan(QUERIES["w2_rolling_rows_zipcode"](spark, FOLDER))
    assert text.count("Exchange hashpartitioning(zipcode") == 1 and text.count("Sort [zipcode") == 1


def test_rank_reuses_the_shuffle_of_the_rolling_means(spark):
    text = plan(QUERIES["flagship_feature_job"](spark, FOLDER))
    assert text.count("Exchange hashpartitioning(zipcode") == 1


def test_point_in_time_is_one_shuffle(spark):
    text = plan(QUERIES["j2_point_in_time"](spark, FOLDER))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_lookup_is_broadcast_only_within_its_bound(spark):
    big, small = spark.range(1000), spark.range(10).withColumn("v", F.lit(1))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in off}
    try:
        for key, value in off.items():
            spark.conf.set(key, value)
        assert "BroadcastHashJoin" in plan(big.join(lookup_side(small), "id"))
        assert "SortMergeJoin" in plan(big.join(lookup_side(small, 9), "id"))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class Named:
    """Stands for a session whose configuration names a shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return "/shared/checkpoints/" if key == "spark.checkpoint.dir" else default


def test_shared_folder_is_read_from_the_session(spark):
    assert shared_folder(Named) == "/shared/checkpoints"
    assert fresh_path(Named, "x").startswith("/shared/checkpoints/x-")
    assert shared_folder(spark) == shared_folder(spark) != shared_folder(Named)


def test_a_cluster_without_shared_folder_is_refused():
    class Cluster:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError):
        shared_folder(Cluster)


def test_wide_projections_run_in_methods_that_are_compiled(spark):
    """Longer methods stay in HotSpot's interpreter, which made the widest stages several times slower."""
    name, limit = COMPILED_METHODS
    assert DEFAULTS[name] == limit
    spark.conf.set(name, "65535")
    __spark_entry__.queries()["e6_assembled_vector"](spark, FOLDER)
    assert spark.conf.get(name) == limit
