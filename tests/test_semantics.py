"""Hand-made frames: nulls, NaN, ties, empty input, single rows, zero ranges."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parcelwise.functions import columns as cols
from parcelwise.functions import features as feats
from parcelwise.models import scoring
from parcelwise.operators import aggregates as agg
from parcelwise.operators import alerts, cleaning, drift, encoding, joins, metrics, registry, splits, validation, windows
from parcelwise.operators import quantiles as quantiles_module
from parcelwise.operators.quantiles import quantile_values
from parcelwise.schemas import FEATURE_CATALOGUE, Rule
from parcelwise.session import shuffle_width
from parcelwise.sources import files, publish, tables

DAY = datetime(2024, 1, 1)


def one(df):
    return df.first().asDict()


def test_ratio_and_age_of_the_sample_house(spark):
    house = spark.createDataFrame(
        [(2200.0, 4, 2.5, 2010, 6000.0, True)],
        "square_feet DOUBLE, bedrooms INT, bathrooms DOUBLE, year_built INT, lot_size DOUBLE, pool BOOLEAN",
    )
    row = one(feats.ratio_features(feats.age_features(house)))
    assert row["sqft_per_bedroom"] == 440
    assert row["property_age"] == 14 and row["property_age_squared"] == 196
    assert one(feats.age_features(house, 2030))["property_age"] == 20


def test_sqft_per_room_without_rooms_is_null(spark):
    row = one(feats.ratio_features(spark.createDataFrame([(900.0, 0, 0.0)], "square_feet DOUBLE, bedrooms INT, bathrooms DOUBLE")))
    assert row["sqft_per_room_raw"] is None and row["sqft_per_room"] == 900


def test_metrics_of_the_sample_vectors(spark):
    pairs = [(100.0, 110.0), (200.0, 190.0), (300.0, 310.0), (400.0, 390.0), (500.0, 510.0)]
    row = one(metrics.regression_metrics(spark.createDataFrame(pairs, "actual DOUBLE, prediction DOUBLE")))
    assert row["mae"] == 10 and row["rmse"] == 10 and row["r2"] == pytest.approx(0.995)


def test_zero_actuals_leave_mape_and_are_counted(spark):
    row = one(metrics.regression_metrics(spark.createDataFrame([(0.0, 5.0), (10.0, 11.0)], "actual DOUBLE, prediction DOUBLE")))
    assert row["mape"] == pytest.approx(10.0) and row["zero_actuals"] == 1 and row["mae"] == 3


def test_metrics_of_constant_actuals_have_no_r2(spark):
    row = one(metrics.regression_metrics(spark.createDataFrame([(5.0, 6.0), (5.0, 4.0)], "actual DOUBLE, prediction DOUBLE")))
    assert row["r2"] is None


def test_small_segments_are_left_out(spark):
    rows = [("big", float(i), float(i + 1)) for i in range(1, 12)] + [("small", 1.0, 2.0)] * 10
    found = metrics.segment_metrics(spark.createDataFrame(rows, "s STRING, actual DOUBLE, prediction DOUBLE"), "s").collect()
    assert [r["s"] for r in found] == ["big"] and found[0]["q50"] == 1.0


def test_luxury_variants(spark):
    df = spark.createDataFrame(
        [(3500.0, 4, True), (3500.0, 5, True), (3500.0, 5, False), (3500.0, 5, None), (3000.0, 5, True)],
        "square_feet DOUBLE, bedrooms INT, pool BOOLEAN",
    )
    shown = df.select(*[feats.flag(feats.is_luxury(v)).alias(v) for v in ("training", "request", "catalogue")])
    assert [tuple(r) for r in shown.collect()] == [(0, 1, 0), (1, 1, 1), (0, 0, 1), (0, 0, 1), (0, 0, 0)]
    with pytest.raises(ValueError):
        feats.is_luxury("other")


def test_bands_meet_their_edges(spark):
    df = spark.createDataFrame([(8.0,), (7.9,), (5.0,), (4.9,), (None,)], "condition_score DOUBLE")
    shown = feats.condition_bands(df).select("condition_excellent", "condition_good", "condition_fair").collect()
    assert [tuple(r) for r in shown] == [(1, 0, 0), (0, 1, 0), (0, 1, 0), (0, 0, 1), (0, 0, 0)]


def test_weekday_counts_from_monday(spark):
    df = spark.createDataFrame([(DAY,), (datetime(2024, 1, 7),)], "sale_date TIMESTAMP_NTZ")
    assert [r["sale_day_of_week"] for r in feats.calendar_features(df).collect()] == [0, 6]


def test_declared_features_may_use_earlier_ones(spark):
    df = spark.createDataFrame([(2010,)], "year_built INT")
    entries = [e for e in FEATURE_CATALOGUE if e[0].startswith("property_age")] + [("x", "double", "(property_age + 1) ** 2")]
    row = one(feats.catalogue_features(df, entries))
    assert row["property_age_squared"] == 196 and row["x"] == 225


def test_request_defaults_and_lot_variants(spark):
    df = spark.createDataFrame(
        [(1000.0, None, None, None, None, None, True, None, None)],
        "square_feet DOUBLE, bedrooms INT, bathrooms DOUBLE, year_built INT, lot_size DOUBLE, pool BOOLEAN,"
        " fireplace BOOLEAN, garage_spaces INT, condition_score DOUBLE",
    )
    row = one(feats.request_defaults(df))
    assert (row["lot_size"], row["year_built"], row["pool"], row["fireplace"], row["condition_score"]) == (200, 2000, 0, 1, 5)
    assert one(feats.request_defaults(df, "zero"))["lot_size"] == 0


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"), 1), (None, None), (2.0, 3)], "a DOUBLE, b INT")
    assert [r["a"] for r in cols.nan_to_null(df).collect()] == [None, None, 2.0]
    assert [tuple(r) for r in cols.sanitize(df).collect()] == [(0.0, 1), (0.0, 0), (2.0, 3)]
    shares = {r["column"]: r["missing_share"] for r in validation.missing_shares(df).collect()}
    assert shares["a"] == pytest.approx(2 / 3) and shares["b"] == pytest.approx(1 / 3)
    rule = Rule("a", "float", low=0, high=1)
    assert validation.range_checks(df, [rule]).first()["unexpected_count"] == 1


def test_nan_does_not_disturb_quantiles_or_bins(spark):
    rows = [(float(i),) for i in range(101)] + [(float("nan"),)] * 300
    df = spark.createDataFrame(rows, "v DOUBLE")
    for bound in (20, 10**6):
        assert quantile_values(df, ["v"], [0.5, 1.0], bound) == {"v": [50.0, 100.0]}
    fit = drift.fit_drift_bins(df, ["v"])
    assert drift.drift_scores(df, fit).first()["n"] == 101


def test_a_quantile_outside_its_bracket_is_still_exact(spark, monkeypatch):
    df = spark.range(5000).select((F.col("id") % 4999).cast("double").alias("v"))
    expected = quantile_values(df, ["v"], [0.3, 0.5])
    monkeypatch.setattr(quantiles_module, "MARGIN", -0.01)
    found = quantile_values(df, ["v"], [0.3, 0.5], 100)
    assert found["v"] == pytest.approx(expected["v"])


def test_column_selection_errors(spark):
    df = spark.createDataFrame([(1.0, "x")], "square_feet DOUBLE, z STRING")
    assert cols.select_numeric(df).columns == ["square_feet"]
    assert cols.select_except(df, ["z"]).columns == ["square_feet"]
    assert one(cols.select_ordered(df, ["pool", "square_feet"])) == {"pool": 0.0, "square_feet": 1.0}
    with pytest.raises(ValueError):
        cols.select_group(df, "nothing")
    with pytest.raises(ValueError):
        cols.select_group(df, "property")


def test_fingerprint_separates_null_from_text(spark):
    df = spark.createDataFrame([(None, "a"), ("null", "a"), ("n", "a")], "p STRING, q STRING")
    found = [r[0] for r in df.select(cols.row_fingerprint(["p", "q"])).collect()]
    assert len(set(found)) == 3
    assert found == [r[0] for r in df.select(cols.row_fingerprint(["q", "p"])).collect()]


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_keep_first_breaks_ties_by_order(spark, parts):
    rows = [("a", 2, "late"), ("a", 1, "early"), (None, 5, "x"), (None, 4, "y"), ("b", None, "null first"), ("b", 0, "z")]
    df = spark.createDataFrame(rows, "k STRING, o INT, v STRING").repartition(parts)
    kept = {r["k"]: r["v"] for r in cleaning.keep_first(df, ["k"], ["o"]).collect()}
    assert kept == {"a": "early", None: "y", "b": "null first"}


def test_domain_filter_bounds_are_strict(spark):
    rows = [(100.0, 1, 20000.0), (101.0, 10, 20000.0), (101.0, 11, 20000.0), (101.0, 1, 10000.0), (101.0, 1, None), (0.0, 1, 20000.0)]
    df = spark.createDataFrame(rows, "square_feet DOUBLE, bedrooms INT, price DOUBLE")
    assert [r["bedrooms"] for r in cleaning.domain_filter(df).collect()] == [10]


def test_impute_falls_back_to_the_overall_median(spark):
    rows = [("a", 10.0), ("a", None), ("a", 20.0), ("b", None), (None, None), (None, 40.0)]
    df = spark.createDataFrame(rows, "zipcode STRING, square_feet DOUBLE")
    filled = cleaning.impute_by_group(df, ["zipcode"], ["square_feet"], {})
    assert sorted((r["zipcode"] or "", r["square_feet"]) for r in filled.collect()) == [
        ("", 40.0), ("", 40.0), ("a", 10.0), ("a", 15.0), ("a", 20.0), ("b", 20.0)
    ]


def test_trim_is_sequential(spark):
    df = spark.createDataFrame([(float(i), float(101 - i)) for i in range(1, 101)], "a DOUBLE, b DOUBLE")
    kept = cleaning.trim_upper(df, ["a", "b"], 0.9)
    expected = [(a, 101 - a) for a in range(1, 91)]
    bound = sorted(b for _, b in expected)
    position = 0.9 * 89
    limit = bound[int(position)] + (position % 1) * (bound[int(position) + 1] - bound[int(position)])
    assert kept.count() == sum(b <= limit for _, b in expected)


def test_robust_scale_with_zero_range(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0), (5.0, 5.0)], "flat DOUBLE, x DOUBLE")
    fit = encoding.fit_robust_scale(df, ["flat", "x"])
    assert [tuple(r) for r in fit.apply(df).collect()] == [(0, -1), (0, 0), (0, 1)]
    empty = encoding.fit_robust_scale(df.limit(0), ["x"])
    assert empty.center == {"x": 0.0} and empty.spread == {"x": 1.0}


def test_apply_before_fit_fails(spark):
    with pytest.raises(ValueError):
        encoding.FeatureFit().apply(spark.range(1))


def test_frequency_index_orders_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "z STRING")
    found = {r["z"]: r["i"] for r in encoding.frequency_index(df, "z", "i").collect()}
    assert found == {"c": 0, "a": 1, "b": 2}


def test_top_categories_share_an_other_column(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), ("c",), (None,)], "z STRING")
    shown = encoding.fit_top_categories(df, "z", 2).apply(df)
    assert shown.columns == ["z", "z_a", "z_b", "z_other"]
    assert [r["z_other"] for r in shown.collect()] == [0, 0, 0, 0, 1, 1]


def test_leave_one_out_of_a_single_row_is_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 7.0)], "k STRING, v DOUBLE")
    found = sorted((r["k"], r["v"], r["m"]) for r in agg.leave_one_out_mean(df, ["k"], "v", "m").collect())
    assert found == [("a", 1.0, 3.0), ("a", 3.0, 1.0), ("b", 7.0, None)]


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "v DOUBLE")
    counts = {r["bin"]: r["n"] for r in agg.fixed_histogram(df, "v", 5).collect()}
    assert counts == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    assert agg.fixed_histogram(df.limit(0), "v").count() == 0
    assert agg.fixed_histogram(spark.createDataFrame([(3.0,)], "v DOUBLE"), "v").first()["n"] == 1


def test_profile_counts_repeated_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a INT, b STRING")
    found = {(r["measure"], r["column"]): r["value"] for r in agg.table_profile(df).collect()}
    assert found["duplicate_rows", None] == "1" and found["missing_values", "b"] == "2"
    empty = {(r["measure"], r["column"]): r["value"] for r in agg.table_profile(df.limit(0)).collect()}
    assert empty["total_rows", None] == "0" and empty["duplicate_rows", None] == "0"


def test_hit_ratio_without_lookups(spark):
    df = spark.createDataFrame([], "k STRING, hit BOOLEAN")
    assert agg.hit_ratio(df, [], F.col("hit")).first()["hit_ratio"] == 0


def test_percent_rank_of_a_single_row_is_zero(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 1.0), ("b", 2.0)], "k STRING, v DOUBLE")
    for bound in (1, 10**6):
        found = sorted((r["k"], r["p"]) for r in windows.percent_rank_within(df, ["k"], "v", "p", bound).collect())
        assert found == [("a", 0.0), ("b", 0.0), ("b", 0.0), ("b", 1.0)]


def test_rolling_days_counts_days_not_rows(spark):
    rows = [("z", DAY, 10.0), ("z", DAY, 20.0), ("z", DAY + timedelta(days=30), 99.0), ("z", DAY + timedelta(days=31), 1.0)]
    df = spark.createDataFrame(rows, "k STRING, ts TIMESTAMP_NTZ, v DOUBLE")
    found = {(r["ts"], r["v"]): r["m"] for r in windows.rolling_days(df, ["k"], "ts", {"m": ("v", 30)}).collect()}
    assert found == {
        (DAY, 10.0): None, (DAY, 20.0): None,
        (DAY + timedelta(days=30), 99.0): 15.0, (DAY + timedelta(days=31), 1.0): 99.0,
    }


def test_yearly_growth_skips_gaps(spark):
    rows = [("z", datetime(2022, 3, 5), 100.0), ("z", datetime(2023, 3, 9), 110.0), ("z", datetime(2023, 5, 9), 50.0)]
    df = spark.createDataFrame(rows, "k STRING, ts TIMESTAMP_NTZ, v DOUBLE")
    found = {r["month"].month + 12 * r["month"].year: r["year_over_year_growth"] for r in windows.monthly_index(df, ["k"], "ts", "v").collect()}
    assert found[3 + 12 * 2023] == pytest.approx(0.1) and found[5 + 12 * 2023] is None


def test_point_in_time_edges(spark):
    history = spark.createDataFrame(
        [("e", DAY, DAY, 1), ("e", DAY, DAY + timedelta(hours=1), 2), ("e", DAY + timedelta(days=9), DAY, 3)],
        "id STRING, event_timestamp TIMESTAMP_NTZ, created_timestamp TIMESTAMP_NTZ, v INT",
    )
    view = joins.FeatureView("f", history, "id", ("v",), timedelta(days=5))
    asked = [DAY - timedelta(seconds=1), DAY, DAY + timedelta(days=5), DAY + timedelta(days=5, seconds=1), DAY + timedelta(days=9)]
    spine = spark.createDataFrame([("e", t) for t in asked] + [("unknown", DAY), (None, DAY)], "id STRING, event_timestamp TIMESTAMP_NTZ")
    found = {(r["id"], r["event_timestamp"]): r["v"] for r in joins.point_in_time(spine, view).collect()}
    assert [found["e", t] for t in asked] == [None, 2, 2, None, 3]
    assert found["unknown", DAY] is None and found[None, DAY] is None
    with pytest.raises(ValueError):
        joins.historical_features(spine, [view], ["f:w"])


def test_null_entities_have_no_history(spark):
    history = spark.createDataFrame(
        [(None, DAY, DAY, 1), ("e", DAY, DAY, 2)], "id STRING, event_timestamp TIMESTAMP_NTZ, created_timestamp TIMESTAMP_NTZ, v INT"
    )
    spine = spark.createDataFrame([(None, DAY), ("e", DAY)], "id STRING, event_timestamp TIMESTAMP_NTZ")
    found = joins.point_in_time(spine, joins.FeatureView("f", history, "id", ("v",))).collect()
    assert {r["id"]: r["v"] for r in found} == {None: None, "e": 2}


def test_repeated_actuals_count_once(spark):
    predictions = spark.createDataFrame([("a", 10.0), ("b", 20.0), ("c", 5.0)], "id STRING, prediction DOUBLE")
    rows = [("a", 12.0, 2), ("a", 30.0, 1), ("a", 11.0, 2), ("b", None, 3), ("b", 24.0, 1), ("z", 1.0, 1)]
    actuals = spark.createDataFrame(rows, "id STRING, actual DOUBLE, at INT")
    newest = joins.delayed_metrics(predictions, actuals, "id", arrived="at").first()
    assert (newest["mae"], newest["waiting"]) == (3.0, 1)
    largest = joins.delayed_metrics(predictions, actuals, "id").first()
    assert (largest["mae"], largest["waiting"]) == (12.0, 1)


def test_a_member_without_weight_is_refused(spark):
    predictions = spark.createDataFrame([(1, "m", 10.0), (1, "n", 20.0)], "row_id INT, member STRING, prediction DOUBLE")
    weights = spark.createDataFrame([("m", 1.0)], "member STRING, weight DOUBLE")
    both = weights.union(spark.createDataFrame([("n", 3.0)], "member STRING, weight DOUBLE"))
    assert scoring.ensemble_long(predictions, both).first()["ensemble"] == 17.5
    with pytest.raises(Exception, match="no weight for member n"):
        scoring.ensemble_long(predictions, weights).collect()


def test_cumulative_quantile_equals_the_long_form(spark):
    rows = [(1, [0, 0, 4, 10, 10]), (2, [10, 10, 10, 10, 10]), (3, [0, 0, 0, 0, 7]), (4, [0] * 5), (5, [1, 1, 1, 3, 20])]
    df = spark.createDataFrame(rows, "k INT, c ARRAY<BIGINT>")
    bounds = [0.1, 0.5, 1.0, 2.0]
    entries = [F.struct(F.lit(b).alias("le"), F.col("c")[i].alias("cumulative")) for i, b in enumerate([*bounds, float("inf")])]
    for q in (0.5, 0.95):
        long = alerts.bucket_quantile(df.select("k", F.col("c")[4].alias("n"), F.inline(F.array(*entries))), ["k"], q)
        want = {r["k"]: r["quantile"] for r in long.collect()}
        got = {r["k"]: r["q"] for r in df.select("k", alerts.cumulative_quantile(F.col("c"), bounds, q).alias("q")).collect()}
        assert got == {**want, 4: None}


def test_repeated_spine_rows_stay(spark):
    history = spark.createDataFrame([("e", DAY, DAY, 1)], "id STRING, event_timestamp TIMESTAMP_NTZ, created_timestamp TIMESTAMP_NTZ, v INT")
    spine = spark.createDataFrame([("e", DAY)] * 3, "id STRING, event_timestamp TIMESTAMP_NTZ")
    assert joins.point_in_time(spine, joins.FeatureView("f", history, "id", ("v",))).count() == 3


def test_version_without_the_metric_drops(spark):
    versions = spark.createDataFrame([("v1", "r1"), ("v2", "r2"), ("v3", "r3")], "version STRING, run_id STRING")
    runs = spark.createDataFrame([("mae", 5.0, "r1"), ("mae", 3.0, "r3"), ("rmse", 1.0, "r2")], "key STRING, value DOUBLE, run_id STRING")
    assert [r["version"] for r in joins.compare_versions(versions, runs, "mae").collect()] == ["v3", "v1"]


def test_zscore_of_a_constant_column_has_no_outliers(spark):
    df = spark.createDataFrame([(i, 5.0, 100.0 if i == 0 else 1.0) for i in range(50)], "id INT, flat DOUBLE, x DOUBLE")
    found = validation.outliers_zscore(df, ["id"], ["flat", "x"]).collect()
    assert [(r["id"], r["column"]) for r in found] == [(0, "x")]


def test_negative_size_is_refused(spark):
    df = spark.createDataFrame(
        [(-100.0, 3, 2.0, 2000, None, None, None)],
        "square_feet DOUBLE, bedrooms INT, bathrooms DOUBLE, year_built INT, lot_size DOUBLE, garage_spaces INT, condition_score DOUBLE",
    )
    valid, refused = validation.validate_requests(df)
    assert valid.count() == 0
    assert refused.first()["reasons"] == ["square_feet must be between 100 and 50000"]


def test_schema_checks_report_missing_and_mistyped_columns(spark):
    df = spark.createDataFrame([(1, "x")], "property_id INT, square_feet STRING")
    found = {(c, n): ok for c, n, ok in validation.schema_checks(df)}
    assert not found["required_column", "price"] and found["required_column", "property_id"]
    assert not found["column_type", "property_id"] and not found["column_type", "square_feet"]


def test_suite_fails_for_an_absent_column(spark):
    df = spark.createDataFrame([("p", 500.0)], "property_id STRING, square_feet DOUBLE")
    results = validation.expectation_suite(df)
    bad = {(r["expectation"], r["column"]) for r in results.collect() if not r["success"]}
    assert bad == {("exists", c) for c in ("bedrooms", "bathrooms", "year_built", "price")}
    assert validation.suite_summary(results).first()["failed_expectations"] == 4


def test_ks_of_equal_and_disjoint_samples(spark):
    a = spark.createDataFrame([(float(i),) for i in range(100)], "v DOUBLE")
    b = spark.createDataFrame([(float(i + 1000),) for i in range(100)], "v DOUBLE")
    same, apart = validation.ks_two_sample(a, a, ["v"]).first(), validation.ks_two_sample(a, b, ["v"]).first()
    assert same["ks_statistic"] == 0 and same["p_value"] == 1
    assert apart["ks_statistic"] == 1 and apart["p_value"] < 1e-6


def test_drift_of_equal_and_shifted_samples(spark):
    a = spark.createDataFrame([(float(i),) for i in range(1000)], "v DOUBLE")
    fit = drift.fit_drift_bins(a, ["v"])
    assert drift.drift_scores(a, fit).first()["drift_score"] == pytest.approx(0, abs=1e-6)
    moved = drift.drift_scores(a.withColumn("v", F.col("v") + 600), fit).first()
    assert moved["drifted"] and math.isfinite(moved["drift_score"])
    constant = drift.fit_drift_bins(a.withColumn("v", F.lit(3.0)), ["v"])
    assert constant.edges == {"v": [3.0]}


def test_bucket_quantile_interpolates(spark):
    df = spark.createDataFrame([("e", 0.005)] * 50 + [("e", 0.02)] * 50 + [("slow", 9.0)], "k STRING, s DOUBLE")
    histogram = agg.bucketed_histogram(df, ["k"], "s", (0.01, 0.025, 0.05))
    found = {r["k"]: r["quantile"] for r in alerts.bucket_quantile(histogram, ["k"], 0.75).collect()}
    assert found["e"] == pytest.approx(0.0175) and found["slow"] == 0.05


def test_firing_needs_an_unbroken_stretch(spark):
    states = [True, True, True, False, True, True, None, True]
    rows = [("r", DAY + timedelta(minutes=i), s) for i, s in enumerate(states)]
    df = spark.createDataFrame(rows, "rule STRING, ts TIMESTAMP_NTZ, holds BOOLEAN")
    found = alerts.firing(df, "rule", "ts", F.col("holds"), 60, 120).collect()
    assert [(r["since"], r["seconds"]) for r in found] == [(DAY, 120)]


def test_rules_fire_by_their_own_durations(spark):
    rules = [
        alerts.AlertRule("Slow", "latency", "above", 0.5, 180, "warning"),
        alerts.AlertRule("VerySlow", "latency", "above", 0.9, 60, "critical"),
        alerts.AlertRule("Down", "loaded", "below", 1.0, 86_400, "critical", 86_400),
    ]
    values = [0.6, 0.7, 0.95, 0.99, None, 0.6, 0.6, float("nan"), 0.6]
    rows = [("latency", DAY + timedelta(minutes=i), v) for i, v in enumerate(values)]
    rows += [("loaded", DAY + timedelta(days=i), v) for i, v in enumerate([0.0, 0.0, 1.0, 0.0])] + [("other", DAY, 9.0)]
    series = spark.createDataFrame(rows, "metric STRING, ts TIMESTAMP_NTZ, value DOUBLE")
    found = {(r["rule"], r["since"], r["seconds"], r["severity"]) for r in alerts.alert_table(series, rules).collect()}
    assert found == {
        ("Slow", DAY, 180, "warning"),
        ("VerySlow", DAY + timedelta(minutes=2), 60, "critical"),
        ("Down", DAY, 86_400, "critical"),
    }
    assert alerts.alert_table(series.limit(0)).count() == 0


def test_a_database_table_is_not_read_by_one_task_unasked(spark):
    with pytest.raises(ValueError, match="split column"):
        tables.ingest_jdbc(spark, "jdbc:unused:", "t")


def test_composite_operators(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("b", True)], "k STRING, triggered BOOLEAN")
    for operator, expected in (("AND", {"a": False, "b": True}), ("OR", {"a": True, "b": True}), ("NOT", {"a": False, "b": False})):
        assert {r["k"]: r["should_run"] for r in alerts.composite_trigger(df, ["k"], operator).collect()} == expected


def test_threshold_directions(spark):
    df = spark.createDataFrame([("accuracy", 0.8), ("latency_ms", 400.0), ("other", 1.0)], "metric STRING, value DOUBLE")
    assert {r["metric"]: r["breached"] for r in alerts.threshold_board(df).collect()} == {"accuracy": True, "latency_ms": False}


def test_random_split_is_disjoint_and_repeatable(spark):
    df = spark.range(20000)
    first = splits.random_split(df.repartition(3), ["id"])
    second = {r["id"]: r["split"] for r in splits.random_split(df.repartition(11), ["id"]).collect()}
    assert {r["id"]: r["split"] for r in first.collect()} == second
    shares = {r["split"]: r["count"] / 20000 for r in first.groupBy("split").count().collect()}
    assert shares["train"] == pytest.approx(0.7, abs=0.02) and shares["val"] == pytest.approx(0.1, abs=0.02)
    other = {r["id"]: r["split"] for r in splits.random_split(df, ["id"], seed=1).collect()}
    assert other != second


def test_cuts_and_folds():
    assert splits.split_cuts(1000) == (700, 850)
    assert splits.split_cuts(1000, "nested") == (640, 800)
    assert splits.fold_table(12, 5) == [(0, 2, 2, 4), (1, 4, 4, 6), (2, 6, 6, 8), (3, 8, 8, 10), (4, 10, 10, 12)]
    assert splits.fold_table(13, 5, 1)[0] == (0, 2, 3, 5)
    with pytest.raises(ValueError):
        splits.fold_table(4, 5)
    with pytest.raises(ValueError):
        splits.split_cuts(10, "other")


def test_backtest_periods_skip_thin_training(spark):
    rows = [(DAY + timedelta(days=i // 5),) for i in range(500)]
    df = spark.createDataFrame(rows, "ts TIMESTAMP_NTZ")
    found = splits.backtest_periods(df, "ts", DAY, DAY + timedelta(days=95), "monthly").orderBy("period").collect()
    assert [(r["period"], r["n_train"], r["n_test"]) for r in found] == [(1, 150, 150), (2, 300, 150), (3, 450, 50)]
    single = splits.backtest_periods(df, "ts", DAY + timedelta(days=50), DAY + timedelta(days=60), "once").collect()
    assert [(r["n_train"], r["n_test"]) for r in single] == [(250, 50)]
    weekly = splits.backtest_periods(df, "ts", DAY, DAY + timedelta(days=30), "weekly").count()
    assert weekly == 2


def test_registry_promotes_archives_and_rolls_back(spark):
    rows = [
        ("m", DAY, 1, "register", None, "a"),
        ("m", DAY + timedelta(hours=1), 2, "register", None, "b"),
        ("m", DAY + timedelta(hours=2), 3, "promote", "v1", None),
        ("m", DAY + timedelta(hours=3), 4, "promote", "v2", None),
        ("m", DAY + timedelta(hours=4), 5, "promote", "v9", None),
        ("n", DAY, 6, "register", None, "a"),
    ]
    events = spark.createDataFrame(
        rows, "model_name STRING, event_ts TIMESTAMP_NTZ, event_id BIGINT, action STRING, version STRING, params STRING"
    )

    def stages(e):
        return {(r["model_name"], r["version"]): r["stage"] for r in registry.registry_state(e).collect()}

    assert stages(events) == {("m", "v1"): "archived", ("m", "v2"): "production", ("n", "v1"): "staging"}
    state = registry.registry_state(events)
    targets = registry.rollback_targets(state)
    assert [(r["model_name"], r["version"]) for r in targets.collect()] == [("m", "v1")]
    after = registry.promote_event(events, targets, DAY + timedelta(hours=9))
    assert stages(after) == {("m", "v1"): "production", ("m", "v2"): "archived", ("n", "v1"): "staging"}


def test_ensemble_weights():
    assert scoring.normalized_weights([2, 1, 1]) == [0.5, 0.25, 0.25]
    assert scoring.add_member([0.5, 0.5]) == pytest.approx([0.375, 0.375, 0.25])
    assert scoring.add_member([0.5, 0.5], 1.0) == [0.25, 0.25, 0.5]


def test_residual_interval_covers_its_level(spark):
    rows = [(float(p), float(p + (i * 37 % 201) - 100)) for i, p in enumerate(range(1000, 5000))]
    df = spark.createDataFrame(rows, "prediction DOUBLE, actual DOUBLE")
    covered = scoring.fit_residual_interval(df).apply(df).filter(F.col("actual").between(F.col("lower"), F.col("upper")))
    assert covered.count() / 4000 == pytest.approx(0.95, abs=0.01)


def test_csv_keeps_damaged_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,2.5\nx,3.0\n")
    df = files.load_csv(spark, str(tmp_path), "id INT, v DOUBLE", corrupt_column="bad")
    found = sorted(((r["id"], r["v"], r["bad"]) for r in df.collect()), key=str)
    assert found == [(1, 2.5, None), (None, 3.0, "x,3.0")]


def test_prefix_without_files_is_empty(spark, tmp_path):
    (tmp_path / "note.txt").write_text("x")
    df = files.load_prefix(spark, str(tmp_path), "a INT")
    assert df.columns == ["a"] and df.count() == 0


def test_inventory_lists_bytes(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "t"))
    found = files.file_inventory(spark.read.parquet(str(tmp_path / "t"))).collect()
    assert sum(r["rows"] for r in found) == 100 and len(found) == 3 and all(r["file_bytes"] > 0 for r in found)


def test_overwrite_replaces_only_written_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    files.save_parquet(spark.createDataFrame([(1, "a"), (2, "b")], "v INT, k STRING"), path, partition_by=["k"])
    files.save_parquet(spark.createDataFrame([(9, "b")], "v INT, k STRING"), path, partition_by=["k"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]


def test_incremental_read_excludes_the_mark(spark):
    df = spark.createDataFrame([(DAY,), (DAY + timedelta(seconds=1),)], "ts TIMESTAMP_NTZ")
    newer = tables.ingest_incremental(df, "ts", DAY)
    assert newer.count() == 1
    assert tables.high_water_mark(newer, "ts").first()["high_water_mark"] == DAY + timedelta(seconds=1)


def test_query_values_are_bound(spark):
    df = spark.createDataFrame([("x' OR '1'='1",), ("y",)], "s STRING")
    found = tables.ingest_query(spark, "SELECT s FROM {t} WHERE s = :s", {"s": "x' OR '1'='1"}, t=df)
    assert found.count() == 1


def test_model_metadata_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("m", "v1", {"mae": 1.5}, {"depth": "3"}, ["a", "b"])],
        "model_name STRING, model_version STRING, metrics MAP<STRING, DOUBLE>, parameters MAP<STRING, STRING>, feature_names ARRAY<STRING>",
    )
    publish.append_tracking(df, str(tmp_path), "model_metadata")
    row = publish.read_tracking(spark, str(tmp_path), "model_metadata").first()
    assert row["metrics"] == {"mae": 1.5} and row["feature_names"] == ["a", "b"] and row["status"] is None


def test_shuffle_width_follows_the_input():
    assert shuffle_width(0) == 200
    assert shuffle_width(100 * 10**12) == math.ceil(100 * 10**12 / (256 * 1024**2))
