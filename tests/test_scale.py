"""The split plans for hot keys give the same rows as the plain plans."""

import random
from datetime import datetime, timedelta

import pytest
import numpy as np
from pyspark.sql import functions as F

from parcelwise.operators.admission import admissions, admit, known_end
from parcelwise.operators.cleaning import impute_by_group, trim_upper
from parcelwise.operators.encoding import fit_robust_scale
from parcelwise.operators.joins import FeatureView, point_in_time, reuse_or_score
from parcelwise.operators.ordering import day_number, last_known, rank_within, rolling_rows, running_sum
from parcelwise.operators.quantiles import quantiles
from parcelwise.operators.splits import chronological_position
from parcelwise.operators.validation import ks_two_sample
from parcelwise.operators.windows import percent_rank_within
from parcelwise.plans.flagship import feature_job
from parcelwise.sources.sample_tables import sales_dirty

from compare import TESTDATA

SMALL, LARGE = 40, 10**9
START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def hot(spark):
    """600 rows; key 'a' holds two thirds, one key is null, values repeat and some are null."""
    draw = random.Random(7)
    rows = []
    for i in range(600):
        key = "a" if i % 3 else draw.choice(["b", "c", "d", None])
        value = None if i % 29 == 0 else float(draw.randint(0, 50))
        rows.append((i, key, START + timedelta(hours=draw.randint(0, 900)), value))
    return spark.createDataFrame(rows, "id INT, k STRING, ts TIMESTAMP_NTZ, v DOUBLE").repartition(7)


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))



def bucket(kind):
    return day_number(F.col("ts")) if kind == "day" else None


@pytest.mark.parametrize("kind", [None, "day"])
@pytest.mark.parametrize("parts", [1, 4, 13])
def test_rank_within(hot, kind, parts):
    plain = rank_within(hot, ["k"], ["ts", "id"], "r", max_rows=LARGE)
    split = rank_within(hot.repartition(parts), ["k"], ["ts", "id"], "r", bucket(kind), SMALL)
    assert rows_of(split) == rows_of(plain)


@pytest.mark.parametrize("kind", [None, "day"])
def test_rank_of_whole_frame(hot, kind):
    ranked = rank_within(hot, [], ["ts", "id"], "r", bucket(kind), SMALL).orderBy("r").collect()
    expected = sorted(((r["ts"], r["id"]) for r in hot.collect()))
    assert [(r["ts"], r["id"]) for r in ranked] == expected
    assert [r["r"] for r in ranked] == list(range(1, 601))


@pytest.mark.parametrize("kind", [None, "day"])
def test_running_sum(hot, kind):
    filled = hot.fillna(0.0, ["v"]).withColumn("n", F.lit(1))
    plain = running_sum(filled, ["k"], ["ts", "id"], {"s": "v", "c": "n"}, max_rows=LARGE)
    split = running_sum(filled, ["k"], ["ts", "id"], {"s": "v", "c": "n"}, bucket(kind), SMALL)
    assert rows_of(split) == rows_of(plain)


@pytest.mark.parametrize("kind", [None, "day"])
def test_last_known(hot, kind):
    sparse = hot.withColumn("v", F.when(F.col("id") % 17 == 0, F.col("v")))
    plain = last_known(sparse, ["k"], ["ts", "id"], "v", "last", max_rows=LARGE)
    split = last_known(sparse, ["k"], ["ts", "id"], "v", "last", bucket(kind), SMALL)
    assert rows_of(split) == rows_of(plain)


@pytest.mark.parametrize("kind", [None, "day"])
@pytest.mark.parametrize("reach", [3, 30])
def test_rolling_rows(hot, kind, reach):
    outputs = {"a": ("v", reach), "b": ("v", 2)}
    plain = rolling_rows(hot, ["k"], ["ts", "id"], outputs, max_rows=LARGE)
    split = rolling_rows(hot, ["k"], ["ts", "id"], outputs, bucket(kind), SMALL)
    assert rows_of(split) == rows_of(plain)


def test_percent_rank(hot):
    plain = percent_rank_within(hot, ["k"], "v", "p", LARGE)
    assert rows_of(percent_rank_within(hot, ["k"], "v", "p", SMALL)) == rows_of(plain)


def test_quantiles(hot):
    frame = hot.withColumn("w", F.col("v") * 3 + F.col("id"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]

    def rounded(df):
        return sorted(
            repr((r["k"], [[round(x, 9) for x in r[c]] for c in ("v", "w")])) for r in df.collect()
        )

    plain = quantiles(frame, ["v", "w"], probs, ["k"], max_rows=LARGE)
    assert rounded(quantiles(frame, ["v", "w"], probs, ["k"], max_rows=SMALL)) == rounded(plain)
    whole = quantiles(frame, ["v"], probs, max_rows=SMALL).first()["v"]
    assert whole == pytest.approx(quantiles(frame, ["v"], probs, max_rows=LARGE).first()["v"])


def test_point_in_time(hot, spark):
    history = hot.select("k", "ts", (F.col("ts") + F.make_interval(days=F.col("id") % 3)).alias("made"), "v", "id")
    view = FeatureView("h", history, "k", ("v", "id"), timedelta(days=4), "ts", "made")
    spine = hot.select("k", F.col("id").alias("ask"), (F.col("ts") + F.make_interval(hours=F.lit(5))).alias("at"))
    plain = point_in_time(spine, view, ts="at", prefix="h_", max_rows=LARGE)
    split = point_in_time(spine, view, ts="at", prefix="h_", max_rows=SMALL)
    assert rows_of(split) == rows_of(plain)
    facts = history.collect()
    for row in plain.collect():
        seen = [
            f for f in facts if row["k"] is not None and f["k"] == row["k"] and row["at"] - timedelta(days=4) <= f["ts"] <= row["at"]
        ]
        # A history value may itself be null; only the chosen row matters.
        chosen = max(seen, key=lambda f: (f["ts"], f["made"], f["v"] is not None, f["v"] or 0, f["id"]), default=None)
        assert row["h_id"] == (chosen and chosen["id"])


def test_reuse_or_score_split(hot):
    asked = hot.select("id", "k", "ts")
    results = hot.filter(F.col("id") % 4 == 0).select("k", F.col("ts").alias("result_ts"), F.lit(1.5).alias("price"))

    def run(max_rows):
        return reuse_or_score(
            asked, results, "k", lambda m: m.withColumn("price", F.lit(-1.0)), ["price"], max_rows=max_rows
        )

    assert rows_of(run(SMALL)) == rows_of(run(LARGE))
    assert run(LARGE).count() == asked.count()


def test_ks_split(hot):
    current, reference = hot.filter(F.col("id") % 2 == 0), hot.filter(F.col("id") % 2 == 1)
    plain = ks_two_sample(current, reference, ["v", "id"], LARGE)
    assert rows_of(ks_two_sample(current, reference, ["v", "id"], SMALL)) == rows_of(plain)


def test_position_of_a_hot_day(spark):
    rows = [(i, START + timedelta(seconds=i % 500) + timedelta(days=40 * (i % 10 == 0))) for i in range(500)]
    df = spark.createDataFrame(rows, "id INT, ts TIMESTAMP_NTZ")
    placed = chronological_position(df, ["ts", "id"], "ts", SMALL).orderBy("position").collect()
    assert [(r["ts"], r["id"]) for r in placed] == sorted((t, i) for i, t in rows)
    assert placed[-1]["fraction"] == 499 / 500


def test_admissions_split(spark):
    draw = random.Random(3)
    rows = []
    for i in range(900):
        client = 1 if i % 3 else draw.randint(2, 6)
        rows.append((i, client, START + timedelta(seconds=draw.randint(0, 4 * 86400))))
    log = spark.createDataFrame(rows, "id INT, client INT, ts TIMESTAMP_NTZ")
    expected = []
    for client in {r[1] for r in rows}:
        calls = sorted(((r[2], r[0]) for r in rows if r[1] == client))
        times = [int((t - START).total_seconds() * 1e6) for t, _ in calls]
        decided, _ = admit(times, [], 5, 7200 * 10**6)
        expected += [(i, ok) for (_, i), ok in zip(calls, decided)]
    assert {ok for _, ok in expected} == {True, False}
    for bound in (LARGE, SMALL, 250):
        found = admissions(log, "client", "ts", "id", 5, 7200, bound).collect()
        assert sorted((r["id"], r["admitted"]) for r in found) == sorted(expected)


def test_saturated_key_takes_two_passes(spark, monkeypatch):
    """A key that is at its limit all the time, in about 100 blocks, and another that rests in between."""
    from parcelwise.operators import admission

    draw = random.Random(4)
    rows = [(i, 1, START + timedelta(seconds=20 * i)) for i in range(20_000)]
    rows += [(20_000 + i, 2, START + timedelta(seconds=draw.randint(0, 9) + 3600 * (i // 40))) for i in range(4000)]
    log = spark.createDataFrame(rows, "id INT, client INT, ts TIMESTAMP_NTZ")
    expected = []
    for client in (1, 2):
        calls = sorted((r[2], r[0]) for r in rows if r[1] == client)
        decided, _ = admit([int((t - START).total_seconds() * 1e6) for t, _ in calls], [], 7, 600 * 10**6)
        expected += [(i, ok) for (_, i), ok in zip(calls, decided)]
    copies, store = [], admission.written

    def counted(df, label, *args):
        copies.append((label, out := store(df, label, *args)))
        return out

    monkeypatch.setattr(admission, "written", counted)
    found = admissions(log, "client", "ts", "id", 7, 600, 200)
    assert sorted((r["id"], r["admitted"]) for r in found.collect()) == sorted(expected)
    # One pass over the calls for what blocks leave behind, one for the decisions.
    assert [label for label, _ in copies] == ["calls", "ends"]
    ends = copies[1][1].collect()
    assert sum(r["client"] == 1 for r in ends) >= 100
    assert all(r["__live"] is None for r in ends if r["client"] == 1)
    assert any(r["__live"] is not None for r in ends if r["client"] == 2)


def test_known_ends_do_not_depend_on_the_past():
    draw = random.Random(5)
    known = 0
    for _ in range(400):
        times = sorted(draw.randint(0, 400) for _ in range(draw.randint(1, 60)))
        limit, window = draw.randint(1, 4), draw.randint(5, 60)
        live = known_end(np.array(times), limit, window)
        known += live is not None
        for past in ([], [times[0] - window + 1] * limit, [times[0]] * (limit - 1)):
            if live is not None:
                after = times[-1]
                assert [t for t in admit(times, past, limit, window)[1] if t > after - window] == [
                    t for t in live if t > after - window
                ]
    assert 20 < known < 380


def test_feature_job_split(spark):
    rows = sales_dirty(spark, f"{TESTDATA}/sf0.001")
    order = ["sale_date", "property_id", "l_orderkey", "l_linenumber"]

    def rounded(df):
        means = ["rolling_avg_price_30d", "rolling_avg_price_90d"]
        return rows_of(df.select("l_orderkey", "property_id", *[F.round(m, 6).alias(m) for m in means], "price_rank_zipcode"))

    assert rounded(feature_job(rows, order, 100)) == rounded(feature_job(rows, order))


def test_quantile_operators_read_their_source_once_or_twice(spark):
    """Counted by a source that adds one each time it is run."""
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        reads.add(1)
        yield from batches

    rows = [(i, f"z{i % 3}", None if i % 7 == 0 else float(i * 37 % 101), float(i % 13)) for i in range(600)]
    plain = spark.createDataFrame(rows, "id INT, zipcode STRING, square_feet DOUBLE, price DOUBLE").coalesce(1)
    source = plain.mapInArrow(counted, plain.schema)

    def times(build):
        before = reads.value
        found = build(source).collect()
        return reads.value - before, found

    for bound in (LARGE, 50):
        imputed, found = times(lambda df: impute_by_group(df, ["zipcode"], ["square_feet", "price"], {}, bound))
        assert imputed == 2 and len(found) == 600 and all(r["square_feet"] is not None for r in found)
        trimmed, found = times(lambda df: trim_upper(df, ["square_feet", "price"], 0.9, bound))
        assert trimmed == 2 and 0 < len(found) < 600
        scaled, _ = times(lambda df: fit_robust_scale(df, ["square_feet", "price"], bound).apply(df))
        assert scaled == 2
