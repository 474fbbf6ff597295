"""Model operators on a frame with a known signal."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import DenseVector
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from parcelwise.models import estimators, explain, scoring
from parcelwise.models.arrays import on_arrays
from parcelwise.models.estimators import (
    compare_models,
    evaluate,
    fit_early_stopping,
    gradient_boosting,
    importance_table,
    predict_price,
    random_forest,
    with_label,
)
from parcelwise.models.evaluation import backtest, cross_validate
from parcelwise.models.store import ModelStore, load_features
from parcelwise.models.training import TrainingSettings, train
from parcelwise.models.tuning import random_search, sample_params, search_history
from parcelwise.operators.encoding import FeatureFit, assemble, fit_pca
from parcelwise.operators.ordering import rank_within
from parcelwise.operators.selection import top_factors, top_features
from parcelwise.operators.splits import chronological_position, fold_table
from parcelwise.schemas import REQUEST_VECTOR
from parcelwise.sources import backfill as backfills
from parcelwise.sources.backfill import backfill, backfilled, mark_of
from parcelwise.sources.publish import read_tracking

NAMES = ["size", "age", "noise"]


@pytest.fixture(scope="module")
def rows(spark):
    """Price grows with size and falls with age; noise has no influence."""
    base = spark.range(600).select(
        F.col("id"),
        F.pmod(F.col("id") * 7919, F.lit(997)).cast("double").alias("size"),
        F.pmod(F.col("id") * 104729, F.lit(89)).cast("double").alias("age"),
        F.pmod(F.col("id") * 1299709, F.lit(101)).cast("double").alias("noise"),
        (F.lit(datetime(2020, 1, 1)).cast("timestamp_ntz") + F.make_interval(days=F.col("id").cast("int"))).alias("ts"),
    )
    priced = base.withColumn("price", 50000 + 300 * F.col("size") - 500 * F.col("age"))
    return assemble(with_label(priced), NAMES).select("id", "ts", "price", "label", "features").persist()


@pytest.fixture(scope="module")
def model(rows):
    return random_forest(numTrees=10, maxDepth=6, featureSubsetStrategy="all").fit(rows)


def test_training_rows_are_dealt_by_number_and_not_kept_in_memory(spark, rows, monkeypatch):
    monkeypatch.setattr(estimators, "TASK_ROWS", 20)
    one = rows.coalesce(1)
    assert estimators.spread(one).rdd.getNumPartitions() == 30
    sizes = estimators.spread(one).rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert sum(sizes) == 600 and max(sizes) <= 40
    levels, kind, persist = [], type(rows), type(rows).persist
    monkeypatch.setattr(kind, "persist", lambda df, level=StorageLevel.MEMORY_AND_DISK: levels.append(level) or persist(df, level))
    tiny = {"num_leaves": (2, 4), "n_estimators": (1, 2)}
    random_search(one.filter("id < 500"), one.filter("id >= 500"), trials=2, ranges=tiny)
    cross_validate(chronological_position(one, ["ts", "id"], "ts"), fold_table(600, 2), random_forest(numTrees=1, maxDepth=2))
    compare_models({"forest": random_forest(numTrees=1, maxDepth=2)}, one, one)
    assert levels and all(not level.useMemory for level in levels)


def test_models_beat_the_mean(rows):
    train_rows, test_rows = rows.filter("id < 450"), rows.filter("id >= 450")
    boosted = fit_early_stopping(gradient_boosting(True, maxIter=30, stepSize=0.2, minInstancesPerNode=5), train_rows, test_rows)
    assert evaluate(boosted, test_rows).first()["r2"] > 0.9
    table = compare_models({"forest": random_forest(numTrees=10, maxDepth=6, featureSubsetStrategy="all")}, train_rows, test_rows)
    row = table.first()
    assert row["r2"] > 0.8 and row["train_seconds"] > 0


def test_importances_agree(rows, model):
    impurity = importance_table(model, rows, NAMES)
    assert [r["feature"] for r in top_features(impurity, 1).collect()] == ["size"]
    permuted = {r["feature"]: r["importance"] for r in explain.permutation_importance(model, rows, NAMES, ["id"]).collect()}
    assert permuted["size"] > permuted["age"] > permuted["noise"] >= -1e-3


def test_permutation_importance_does_not_depend_on_partitions(rows, model):
    a = explain.permutation_importance(model, rows.repartition(1), NAMES, ["id"]).collect()
    b = explain.permutation_importance(model, rows.repartition(13), NAMES, ["id"]).collect()
    assert {r[0]: round(r[1], 9) for r in a} == {r[0]: round(r[1], 9) for r in b}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def fitted(rows, model):
    from pyspark.ml.regression import LinearRegression

    line = LinearRegression(featuresCol="features", labelCol="label", solver="normal").fit(rows)
    boosted = gradient_boosting(maxIter=4, maxDepth=3).fit(rows)
    return {"forest": model, "boosted": boosted, "tree": model.trees[0], "line": line}


@pytest.mark.parametrize("kind", ["forest", "boosted", "tree", "line"])
def test_models_on_arrays_predict_the_same(spark, rows, fitted, kind):
    scorer = on_arrays(spark, fitted[kind])
    found = fitted[kind].transform(rows).select(vector_to_array("features").alias("x"), "prediction").collect()
    x, expected = np.array([r["x"] for r in found]), np.array([r["prediction"] for r in found])
    state = scorer.state(x)
    assert np.allclose(scorer.predictions(state), expected, rtol=1e-12, atol=0)
    moved, old = x.copy(), x[:, 0].copy()
    moved[:, 0] = x[::-1, 0]
    assert np.allclose(scorer.changed(state, moved, 0, old), scorer.state(moved), rtol=1e-12, atol=0)
    values = np.linspace(0, 997, 200)
    near = scorer.alike(0, values)
    for i in range(199):
        if near[i] == near[i + 1]:
            moved[:, 0] = values[i]
            first = scorer.state(moved)
            moved[:, 0] = values[i + 1]
            assert (first == scorer.state(moved)).all()


@pytest.mark.parametrize("kind", ["forest", "line"])
def test_partial_dependence_equals_scored_copies_without_copying_rows(rows, fitted, kind):
    curve = explain.partial_dependence(fitted[kind], rows, NAMES, "age", 7)
    assert "Generate" not in _plan(curve)
    found = curve.orderBy("point").collect()
    assert [r["point"] for r in found] == list(range(7))
    plain = rows.select(vector_to_array("features").alias("x"))
    for r in found:
        changed = plain.select(array_to_vector(F.array(F.col("x")[0], F.lit(r["grid_value"]), F.col("x")[2])).alias("features"))
        mean = fitted[kind].transform(changed).agg(F.avg("prediction")).first()[0]
        assert abs(mean - r["mean_prediction"]) < 1e-9


def test_partial_dependence_follows_the_signal(rows, model):
    curve = explain.partial_dependence(model, rows, NAMES, "size", 10).orderBy("point").collect()
    assert len(curve) == 10 and curve[-1]["mean_prediction"] > curve[0]["mean_prediction"] + 0.5
    with pytest.raises(ValueError):
        explain.partial_dependence(model, rows, NAMES, "other")


@pytest.mark.parametrize("kind", ["forest", "line"])
def test_permutation_importance_equals_scored_copies_without_copying_rows(rows, fitted, kind, monkeypatch):
    seen = []
    monkeypatch.setattr(explain, "rank_within", lambda df, *rest: seen.append(df) or rank_within(df, *rest))
    found = explain.permutation_importance(fitted[kind], rows, NAMES, ["id"])
    assert "Generate explode(sequence" not in _plan(found)
    numbered = rank_within(seen[0], [], ["__h", "id"], "__pos").select("id", "__pos")
    full = numbered.join(rows, "id").select("__pos", "label", vector_to_array("features").alias("x")).collect()
    place = {r["__pos"]: r for r in full}
    x, y = (np.array([place[i + 1][c] for i in range(600)]) for c in ("x", "label"))
    importance = {r["feature"]: r["importance"] for r in found.collect()}
    predict = fitted[kind].predict
    plain = np.mean([abs(predict(DenseVector(v)) - t) for v, t in zip(x, y)])
    for i, name in enumerate(NAMES):
        changed = x.copy()
        changed[:, i] = np.roll(x[:, i], 300)
        loss = np.mean([abs(predict(DenseVector(v)) - t) for v, t in zip(changed, y)])
        assert importance[name] == pytest.approx(loss - plain, abs=1e-9)


@pytest.mark.parametrize("kind", ["forest", "line"])
def test_attributions_equal_scored_steps_without_copying_rows(rows, fitted, kind):
    asked = rows.filter("id % 100 = 7")
    background = explain.background_rows(rows, ["id"], 3)
    values = explain.attributions(fitted[kind], asked, NAMES, ["id"], background, permutations=2)
    assert "Generate" not in _plan(values) and "Exchange" not in _plan(values)
    predict, draw = (lambda v: fitted[kind].predict(DenseVector(v))), random.Random(42)
    orders = [draw.sample(range(3), 3) for _ in range(3)]
    found = {(r["id"], r["feature"]): r["value"] for r in values.collect()}
    assert len(found) == 6 * 4
    for r in asked.collect():
        own = dict.fromkeys([*NAMES, "base_value"], 0.0)
        for order, other in zip(orders, background):
            at = list(other)
            own["base_value"] += predict(at) / 3
            for i in order:
                before, at[i] = predict(at), r["features"][i]
                own[NAMES[i]] += (predict(at) - before) / 3
        assert own == pytest.approx({f: found[r["id"], f] for f in own}, abs=1e-9)


def test_interaction_equals_scored_corners_without_copying_rows(rows, fitted):
    background = explain.background_rows(rows, ["id"], 3)
    asked = rows.filter("id % 100 = 7")
    found = explain.interaction_strength(fitted["forest"], asked, NAMES, ["id"], ("size", "age"), background)
    assert "Generate" not in _plan(found) and "Exchange" not in _plan(found)
    strength = {r["id"]: r["interaction"] for r in found.collect()}

    def predict(size, age, noise):
        return fitted["forest"].predict(DenseVector([size, age, noise]))

    for r in asked.collect():
        size, age, noise = r["features"]
        corners = [
            predict(size, age, noise) - predict(o[0], age, noise) - predict(size, o[1], noise) + predict(o[0], o[1], noise)
            for o in background
        ]
        assert strength[r["id"]] == pytest.approx(sum(corners) / 3, abs=1e-9)


def test_attributions_add_up(rows, model):
    asked = rows.filter("id % 50 = 0")
    background = explain.background_rows(rows, ["id"], 8)
    values = explain.attributions(model, asked, NAMES, ["id"], background, permutations=4)
    sums = {r["id"]: r["s"] for r in values.groupBy("id").agg(F.sum("value").alias("s")).collect()}
    expected = {r["id"]: r["prediction"] for r in model.transform(asked).select("id", "prediction").collect()}
    assert sums == pytest.approx(expected)
    assert values.filter("feature = 'base_value'").select(F.round("value", 9)).distinct().count() == 1
    wide = values.filter("feature <> 'base_value'").groupBy("id").pivot("feature", NAMES).agg(F.first("value"))
    factors = top_factors(wide, NAMES, k=1).collect()
    assert all(abs(r["value"]) > 0.01 and r["rank"] == 1 for r in factors)


def test_interaction_of_an_unused_feature_is_nothing(rows):
    additive = random_forest(numTrees=1, maxDepth=1, featureSubsetStrategy="all", bootstrap=False).fit(rows)
    background = explain.background_rows(rows, ["id"], 4)
    found = explain.interaction_strength(additive, rows.filter("id < 20"), NAMES, ["id"], ("size", "noise"), background)
    assert all(r["interaction"] == pytest.approx(0) for r in found.collect())


def test_cross_validation_and_backtest(rows):
    placed = chronological_position(rows, ["ts", "id"], "ts").persist()
    folds, summary = cross_validate(placed, fold_table(600, 3), random_forest(numTrees=5, maxDepth=5))
    assert [(r["fold"], r["train_size"], r["val_size"]) for r in folds.orderBy("fold").collect()] == [
        (0, 150, 150), (1, 300, 150), (2, 450, 150)
    ]
    assert {r["metric"] for r in summary.collect()} == {"mae", "rmse", "r2", "mape"}
    start = datetime(2020, 1, 1)
    scored = backtest(
        rows, "ts", start + timedelta(days=480), start + timedelta(days=560), random_forest(numTrees=3, maxDepth=4), keep=["id"]
    )
    counts = {r["period"]: r["count"] for r in scored.groupBy("period").count().collect()}
    assert counts == {0: 30, 1: 30, 2: 30}
    assert scored.filter("prediction is null").count() == 0


def test_random_search_is_seeded(rows):
    assert sample_params(5) == sample_params(5) != sample_params(5, seed=1)
    drawn = sample_params(200)
    assert all(0.01 <= p["stepSize"] <= 0.3 and 5 <= p["maxDepth"] <= 8 for p in drawn)
    best, trials = random_search(
        rows.filter("id < 450"), rows.filter("id >= 450"), 3, ranges={"n_estimators": (2, 5), "num_leaves": (4, 8)}
    )
    found = trials.orderBy("value").first()
    assert found["trial"] == [i for i, p in enumerate(sample_params(3, ranges={"n_estimators": (2, 5), "num_leaves": (4, 8)})) if p == best][0]


def test_search_history(spark):
    rows = [
        ("s", '{"trials": [{"value": 5.0}, {"value": 7.0}, {"value": 2.0}]}'),
        ("s", '{"trials": [{"value": 9.0}, {"value": null}, {"value": 4.0}]}'),
        ("t", '{"trials": []}'),
        (None, '{"trials": [{"value": 1.0}]}'),
        ("u", "broken"),
    ]
    df = spark.createDataFrame(rows, "s STRING, d STRING")
    found = {(r["s"], r["trial"], r["value"], r["best_so_far"]) for r in search_history(df, "s", "d").collect()}
    first = {("s", 0, 5.0, 5.0), ("s", 1, 7.0, 5.0), ("s", 2, 2.0, 2.0)}
    assert found == first | {("s", 0, 9.0, 9.0), ("s", 1, None, 9.0), ("s", 2, 4.0, 4.0), (None, 0, 1.0, 1.0)}


def test_scoring_keeps_rows_and_columns(spark, rows):
    payload = spark.createDataFrame(
        [("p1", 2200.0, 4, 2.5, 2010, None, True, None, 2, 8.0), ("p2", None, None, None, None, None, None, None, None, None)],
        "property_id STRING, square_feet DOUBLE, bedrooms INT, bathrooms DOUBLE, year_built INT, lot_size DOUBLE,"
        " pool BOOLEAN, fireplace BOOLEAN, garage_spaces INT, condition_score DOUBLE",
    )
    wide = rows.select("price", "label").withColumns({c: F.rand(1) for c in REQUEST_VECTOR})
    fitted = random_forest(numTrees=2, maxDepth=2).fit(assemble(wide, REQUEST_VECTOR))
    scored = scoring.score_requests(payload, fitted)
    assert scored.columns == [*payload.columns, "prediction"] and scored.count() == 2
    assert scored.filter("property_id = 'p1'").first()["square_feet"] == 2200
    interval = scoring.fixed_interval(scored).first()
    assert interval["lower"] == pytest.approx(interval["prediction"] * 0.85)


def test_predictions_are_prices(rows, model):
    row = predict_price(model, rows).select(F.min("prediction"), F.max("prediction")).first()
    assert row[0] > 1000 and row[1] < 10**6


def test_pca_is_centred_and_bounded(rows):
    fitted = fit_pca(rows, "features", "projected", 50)
    shares = fitted.stages[-1].explainedVariance.toArray()
    assert len(shares) == 3 and shares.sum() == pytest.approx(1)
    from pyspark.ml.functions import vector_to_array

    means = fitted.transform(rows).select(F.avg(vector_to_array("projected")[0])).first()[0]
    assert means == pytest.approx(0, abs=1e-6)


HOUSES = (
    "property_id BIGINT, sale_date TIMESTAMP_NTZ, price DOUBLE, square_feet DOUBLE, bedrooms INT, bathrooms DOUBLE,"
    " year_built INT, lot_size DOUBLE, zipcode STRING, pool BOOLEAN, condition_score DOUBLE"
)


@pytest.fixture(scope="module")
def houses(spark):
    start = datetime(2020, 1, 1)
    data = [
        (i, start + timedelta(days=i % 300), 90000.0 + 120 * (i * 37 % 1000), 500.0 + (i * 37 % 1000), 1 + i % 5, 1.5,
         1950 + i % 70, None if i % 9 == 0 else 4000.0, f"9{i % 4:04d}", i % 2 == 0, float(1 + i % 10))
        for i in range(500)
    ]
    return spark.createDataFrame(data, HOUSES)


def test_apply_does_not_look_at_the_applied_frame(houses):
    fit = FeatureFit().fit(houses.filter("property_id < 300"))
    alone = fit.apply(houses.filter("property_id = 400")).first()["features"]
    together = fit.apply(houses).filter("property_id = 400").first()["features"]
    assert alone == together
    repriced = fit.apply(houses.filter("property_id = 400").withColumn("price", F.lit(1.0))).first()["features"]
    assert repriced == alone


def test_training_rows_do_not_see_their_own_price(houses):
    fold = F.col("property_id") % 5

    def statistics(df):
        fit = FeatureFit()
        rows = fit.fit_training(df, fold)
        return rows, fit

    def features(df, wanted):
        rows, fit = statistics(df)
        found = rows.filter(wanted).withColumn("f", vector_to_array("features")).collect()
        at = [fit.columns.index(c) for c in ("price_mean", "price_median", "price_std")]
        return {r["property_id"]: [r["f"][k] * fit.scale.spread[fit.columns[k]] + fit.scale.center[fit.columns[k]] for k in at] for r in found}

    same_fold = F.col("property_id") % 5 == 2
    dear = houses.withColumn("price", F.when(same_fold, F.col("price") * 50).otherwise(F.col("price")))
    before, after = features(houses, same_fold), features(dear, same_fold)
    assert all(before[k] == pytest.approx(after[k], abs=0.02) for k in before)
    assert features(houses, ~same_fold) != features(dear, ~same_fold)
    # Later rows get the statistics of all training rows.
    whole = statistics(houses)[1].stats.table.collect()
    counted = {r["zipcode"]: r["price_mean"] for r in whole}
    for zipcode, mean in houses.groupBy("zipcode").agg(F.round(F.avg("price"), 2)).collect():
        assert counted[zipcode] == mean


def test_training_run_records_its_metrics(houses, spark, tmp_path):
    store = ModelStore(spark, str(tmp_path / "models"))
    settings = TrainingSettings(
        trials=2, folds=2, search={"n_estimators": (10, 15), "num_leaves": (8, 16), "learning_rate": (0.2, 0.3), "min_child_samples": (2, 5)},
        tracking_root=str(tmp_path / "tracking"), store=store, run_id="r1",
    )
    for _ in range(2):
        result = train(houses, settings)
    assert result.test_metrics.first()["r2"] > 0.5 and result.version == "v1"
    assert result.report.filter("check = 'range' and column = 'price'").first()["passed"]
    recorded = read_tracking(spark, str(tmp_path / "tracking"), "metrics").collect()
    assert sorted(r["key"] for r in recorded) == ["mae", "mape", "r2", "rmse"] and {r["run_id"] for r in recorded} == {"r1"}
    assert [tuple(r) for r in store.state().select("version", "stage", "run_id").collect()] == [("v1", "staging", "r1")]
    loaded = store.load("sale_price", "v1")
    rows = houses.limit(20)
    again = predict_price(loaded.model, loaded.features.apply(rows)).select("property_id", "prediction")
    direct = predict_price(result.model, result.features.apply(rows)).select("property_id", "prediction")
    assert sorted(again.collect()) == sorted(direct.collect())
    with pytest.raises(ValueError):
        store.load("sale_price")
    store.promote("sale_price", "v1")
    assert store.load("sale_price").run_id == "r1"


def test_artefacts_without_an_event_are_written_again(houses, spark, tmp_path):
    store = ModelStore(spark, str(tmp_path))
    fit = FeatureFit(components=2).fit(houses)
    rows = with_label(fit.apply(houses))
    first, second = (random_forest(numTrees=n, maxDepth=2).fit(rows) for n in (1, 3))
    # A run that stopped before its event.
    PipelineModel([first]).write().save(store._artefacts("m", "r"))
    assert store.state().count() == 0
    assert store.register("m", "r", second, {}, {"mae": 1.0}, fit) == "v1"
    assert store.register("m", "r", first, {}, {"mae": 2.0}) == "v1"
    loaded = store.load("m", "v1")
    assert loaded.model.stages[0].getNumTrees == 3
    assert loaded.features.apply(houses.limit(5)).select("projected").collect() == fit.apply(houses.limit(5)).select("projected").collect()


def test_backfill_repeats_without_change(houses, spark, tmp_path):
    root = str(tmp_path)
    early = houses.filter("sale_date < '2020-06-01 12:00:00'")
    n = backfill(early, root, "sale_date")
    assert n == early.count() and backfill(early, root, "sale_date") == 0
    once = load_features(spark, f"{root}/features")
    # A later row on the last day, a new day, and a late row of a closed day, which stays out.
    extra = houses.limit(1).withColumn("property_id", F.lit(900))
    later = houses.union(extra.withColumn("sale_date", F.lit("2020-06-01 23:00:00").cast("timestamp_ntz")))
    later = later.union(extra.withColumn("sale_date", F.lit("2020-02-01 23:00:00").cast("timestamp_ntz")))
    mark = mark_of(spark, root)
    assert mark == datetime(2020, 6, 1)
    assert backfill(later, root, "sale_date") == later.filter("sale_date >= '2020-06-01'").count()
    first = sorted(map(str, backfilled(spark, root).collect()))
    assert len(first) == houses.count() + 1 and load_features(spark, f"{root}/features").scale == once.scale
    # Rows written but the mark not moved: the next run writes the same rows.
    spark.range(1).select(F.lit(mark).cast("timestamp_ntz").alias("mark")).coalesce(1).write.mode("overwrite").parquet(f"{root}/mark/upto")
    assert backfill(later, root, "sale_date") > 0
    assert sorted(map(str, backfilled(spark, root).collect())) == first


def test_backfill_writes_a_day_from_one_task_unless_it_is_large(houses, spark, tmp_path, monkeypatch):
    def files(root):
        return [len(list(day.glob("*.parquet"))) for day in (tmp_path / root / "rows").glob("day=*")]

    many = houses.unionByName(houses.withColumn("property_id", F.col("property_id") + 10_000)).repartition(7)
    backfill(many, str(tmp_path / "a"), "sale_date")
    assert set(files("a")) == {1}
    monkeypatch.setattr(backfills, "TASK_ROWS", 5)
    day = many.withColumn("sale_date", F.lit("2020-06-01").cast("timestamp_ntz"))
    n = backfill(day, str(tmp_path / "b"), "sale_date")
    assert files("b")[0] > 1 and backfilled(spark, str(tmp_path / "b")).count() == n == many.count()
