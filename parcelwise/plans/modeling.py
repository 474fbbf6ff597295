"""Splits, folds, training, scoring, intervals, explanations and the registry."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from parcelwise.functions.columns import sanitize
from parcelwise.functions.features import request_features
from parcelwise.models import explain
from parcelwise.models import scoring
from parcelwise.models.estimators import (
    compare_models,
    evaluate,
    fit_patient,
    fit_spread,
    gradient_boosting,
    importance_table,
    random_forest,
    with_label,
)
from parcelwise.models.evaluation import backtest, cross_validate
from parcelwise.models.training import TrainingSettings, train
from parcelwise.models.tuning import random_search, search_history
from parcelwise.operators import registry as reg
from parcelwise.operators import splits as sp
from parcelwise.operators.cleaning import domain_filter, keep_first
from parcelwise.operators.encoding import assemble
from parcelwise.plans.catalog import ID, ID_SQL, ORDER_SQL, PREDICTIONS, near, query, rnd, with_sales
from parcelwise.scale import written
from parcelwise.schemas import REQUEST_VECTOR
from parcelwise.sources.sample_tables import SALE_ORDER, prediction_log, sales, table

ORDER = ["sale_date", "property_id", "l_orderkey", "l_linenumber"]
SALE_KEY = ["property_id", "l_orderkey", "l_linenumber", "sale_date"]


def model_rows(spark, folder):
    """One assembled row per sale: key, date, price, label, features."""
    first = domain_filter(keep_first(sales(spark, folder), SALE_KEY, list(SALE_ORDER)))
    ready = sanitize(request_features(with_label(first)), REQUEST_VECTOR)
    rows = assemble(ready, REQUEST_VECTOR).select(*SALE_KEY, "price", "label", "features")
    return written(rows, "model-rows")


def explained_rows(rows):
    """The first sale of each property: the rows that are explained by a model of all sales."""
    return written(keep_first(rows, ["property_id"], list(SALE_ORDER)), "explained-rows")


def _by_date(rows):
    cut = F.lit("1996-01-01").cast("timestamp_ntz")
    return rows.filter(F.col("sale_date") < cut), rows.filter(F.col("sale_date") >= cut)


def _forest():
    return random_forest(numTrees=5, maxDepth=4)


# ---------------------------------------------------------------- splits and folds

SHARE_SQL = (
    "CAST(('0x' || substr(md5(concat_ws('|', CAST(property_id AS VARCHAR), CAST(l_orderkey AS VARCHAR), "
    "CAST(l_linenumber AS VARCHAR), CAST(sale_date AS VARCHAR), '42')), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE)"
)


@query(
    "m1_random_split",
    with_sales(
        f"""SELECT {ID_SQL}, CASE WHEN share < 0.7 THEN 'train' WHEN share < 0.8 THEN 'val' ELSE 'test' END AS split
            FROM (SELECT *, {SHARE_SQL} AS share FROM sales)"""
    ),
)
def m1(spark, folder):
    rows = sales(spark, folder).select(*ID)
    return sp.random_split(rows, ["property_id", "l_orderkey", "l_linenumber", "sale_date"])


PLACED = f"placed AS (SELECT *, row_number() OVER (ORDER BY {ORDER_SQL}) - 1 AS position, count(*) OVER () AS total FROM sales)"


@query(
    "m2_chronological_split",
    with_sales(
        f"""SELECT {ID_SQL}, position, CASE WHEN position < a THEN 'train' WHEN position < a + floor((total - a) * 0.5)
              THEN 'val' ELSE 'test' END AS split FROM (SELECT *, floor(total * 0.7) AS a FROM placed)""",
        PLACED,
    ),
)
def m2(spark, folder):
    rows = sp.chronological_split(sales(spark, folder).select(*ID), ORDER, "sale_date")
    return rows.select(*ID, "position", "split")


@query(
    "m2_nested_split",
    with_sales(
        """SELECT split, count(*) AS n, min(position) AS first_position, max(position) AS last_position FROM (
             SELECT position, CASE WHEN position < floor(b * 0.8) THEN 'train' WHEN position < b THEN 'val'
               ELSE 'test' END AS split FROM (SELECT *, floor(total * 0.8) AS b FROM placed)) GROUP BY split""",
        PLACED,
    ),
)
def m2_nested(spark, folder):
    rows = sp.chronological_split(sales(spark, folder).select(*ID), ORDER, "sale_date", "nested")
    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("position").alias("first_position"),
        F.max("position").alias("last_position"),
    )


def _placed(spark, folder):
    return sp.chronological_position(sales(spark, folder).select(*ID, "price"), ORDER, "sale_date")


@query(
    "m3_time_series_folds",
    with_sales(
        f"""SELECT CAST(fold AS INTEGER) AS fold, role, count(*) AS n, min(position) AS first_position,
              max(position) AS last_position, {rnd("avg(price)")} AS price_mean
            FROM (SELECT fold, position, price, CASE WHEN position < start - 50 THEN 'train'
                    WHEN position >= start AND position < start + size THEN 'val' END AS role
                  FROM (SELECT *, total // 6 AS size, total - (5 - fold) * (total // 6) AS start
                        FROM placed, (SELECT unnest(range(5)) AS fold)))
            WHERE role IS NOT NULL GROUP BY fold, role""",
        PLACED,
    ),
)
def m3(spark, folder):
    placed = _placed(spark, folder)
    folds = sp.fold_table(placed.count(), splits=5, gap=50)
    return (
        sp.assign_folds(placed, folds)
        .groupBy("fold", "role")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("position").alias("first_position"),
            F.max("position").alias("last_position"),
            near(F.avg("price")).alias("price_mean"),
        )
    )


@query(
    "m4_expanding_windows",
    with_sales(
        f"""SELECT w AS "window", 1000 + w * 100 AS train_rows, count(*) AS n_val, {rnd("avg(price)")} AS price_mean
            FROM placed JOIN (SELECT unnest(range(CAST(ceil((total - 1000) / 100.0) AS BIGINT))) AS w
                              FROM (SELECT count(*) AS total FROM sales))
              ON position >= 1000 + w * 100 AND position < 1200 + w * 100
            GROUP BY w""",
        PLACED,
    ),
)
def m4(spark, folder):
    rows = sp.expanding_windows(_placed(spark, folder))
    return rows.groupBy("window", "train_rows").agg(
        F.count(F.lit(1)).alias("n_val"), near(F.avg("price")).alias("price_mean")
    )


BACKTEST = (datetime(1998, 1, 1), datetime(2001, 6, 30))
DAYS_SQL = "date_diff('day', TIMESTAMP '1998-01-01', sale_date)"


@query(
    "m5_backtest_periods",
    with_sales(
        f"""SELECT CAST(p AS INTEGER) AS period, TIMESTAMP '1998-01-01' + to_days(CAST(p * 30 AS INTEGER)) AS period_start,
              TIMESTAMP '1998-01-01' + to_days(CAST(p * 30 + 30 AS INTEGER)) AS period_end,
              (SELECT count(*) FROM sales WHERE {DAYS_SQL} < p * 30) AS n_train,
              (SELECT count(*) FROM sales WHERE {DAYS_SQL} >= p * 30 AND {DAYS_SQL} < p * 30 + 30) AS n_test
            FROM (SELECT unnest(range({(BACKTEST[1] - BACKTEST[0]).days // 30 + 1})) AS p)
            WHERE n_train > 100 AND n_test > 0"""
    ),
)
def m5(spark, folder):
    return sp.backtest_periods(sales(spark, folder), "sale_date", *BACKTEST)


@query("m5_backtest_predictions")
def m5_predictions(spark, folder):
    rows = model_rows(spark, folder)
    start, end = datetime(1996, 1, 1), datetime(1996, 5, 1)
    return backtest(rows, "sale_date", start, end, _forest(), keep=[c for c in SALE_KEY if c != "sale_date"])


# ---------------------------------------------------------------- training


@query("m6_gradient_boosting")
def m6(spark, folder):
    train_rows, val_rows = _by_date(model_rows(spark, folder))
    model = fit_patient(gradient_boosting(maxIter=1000, maxDepth=8), train_rows, val_rows)
    return evaluate(model, val_rows)


@query("m7_random_forest")
def m7(spark, folder):
    train_rows, test_rows = _by_date(model_rows(spark, folder))
    return evaluate(fit_spread(_forest(), train_rows), test_rows)


SMALL_SEARCH = {"num_leaves": (4, 16), "n_estimators": (3, 6)}


@query("m9_random_search")
def m9(spark, folder):
    train_rows, val_rows = _by_date(model_rows(spark, folder))
    return random_search(train_rows, val_rows)[1]


@query("m10_cross_validation")
def m10(spark, folder):
    placed = written(sp.chronological_position(model_rows(spark, folder), ORDER, "sale_date"), "cv")
    return cross_validate(placed, sp.fold_table(placed.count(), 5), _forest())[1]


@query("m11_batch_scoring")
def m11(spark, folder):
    model = fit_spread(_forest(), model_rows(spark, folder))
    return scoring.score_requests(sales(spark, folder), model).select(*ID, "prediction")


@query("m16_impurity_importance")
def m16(spark, folder):
    rows = model_rows(spark, folder)
    return importance_table(fit_spread(_forest(), rows), rows, REQUEST_VECTOR)


@query("m17_permutation_importance")
def m17(spark, folder):
    rows = model_rows(spark, folder)
    return explain.permutation_importance(fit_spread(_forest(), rows), rows, REQUEST_VECTOR, SALE_KEY)


@query("m18_partial_dependence")
def m18(spark, folder):
    rows = model_rows(spark, folder)
    return explain.partial_dependence(fit_spread(_forest(), rows), rows, REQUEST_VECTOR, "square_feet")


@query("m19_attributions")
def m19(spark, folder):
    rows = model_rows(spark, folder)
    background = explain.background_rows(rows, SALE_KEY, 20)
    return explain.attributions(
        fit_spread(_forest(), rows), explained_rows(rows), REQUEST_VECTOR, ["property_id"], background, permutations=2
    )


@query("m20_interaction_strength")
def m20(spark, folder):
    rows = model_rows(spark, folder)
    background = explain.background_rows(rows, SALE_KEY, 20)
    pair = ("square_feet", "condition_score")
    return explain.interaction_strength(
        fit_spread(_forest(), rows), explained_rows(rows), REQUEST_VECTOR, ["property_id"], pair, background
    )


@query("m21_model_comparison")
def m21(spark, folder):
    train_rows, test_rows = _by_date(model_rows(spark, folder))
    models = {"boosted": gradient_boosting(maxIter=500), "forest": random_forest(numTrees=200)}
    return compare_models(models, train_rows, test_rows)


@query("m24_training_run")
def m24(spark, folder):
    settings = TrainingSettings(trials=2, folds=2, search=SMALL_SEARCH)
    rows = sales(spark, folder).drop("l_orderkey", "l_linenumber")
    return train(rows, settings).test_metrics


# ---------------------------------------------------------------- intervals and ensembles


@query(
    "m12_fixed_interval",
    f"""WITH {PREDICTIONS} SELECT request_id, {rnd("prediction * 0.85")} AS lower, {rnd("prediction * 1.15")} AS upper
        FROM predictions""",
)
def m12(spark, folder):
    rows = scoring.fixed_interval(prediction_log(spark, folder))
    return rows.select("request_id", near("lower").alias("lower"), near("upper").alias("upper"))


M13_POINTS = ", ".join(f"{i / 10}" for i in range(1, 10))


@query(
    "m13_residual_interval",
    f"""WITH {PREDICTIONS}, known AS (SELECT * FROM predictions WHERE actual IS NOT NULL),
        edges AS (SELECT list_distinct(quantile_cont(prediction, [{M13_POINTS}])) AS e FROM known),
        placed AS (SELECT *, list_sum([CASE WHEN prediction > x THEN 1 ELSE 0 END for x in e]) AS bin FROM predictions, edges),
        offsets AS (SELECT bin, quantile_cont(actual - prediction, 0.025) AS lo, quantile_cont(actual - prediction, 0.975) AS hi
                    FROM placed WHERE actual IS NOT NULL GROUP BY bin)
        SELECT request_id, {rnd("prediction + lo")} AS lower, {rnd("prediction + hi")} AS upper
        FROM placed JOIN offsets USING (bin)""",
)
def m13(spark, folder):
    log = prediction_log(spark, folder)
    fit = scoring.fit_residual_interval(log.filter(F.col("actual").isNotNull()))
    return fit.apply(log).select("request_id", near("lower").alias("lower"), near("upper").alias("upper"))


MEMBERS = {"m1": 2.0, "m2": 1.0, "m3": 1.0}
MEMBER_SQL = """members AS (SELECT *, price * CAST(1.02 AS DOUBLE) AS m1, square_feet * 40 AS m2,
  CAST(50000 + 100 * (year_built - 1950) AS DOUBLE) AS m3 FROM sales)"""


def _members(spark, folder):
    return sales(spark, folder).withColumns(
        {
            "m1": F.col("price") * 1.02,
            "m2": F.col("square_feet") * 40,
            "m3": (F.lit(50000) + F.lit(100) * (F.col("year_built") - 1950)).cast("double"),
        }
    )


@query(
    "m14_weighted_ensemble",
    with_sales(f"SELECT {ID_SQL}, {rnd('(2 * m1 + m2 + m3) / 4')} AS ensemble FROM members", MEMBER_SQL),
)
def m14(spark, folder):
    rows = scoring.ensemble(_members(spark, folder), MEMBERS)
    return rows.select(*ID, near("ensemble").alias("ensemble"))


@query(
    "m14_ensemble_of_rows",
    with_sales(
        f"""SELECT member_rows.row_id, {rnd("sum(weight * prediction) / sum(weight)")} AS ensemble,
              {rnd("var_pop(prediction) / 1e6")} AS variance_1e6
            FROM (SELECT row_id, 'm1' AS member, m1 AS prediction FROM keyed UNION ALL SELECT row_id, 'm2', m2 FROM keyed
                  UNION ALL SELECT row_id, 'm3', m3 FROM keyed) member_rows
            JOIN (SELECT 'm1' AS member, CAST(0.5 AS DOUBLE) AS weight UNION ALL SELECT 'm2', 0.25
                  UNION ALL SELECT 'm3', 0.25) USING (member)
            GROUP BY member_rows.row_id""",
        MEMBER_SQL,
        "keyed AS (SELECT *, property_id || '/' || l_orderkey || '/' || l_linenumber || '/' || CAST(sale_date AS DATE) AS row_id FROM members)",
    ),
)
def m14_rows(spark, folder):
    row_id = F.concat_ws("/", "property_id", "l_orderkey", "l_linenumber", F.to_date("sale_date")).alias("row_id")
    long = _members(spark, folder).select(row_id, "m1", "m2", "m3").unpivot(
        ["row_id"], ["m1", "m2", "m3"], "member", "prediction"
    )
    weights = scoring.normalized_weights(list(MEMBERS.values()))
    table_of_weights = spark.createDataFrame(list(zip(MEMBERS, weights)), "member STRING, weight DOUBLE")
    rows = scoring.ensemble_long(long, table_of_weights)
    return rows.select("row_id", near("ensemble").alias("ensemble"), near(F.col("variance") / 1e6).alias("variance_1e6"))


PLAIN = "((m1 + m2 + m3) / 3)"
VARIANCE = f"(((m1 - {PLAIN}) * (m1 - {PLAIN}) + (m2 - {PLAIN}) * (m2 - {PLAIN}) + (m3 - {PLAIN}) * (m3 - {PLAIN})) / 3)"


@query(
    "m15_ensemble_spread",
    with_sales(
        f"""SELECT {ID_SQL}, {rnd(f"{VARIANCE} / 1e6")} AS variance_1e6, {rnd(f"sqrt({VARIANCE})")} AS std,
              {rnd(f"(2 * m1 + m2 + m3) / 4 - 1.96 * sqrt({VARIANCE})", 3)} AS lower,
              {rnd(f"(2 * m1 + m2 + m3) / 4 + 1.96 * sqrt({VARIANCE})", 3)} AS upper FROM members""",
        MEMBER_SQL,
    ),
)
def m15(spark, folder):
    rows = scoring.ensemble(_members(spark, folder), MEMBERS)
    return rows.select(
        *ID,
        near(F.col("variance") / 1e6).alias("variance_1e6"),
        near("std").alias("std"),
        near("lower", 3).alias("lower"),
        near("upper", 3).alias("upper"),
    )


# ---------------------------------------------------------------- search history and registry


@query(
    "m22_search_history",
    """SELECT o_orderkey, CAST(t AS INTEGER) AS trial, v[t + 1] AS value, list_min(v[1:t + 1]) AS best_so_far FROM (
         SELECT o_orderkey, [o_totalprice, CAST(o_custkey AS DOUBLE), CAST(o_orderkey % 97 AS DOUBLE)] AS v, unnest(range(3)) AS t
         FROM orders)""",
)
def m22(spark, folder):
    values = [F.col("o_totalprice"), F.col("o_custkey").cast("double"), (F.col("o_orderkey") % 97).cast("double")]
    trials = F.array(*[F.struct(v.alias("value")) for v in values])
    studies = table(spark, folder, "orders").select(
        "o_orderkey", F.to_json(F.struct(trials.alias("trials"))).alias("document")
    )
    return search_history(studies, "o_orderkey", "document")


REGISTRY_SQL = """registry AS (
    SELECT 'model_' || CAST(user_id % 20 AS VARCHAR) AS model_name, ts AS event_ts, event_id,
           CASE event_type WHEN 'purchase' THEN 'register' ELSE 'promote' END AS action,
           CASE WHEN event_type = 'click' THEN 'v' || CAST(1 + event_id % 40 AS VARCHAR) END AS version, props AS params
    FROM events WHERE event_type IN ('purchase', 'click')),
  versions AS (SELECT model_name, row_number() OVER (PARTITION BY model_name ORDER BY event_ts, event_id) AS number,
                      substr(sha256(params), 1, 16) AS hash, event_ts AS created_at
               FROM registry WHERE action = 'register'),
  promotions AS (SELECT r.model_name, r.version, v.number, r.event_ts, r.event_id FROM registry r JOIN versions v
                   ON v.model_name = r.model_name AND 'v' || CAST(v.number AS VARCHAR) = r.version
                   WHERE r.action = 'promote' AND r.event_ts >= v.created_at),
  current AS (SELECT model_name, number FROM promotions
              QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY event_ts DESC, event_id DESC) = 1),
  state AS (SELECT v.model_name, v.number, 'v' || CAST(v.number AS VARCHAR) AS version, v.hash, v.created_at,
                   p.promoted_at, CASE WHEN c.number IS NOT NULL THEN 'production'
                     WHEN p.promoted_at IS NOT NULL THEN 'archived' ELSE 'staging' END AS stage
            FROM versions v
            LEFT JOIN (SELECT model_name, number, max(event_ts) AS promoted_at FROM promotions GROUP BY ALL) p
              ON p.model_name = v.model_name AND p.number = v.number
            LEFT JOIN current c ON c.model_name = v.model_name AND c.number = v.number)"""


def _registry_events(spark, folder):
    kind = F.col("event_type")
    return (
        table(spark, folder, "events")
        .filter(kind.isin("purchase", "click"))
        .select(
            F.concat(F.lit("model_"), (F.col("user_id") % 20).cast("string")).alias("model_name"),
            F.col("ts").alias("event_ts"),
            "event_id",
            F.when(kind == "purchase", "register").otherwise("promote").alias("action"),
            F.when(kind == "click", F.concat(F.lit("v"), (F.lit(1) + F.col("event_id") % 40).cast("string"))).alias(
                "version"
            ),
            F.col("props").alias("params"),
        )
    )


@query("m23_registry_state", f"WITH {REGISTRY_SQL} SELECT * FROM state")
def m23(spark, folder):
    return reg.registry_state(_registry_events(spark, folder))


@query(
    "m23_rollback_targets",
    f"""WITH {REGISTRY_SQL} SELECT s.model_name, s.number, s.version, s.hash FROM state s
        JOIN state p ON p.model_name = s.model_name AND p.stage = 'production' AND s.number = p.number - 1""",
)
def m23_rollback(spark, folder):
    return reg.rollback_targets(reg.registry_state(_registry_events(spark, folder)))
