"""Model operators on models that SQL can solve: one-feature least squares and one-split trees.

They run the same operators as the queries on full-size models in `modeling`, and their results can
be compared number by number."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.models import explain
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
from parcelwise.models.store import ModelStore
from parcelwise.operators import splits as sp
from parcelwise.operators.encoding import assemble
from parcelwise.plans.aggregates import METRIC_COLUMNS, METRIC_DIGITS, METRIC_SQL, _rounded
from parcelwise.plans.catalog import ID, ID_SQL, near, query, rnd, with_sales
from parcelwise.plans.modeling import BACKTEST, DAYS_SQL, ORDER, PLACED, SHARE_SQL
from parcelwise.scale import fresh_path, written
from parcelwise.sources.sample_tables import sales

KEY = ["property_id", "l_orderkey", "l_linenumber", "sale_date"]
CUT = "1996-01-01"
PAST = f"sale_date < TIMESTAMP '{CUT}'"
XY = "xy AS (SELECT *, ln(1 + square_feet) AS x, ln(1 + price) AS y FROM sales)"
LINE = "line AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM xy)"


def _linear() -> LinearRegression:
    return LinearRegression(featuresCol="features", labelCol="label", solver="normal")


def _rows(spark, folder, cols=("log_sqft",)):
    df = with_label(sales(spark, folder)).withColumns(
        {
            "log_sqft": F.log1p("square_feet"),
            "pool": F.col("pool").cast("double"),
            "fireplace": F.col("fireplace").cast("double"),
        }
    )
    return written(assemble(df, cols).select(*ID, "price", "label", "features"), "solvable-rows")


def _near(*names):
    return [near(m, METRIC_DIGITS.get(m, 4)).alias(m) for m in names]


def _by_date(rows):
    past = F.col("sale_date") < F.lit(CUT).cast("timestamp_ntz")
    return rows.filter(past), rows.filter(~past)


@query(
    "m11_linear_scores",
    with_sales(f"SELECT {ID_SQL}, {rnd('exp(a + b * x) - 1', 2)} AS prediction FROM xy, line", XY, LINE),
)
def linear_scores(spark, folder):
    rows = _rows(spark, folder)
    return predict_price(_linear().fit(rows), rows).select(*ID, near("prediction", 2).alias("prediction"))


@query(
    "m5_linear_backtest",
    with_sales(
        f"""SELECT period, {ID_SQL}, {rnd('exp(a + b * x) - 1', 2)} AS prediction FROM (
              SELECT CAST(p AS INTEGER) AS period, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, count(*) AS n
              FROM xy JOIN (SELECT unnest(range({(BACKTEST[1] - BACKTEST[0]).days // 30 + 1})) AS p)
                ON {DAYS_SQL} < p * 30 GROUP BY p HAVING count(*) > 100)
            JOIN xy ON {DAYS_SQL} >= period * 30 AND {DAYS_SQL} < period * 30 + 30""",
        XY,
    ),
)
def linear_backtest(spark, folder):
    found = backtest(_rows(spark, folder), "sale_date", *BACKTEST, _linear(), keep=["price", *[c for c in KEY if c != "sale_date"]])
    return found.select("period", *ID, near("prediction", 2).alias("prediction"))


STUMP = "stump AS (SELECT pool, avg(y) AS p FROM xy WHERE {} GROUP BY pool)"
STUMP_KNOWN = f"""known AS (SELECT exp(p) - 1 AS prediction, price AS actual
  FROM xy JOIN stump USING (pool) WHERE NOT ({PAST}))"""


@query("m6_boosted_stump", with_sales(f"SELECT {METRIC_COLUMNS} FROM known", XY, STUMP.format(PAST), STUMP_KNOWN))
def boosted_stump(spark, folder):
    """One round with early stopping: the first tree of a boosted model is taken whole."""
    past, later = _by_date(_rows(spark, folder, ["pool"]))
    model = fit_early_stopping(gradient_boosting(True, maxIter=1, maxDepth=1, subsamplingRate=1.0), past, later)
    return _rounded(evaluate(model, later))


@query("m7_forest_stump", with_sales(f"SELECT {METRIC_COLUMNS} FROM known", XY, STUMP.format(PAST), STUMP_KNOWN))
def forest_stump(spark, folder):
    past, later = _by_date(_rows(spark, folder, ["pool"]))
    one = random_forest(numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all")
    return _rounded(evaluate(one.fit(past), later))


@query(
    "m16_stump_importance",
    with_sales(
        """SELECT feature, CAST(gain = max(gain) OVER () AS DOUBLE) AS importance FROM (
             SELECT 'pool' AS feature, sum(n * (m - g) ** 2) AS gain
             FROM (SELECT count(*) AS n, avg(y) AS m FROM xy GROUP BY pool), (SELECT avg(y) AS g FROM xy)
             UNION ALL SELECT 'fireplace', sum(n * (m - g) ** 2)
             FROM (SELECT count(*) AS n, avg(y) AS m FROM xy GROUP BY fireplace), (SELECT avg(y) AS g FROM xy))""",
        XY,
    ),
)
def stump_importance(spark, folder):
    rows = _rows(spark, folder, ["pool", "fireplace"])
    one = random_forest(numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all")
    return importance_table(one.fit(rows), rows, ["pool", "fireplace"])


@query(
    "m10_linear_folds",
    with_sales(
        f"""SELECT CAST(fold AS INTEGER) AS fold, start AS train_size, size AS val_size,
              {", ".join(f"{METRIC_SQL[m]} AS {m}" for m in ("mae", "rmse", "r2", "mape"))}
            FROM (SELECT fold, start, size, price AS actual, exp(a + b * x) - 1 AS prediction
                  FROM (SELECT fold, start, size, regr_slope(y, x) AS b, regr_intercept(y, x) AS a
                        FROM folds JOIN xy ON position < start GROUP BY ALL)
                  JOIN xy ON position >= start AND position < start + size)
            GROUP BY ALL""",
        PLACED,
        XY.replace("FROM sales", "FROM placed"),
        """folds AS (SELECT fold, total // 6 AS size, total - (5 - fold) * (total // 6) AS start
             FROM (SELECT count(*) AS total FROM sales), (SELECT unnest(range(5)) AS fold))""",
    ),
)
def linear_folds(spark, folder):
    placed = sp.chronological_position(_rows(spark, folder), ORDER, "sale_date")
    placed = written(placed, "linear-folds")
    found = cross_validate(placed, sp.fold_table(placed.count(), 5), _linear())[0]
    return found.select("fold", "train_size", "val_size", *_near("mae", "rmse", "r2", "mape"))


@query(
    "m18_linear_dependence",
    with_sales(
        f"""SELECT CAST(i AS INTEGER) AS point, {rnd('low + i * (high - low) / 49', 6)} AS grid_value,
              {rnd('a + b * (low + i * (high - low) / 49)', 6)} AS mean_prediction
            FROM (SELECT min(x) AS low, max(x) AS high FROM xy), line, (SELECT unnest(range(50)) AS i)""",
        XY,
        LINE,
    ),
)
def linear_dependence(spark, folder):
    rows = _rows(spark, folder)
    found = explain.partial_dependence(_linear().fit(rows), rows, ["log_sqft"], "log_sqft")
    return found.select(
        "point", near("grid_value", 6).alias("grid_value"), near("mean_prediction", 6).alias("mean_prediction")
    )


HASHED = f"hashed AS (SELECT *, {SHARE_SQL} AS h FROM xy)"
BACKGROUND = 20


@query(
    "m19_linear_attributions",
    with_sales(
        f"""SELECT {ID_SQL}, 'log_sqft' AS feature, {rnd('b * (x - mean)', 6)} AS "value" FROM xy, line, base
            UNION ALL SELECT {ID_SQL}, 'base_value', {rnd('a + b * mean', 6)} FROM xy, line, base""",
        XY,
        LINE,
        HASHED,
        f"base AS (SELECT avg(x) AS mean FROM (SELECT x FROM hashed ORDER BY h LIMIT {BACKGROUND}))",
    ),
)
def linear_attributions(spark, folder):
    rows = _rows(spark, folder)
    background = explain.background_rows(rows, KEY, BACKGROUND)
    found = explain.attributions(_linear().fit(rows), rows, ["log_sqft"], KEY, background)
    return found.withColumn("value", near("value", 6))


@query(
    "m19_mean_attribution",
    with_sales(
        f"""SELECT 'log_sqft' AS feature, {rnd('avg(abs(b * (x - mean)))', 6)} AS importance FROM xy, line, base""",
        XY,
        LINE,
        HASHED,
        f"base AS (SELECT avg(x) AS mean FROM (SELECT x FROM hashed ORDER BY h LIMIT {BACKGROUND}))",
    ),
)
def mean_attribution(spark, folder):
    rows = _rows(spark, folder)
    background = explain.background_rows(rows, KEY, BACKGROUND)
    found = explain.attributions(_linear().fit(rows), rows, ["log_sqft"], KEY, background)
    ranking = explain.mean_attribution(found)
    return ranking.withColumn("importance", near("importance", 6))


@query(
    "m20_linear_interaction",
    with_sales(f"SELECT {ID_SQL}, CAST(0 AS DOUBLE) AS interaction FROM sales"),
)
def linear_interaction(spark, folder):
    """A linear model has no interactions."""
    names = ["log_sqft", "pool"]
    rows = _rows(spark, folder, names)
    background = explain.background_rows(rows, KEY, BACKGROUND)
    found = explain.interaction_strength(_linear().fit(rows), rows, names, KEY, ("log_sqft", "pool"), background)
    return found.withColumn("interaction", F.round(F.abs("interaction"), 6))


@query(
    "m17_linear_permutation",
    with_sales(
        f"""SELECT 'log_sqft' AS feature, {rnd('avg(abs(a + b * d.x - r.y)) - avg(abs(a + b * r.x - r.y))', 6)} AS importance
            FROM line, ranked r JOIN ranked d ON d.pos = (r.pos - 1 + r.n // 2) % r.n + 1""",
        XY,
        LINE,
        HASHED,
        """ranked AS (SELECT x, y, row_number() OVER (ORDER BY h, property_id, l_orderkey, l_linenumber, sale_date) AS pos,
             count(*) OVER () AS n FROM hashed)""",
    ),
)
def linear_permutation(spark, folder):
    rows = _rows(spark, folder)
    found = explain.permutation_importance(_linear().fit(rows), rows, ["log_sqft"], KEY)
    return found.withColumn("importance", near("importance", 6))


@query(
    "m21_linear_comparison",
    with_sales(
        f"""SELECT model, {", ".join(f"{METRIC_SQL[m]} AS {m}" for m in ("mae", "rmse", "r2"))} FROM (
              SELECT 'line' AS model, exp(a + b * x) - 1 AS prediction, price AS actual FROM xy, past WHERE NOT ({PAST})
              UNION ALL SELECT 'mean', exp(m) - 1, price FROM xy, past WHERE NOT ({PAST})) GROUP BY model""",
        XY,
        f"past AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, avg(y) AS m FROM xy WHERE {PAST})",
    ),
)
def linear_comparison(spark, folder):
    past, later = _by_date(_rows(spark, folder))
    flat = _linear().setRegParam(1e9)
    found = compare_models({"line": _linear(), "mean": flat}, past, later)
    return found.select("model", *_near("mae", "rmse", "r2"))


def _line_metrics_sql(version: str, stage: str, run: str, where: str) -> str:
    return f"""SELECT '{version}' AS version, '{stage}' AS stage, '{run}' AS run_id, {METRIC_COLUMNS} FROM (
      SELECT exp(a + b * x) - 1 AS prediction, price AS actual FROM xy,
        (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM xy WHERE {where}) WHERE NOT ({PAST}))"""


@query(
    "m24_registered_version",
    with_sales(
        _line_metrics_sql("v1", "archived", "past", PAST)
        + " UNION ALL "
        + _line_metrics_sql("v2", "production", "all", "true"),
        XY,
    ),
)
def registered_version(spark, folder):
    """Two runs are stored and registered, one of them twice; both versions are read back and score later sales."""
    rows = _rows(spark, folder)
    past, later = _by_date(rows)
    store = ModelStore(spark, fresh_path(spark, "models"))
    for run, known in (("past", past), ("all", rows), ("past", past)):
        store.register("line", run, _linear().fit(known), {"run": run}, {})
    for version in ("v1", "v2"):
        store.promote("line", version)
    scored = []
    for row in store.state().select("version", "stage").collect():
        loaded = store.load("line", row["version"])
        metrics = _rounded(evaluate(loaded.model, later))
        named = {"version": row["version"], "stage": row["stage"], "run_id": loaded.run_id}
        scored.append(metrics.select(*[F.lit(v).alias(c) for c, v in named.items()], *metrics.columns))
    return reduce(DataFrame.unionByName, scored)
