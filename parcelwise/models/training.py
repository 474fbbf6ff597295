"""Complete training run: clean, derive, split, tune, cross-validate, fit, test, record, store, register."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.models.estimators import fit_early_stopping, gradient_boosting, evaluate, with_label
from parcelwise.models.evaluation import cross_validate
from parcelwise.models.store import ModelStore
from parcelwise.models.tuning import random_search
from parcelwise.operators.cleaning import fit_median_imputer, keep_first, trim_upper
from parcelwise.operators.encoding import FeatureFit
from parcelwise.operators.splits import chronological_position, fold_table, split_cuts
from parcelwise.operators.validation import validation_report
from parcelwise.scale import written
from parcelwise.sources.publish import append_tracking, metric_rows

METRICS = ("mae", "rmse", "r2", "mape")


@dataclass
class TrainingSettings:
    keys: tuple[str, ...] = ("property_id",)
    order: tuple[str, ...] = ("sale_date", "property_id")
    ts: str = "sale_date"
    scheme: str = "nested"
    folds: int = 5
    trials: int = 20
    search: dict[str, tuple[float, float]] = field(default_factory=dict)
    stat_folds: int = 5
    tracking_root: str | None = None
    store: ModelStore | None = None
    model_name: str = "sale_price"
    run_id: str = "run"


@dataclass
class TrainingResult:
    model: Model
    features: FeatureFit
    best_params: dict
    report: DataFrame
    trials: DataFrame
    fold_metrics: DataFrame
    fold_summary: DataFrame
    test_metrics: DataFrame
    version: str | None = None


def prepare(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, missing numbers imputed, the top percent of sizes and prices trimmed."""
    unique = keep_first(df, keys, order)
    cols = ["square_feet", "bedrooms", "bathrooms", "year_built", "lot_size", "condition_score", "price"]
    imputed = fit_median_imputer(unique, cols).apply(unique)
    return trim_upper(imputed, ["square_feet", "price"])


def train(df: DataFrame, settings: TrainingSettings) -> TrainingResult:
    s = settings
    report = validation_report(df, s.keys)
    rest = [c for c in s.order if c not in s.keys]
    clean = written(prepare(df, s.keys, rest), "clean")
    placed = written(with_label(chronological_position(clean, s.order, s.ts)), "placed")
    n = placed.count()
    val_at, test_at = split_cuts(n, s.scheme)
    at = F.col("position")

    fit = FeatureFit(exclude=("price", *s.keys, s.ts, "position", "fraction", "label", "created_at"))
    # Training rows get group statistics without their own fold; later rows get those of all training rows.
    kept = [*s.keys, s.ts, "position", "price", "label", "features"]
    fold = F.pmod(F.xxhash64(*s.order), F.lit(s.stat_folds))
    fitted = fit.fit_training(placed.filter(at < val_at), fold, s.stat_folds).select(*kept)
    ready = written(fitted.unionByName(fit.apply(placed.filter(at >= val_at)).select(*kept)), "features")
    # The scaled column replaces nothing here: price and label come from before scaling.
    train_rows, val_rows = ready.filter(at < val_at), ready.filter((at >= val_at) & (at < test_at))
    test_rows = ready.filter(at >= test_at)
    # The final model is one of Spark's learner; its draws decide between the trials too.
    best, trials = random_search(train_rows, val_rows, s.trials, ranges=s.search, max_rows=0)
    folds, summary = cross_validate(ready, fold_table(n, s.folds), gradient_boosting(**best))
    model = fit_early_stopping(gradient_boosting(early_stop=True, **best), train_rows, val_rows)
    tested = evaluate(model, test_rows)
    if s.tracking_root:
        stamped = tested.withColumns(
            {"run": F.lit(s.run_id), "at": F.unix_millis(F.current_timestamp()), "step": F.lit(0)}
        )
        append_tracking(
            metric_rows(stamped, "run", METRICS, "at", "step"), s.tracking_root, "metrics", s.run_id
        )
    version = None
    if s.store:
        found = tested.first()
        version = s.store.register(s.model_name, s.run_id, model, best, {m: found[m] for m in METRICS}, fit)
    return TrainingResult(model, fit, best, report, trials, folds, summary, tested, version)
