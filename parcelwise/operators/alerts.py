"""Rates, bucket quantiles, alert conditions and triggers over request logs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from parcelwise.operators.metrics import metric_columns
from parcelwise.operators.ordering import day_number, rank_within, running_sum
from parcelwise.scale import MAX_GROUP_ROWS
from parcelwise.schemas import LATENCY_BOUNDS, THRESHOLDS


def sliding(
    df: DataFrame, keys: Sequence[str], ts: str, aggs: dict[str, Column], size: str, slide: str
) -> DataFrame:
    """Counts per sliding window. Rows are first counted per slide, so only the counts are repeated."""
    panes = df.groupBy(*keys, F.window(ts, slide).alias("__pane")).agg(*[a.alias(n) for n, a in aggs.items()])
    start = F.col("__pane.start").alias("__at")
    spread = panes.select(*keys, start, *aggs)
    grouped = spread.groupBy(*keys, F.window("__at", size, slide).alias("__window"))
    return grouped.agg(*[F.sum(n).alias(n) for n in aggs]).select(
        *keys, F.col("__window.start").alias("window_start"), F.col("__window.end").alias("window_end"), *aggs
    )


def request_rate(
    df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", minutes: int = 5, slide: int = 1
) -> DataFrame:
    """Requests per second over sliding windows."""
    counts = sliding(df, keys, ts, {"n": F.count(F.lit(1))}, f"{minutes} minutes", f"{slide} minutes")
    return counts.withColumn("rate", F.col("n") / (minutes * 60))


def error_ratio(
    df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", minutes: int = 5, slide: int = 1, limit: float = 0.05
) -> DataFrame:
    """Share of 5xx responses per sliding window and whether it exceeds `limit`."""
    counts = sliding(
        df,
        keys,
        ts,
        {"n": F.count(F.lit(1)), "errors": F.count_if(F.col("status").between(500, 599))},
        f"{minutes} minutes",
        f"{slide} minutes",
    )
    ratio = F.try_divide(F.col("errors").cast("double"), F.col("n"))
    return counts.withColumn("error_ratio", ratio).withColumn("breached", ratio > limit)


def bucket_quantile(histogram: DataFrame, keys: Sequence[str], q: float) -> DataFrame:
    """Quantile from cumulative bucket counts (`le`, `cumulative`, `n`), linear inside the bucket.

    A quantile in the last, unbounded bucket is reported as the highest finite bound."""
    w = Window.partitionBy(*keys).orderBy("le")
    below, low = F.lag("cumulative", 1, 0).over(w), F.lag("le", 1, 0.0).over(w)
    steps = histogram.withColumns({"__below": below, "__low": low}).filter(F.col("n") > 0)
    rank = F.lit(q) * F.col("n")
    inside = F.col("__low") + (F.col("le") - F.col("__low")) * F.try_divide(
        rank - F.col("__below"), F.col("cumulative") - F.col("__below")
    )
    value = F.when(F.col("le") == float("inf"), F.col("__low")).otherwise(F.coalesce(inside, F.col("le")))
    return (
        steps.filter(F.col("cumulative") >= rank)
        .groupBy(*keys)
        .agg(F.min_by(value, F.col("le")).alias("quantile"), F.max("n").alias("n"))
    )


def cumulative_quantile(cumulative: Column, bounds: Sequence[float], q: float) -> Column:
    """The same quantile from an array of cumulative counts, one per bound and one for all, of a single row."""
    n = cumulative[len(bounds)]
    rank = F.lit(q) * n
    found = []
    for i, bound in enumerate(bounds):
        below, low = (cumulative[i - 1], float(bounds[i - 1])) if i else (F.lit(0), 0.0)
        inside = F.lit(low) + (F.lit(float(bound)) - low) * F.try_divide(rank - below, cumulative[i] - below)
        found.append(F.when(cumulative[i] >= rank, F.coalesce(inside, F.lit(float(bound)))))
    return F.when(n > 0, F.coalesce(*found, F.lit(float(bounds[-1]))))


def windowed_buckets(
    df: DataFrame, ts: str, value: Column, bounds: Sequence[float] = LATENCY_BOUNDS, minutes: int = 5, slide: int = 1
) -> DataFrame:
    """Cumulative latency buckets per sliding window in long form."""
    aggs = {f"b{i}": F.count_if(value <= b) for i, b in enumerate(bounds)}
    aggs["n"] = F.count(value)
    counts = sliding(df, [], ts, aggs, f"{minutes} minutes", f"{slide} minutes")
    entries = [F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").alias("cumulative")) for i, b in enumerate(bounds)]
    entries.append(F.struct(F.lit(float("inf")).alias("le"), F.col("n").alias("cumulative")))
    return counts.select("window_start", "n", F.inline(F.array(*entries)))


def firing(
    conditions: DataFrame,
    rule: str,
    ts: str,
    holds: Column,
    step: int | Column,
    lasting: int | Column,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Stretches in which a condition holds at every evaluation for at least `lasting` seconds.

    `step` is the evaluation interval in seconds; a missing evaluation ends the stretch. Both may depend on
    the rule. Ticks are ranked per rule and day, so a rule with a long history is not one task."""
    step = (F.lit(step) if isinstance(step, int) else step).cast("long")
    tick = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (step * 1_000_000))
    true_rows = conditions.filter(holds).select(rule, ts, tick.alias("__tick"))
    ranked = rank_within(true_rows, [rule], ["__tick"], "__rank", F.floor(F.col("__tick") * step / 86_400), max_rows)
    stretches = (
        ranked.withColumn("__island", F.col("__tick") - F.col("__rank"))
        .groupBy(rule, "__island")
        .agg(
            F.min(ts).alias("since"),
            F.max(ts).alias("until"),
            ((F.max("__tick") - F.min("__tick")) * step).alias("seconds"),
        )
    )
    return stretches.filter(F.col("seconds") >= lasting).drop("__island")


@dataclass(frozen=True)
class AlertRule:
    """Fires when `metric` is beyond `threshold` at every evaluation, `step` seconds apart, for `lasting` seconds."""

    name: str
    metric: str
    direction: str
    threshold: float
    lasting: int
    severity: str
    step: int = 60


# Alert rules.
ALERT_RULES = (
    AlertRule("HighLatency", "latency_p95", "above", 0.5, 300, "warning"),
    AlertRule("HighErrorRate", "error_rate", "above", 0.05, 120, "critical"),
    AlertRule("ModelNotLoaded", "model_loaded", "below", 1, 60, "critical"),
    AlertRule("ModelPerformanceDegradation", "mae", "above", 50_000, 1800, "warning"),
    AlertRule("DataDrift", "drift_score", "above", 0.2, 3600, "warning"),
    AlertRule("HighCPUUsage", "cpu_rate", "above", 0.8, 600, "warning"),
    AlertRule("HighMemoryUsage", "memory_bytes", "above", 2e9, 300, "warning"),
)


def alert_table(
    series: DataFrame, rules: Sequence[AlertRule] = ALERT_RULES, ts: str = "ts", max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Firing stretches of all rules over (metric, ts, value) rows, each rule with its own threshold, step and
    duration. A null or NaN value is a missing evaluation."""

    def of(field: str) -> Column:
        pairs = [F.lit(x) for r in rules for x in (r.name, getattr(r, field))]
        return F.create_map(*pairs)[F.col("rule")]

    by_metric: dict[str, list[str]] = {}
    for r in rules:
        by_metric.setdefault(r.metric, []).append(r.name)
    wanted = [F.when(F.col("metric") == m, F.array(*map(F.lit, names))) for m, names in by_metric.items()]
    conditions = series.filter(~F.isnan("value")).select(ts, "value", F.explode(F.coalesce(*wanted)).alias("rule"))
    threshold = of("threshold")
    holds = F.when(of("direction") == "above", F.col("value") > threshold).otherwise(F.col("value") < threshold)
    fired = firing(conditions, "rule", ts, holds, of("step"), of("lasting"), max_rows)
    return fired.withColumn("severity", of("severity"))


def threshold_board(metrics: DataFrame, thresholds: Sequence[tuple[str, str, float]] = THRESHOLDS) -> DataFrame:
    """(metric, value) rows with their threshold and whether it is breached."""
    bound, side = F.lit(None).cast("double"), F.lit(None).cast("string")
    for name, direction, limit in thresholds:
        bound = F.when(F.col("metric") == name, F.lit(limit)).otherwise(bound)
        side = F.when(F.col("metric") == name, F.lit(direction)).otherwise(side)
    board = metrics.withColumns({"direction": side, "threshold": bound}).filter(F.col("threshold").isNotNull())
    breached = F.when(F.col("direction") == "above", F.col("value") > F.col("threshold")).otherwise(
        F.col("value") < F.col("threshold")
    )
    return board.withColumn("breached", breached)


def in_progress(
    df: DataFrame, keys: Sequence[str], start: str, end: str, max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Requests being served after every instant at which one starts or ends."""
    changes = F.array(
        F.struct(F.col(start).alias("instant"), F.lit(1).alias("delta")),
        F.struct(F.col(end).alias("instant"), F.lit(-1).alias("delta")),
    )
    deltas = df.select(*keys, F.inline(changes)).groupBy(*keys, "instant").agg(F.sum("delta").alias("delta"))
    bucket = day_number(F.col("instant"))
    running = running_sum(deltas, keys, ["instant"], {"in_progress": "delta"}, bucket, max_rows)
    return running.select(*keys, "instant", "in_progress")


def slow_requests(df: DataFrame, latency: str = "latency_ms", limit_ms: float = 1000.0) -> DataFrame:
    return df.filter(F.col(latency) > limit_ms)


def performance_trigger(
    df: DataFrame, ts: str, window: str = "30 days", mae_limit: float = 50000.0
) -> DataFrame:
    """Prediction error per window and whether it calls for retraining."""
    known = df.filter(F.col("actual").isNotNull())
    scored = known.groupBy(F.window(ts, window).alias("__window")).agg(*metric_columns())
    return scored.select(
        F.col("__window.start").alias("window_start"), "n", "mae", (F.col("mae") > mae_limit).alias("triggered")
    )


def new_data_trigger(df: DataFrame, ts: str, last: datetime) -> DataFrame:
    newer = F.col(ts) > F.lit(last).cast(df.schema[ts].dataType)
    return df.filter(newer).agg(
        F.max(ts).alias("newest"), F.count(F.lit(1)).alias("new_rows"), (F.count(F.lit(1)) > 0).alias("triggered")
    )


def event_trigger(df: DataFrame, event_type: str, ts: str = "ts", window: str = "1 hour") -> DataFrame:
    matched = df.filter(F.col("event_type") == event_type)
    counts = matched.groupBy(F.window(ts, window).alias("__window")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("__window.start").alias("window_start"), "n", F.lit(True).alias("triggered"))


def composite_trigger(conditions: DataFrame, keys: Sequence[str], operator: str = "AND") -> DataFrame:
    """Combine boolean `triggered` rows per key: AND, OR; any other operator never triggers."""
    combined = {"AND": F.bool_and("triggered"), "OR": F.bool_or("triggered")}
    decision = combined.get(operator, F.bool_or(F.lit(False)))
    return conditions.groupBy(*keys).agg(F.coalesce(decision, F.lit(False)).alias("should_run"))
