"""Group-stat joins, point-in-time joins and result reuse."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.operators.metrics import metric_columns
from parcelwise.operators.ordering import last_known
from parcelwise.scale import MAX_GROUP_ROWS, join_keys, lookup_side, written


def join_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of a per-key table, broadcast only when it was checked to be small."""
    return join_keys(df, lookup_side(stats), keys)


def entity_spine(ids: DataFrame, timestamps: Sequence[datetime], out: str = "event_timestamp") -> DataFrame:
    """Every id at every given timestamp."""
    moments = F.array(*[F.lit(t).cast("timestamp_ntz") for t in timestamps])
    return ids.withColumn(out, F.explode(moments))


@dataclass(frozen=True)
class FeatureView:
    """Named feature history of one entity."""

    name: str
    source: DataFrame
    entity: str
    features: tuple[str, ...]
    ttl: timedelta | None = None
    event: str = "event_timestamp"
    created: str = "created_timestamp"


def point_in_time(
    spine: DataFrame,
    view: FeatureView,
    features: Sequence[str] | None = None,
    ts: str = "event_timestamp",
    prefix: str = "",
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add the newest feature row of each entity at or before its timestamp and within the TTL.

    History and spine go into one frame sorted per entity; each spine row takes the last history
    row seen. Equal event times are decided by the created time, then by the values of all features
    of the view, so the chosen row does not depend on which features are asked for. A null entity has no
    history: null keys never match."""
    features = list(features or view.features)
    clash = [f"{prefix}{f}" for f in features if f"{prefix}{f}" in spine.columns]
    if clash:
        raise ValueError(f"spine already has {clash}")
    payload = F.struct(F.col(view.event).alias("__at"), *features)
    history = view.source.filter(F.col(view.entity).isNotNull()).select(
        F.col(view.entity).alias("__key"),
        F.col(view.event).alias("__ts"),
        F.lit(0).alias("__side"),
        F.col(view.created).alias("__created"),
        F.struct(*view.features).alias("__tie"),
        payload.alias("__feature"),
    )
    asked = spine.select(
        F.col(view.entity).alias("__key"),
        F.col(ts).alias("__ts"),
        F.lit(1).alias("__side"),
        F.struct(*spine.columns).alias("__spine"),
    )
    both = history.unionByName(asked, allowMissingColumns=True)
    order = ["__ts", "__side", "__created", "__tie"]
    bucket = F.unix_date(F.to_date("__ts")).cast("long")
    matched = last_known(both, ["__key"], order, "__feature", "__found", bucket, max_rows)
    matched = matched.filter(F.col("__side") == 1)
    live = F.lit(True)
    if view.ttl is not None:
        live = F.col("__found.__at") >= F.col("__ts") - F.lit(view.ttl)
    return matched.select(
        "__spine.*", *[F.when(live, F.col(f"__found.{f}")).alias(f"{prefix}{f}") for f in features]
    )


def historical_features(
    spine: DataFrame,
    views: Sequence[FeatureView],
    refs: Sequence[str],
    ts: str = "event_timestamp",
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Resolve `view:feature` references, one point-in-time join per view; output `view__feature`."""
    by_name = {v.name: v for v in views}
    wanted: dict[str, list[str]] = {}
    for ref in refs:
        name, _, feature = ref.partition(":")
        if name not in by_name or feature not in by_name[name].features:
            raise ValueError(f"unknown feature reference {ref!r}")
        wanted.setdefault(name, []).append(feature)
    for name, features in wanted.items():
        spine = point_in_time(spine, by_name[name], features, ts, f"{name}__", max_rows)
    return spine


def delayed_metrics(
    predictions: DataFrame, actuals: DataFrame, key: str, labels: Sequence[str] = (), arrived: str | None = None
) -> DataFrame:
    """Error metrics of the predictions whose actual has arrived, and how many still wait for theirs.

    Each prediction counts once: of several actuals of a key the newest by `arrived` counts, of equally new
    ones (or of all, without that column) the largest."""
    newest = F.max(F.struct(*([arrived] if arrived else []), "actual"))["actual"]
    once = actuals.filter(F.col("actual").isNotNull()).groupBy(key).agg(newest.alias("actual"))
    joined = predictions.join(once, key, "left")
    waiting = F.count_if(F.col("actual").isNull()).alias("waiting")
    return joined.groupBy(*labels).agg(*metric_columns(), waiting)


def reuse_or_score(
    requests: DataFrame,
    results: DataFrame,
    fingerprint: str,
    score: Callable[[DataFrame], DataFrame],
    values: Sequence[str],
    ttl: timedelta = timedelta(hours=1),
    request_ts: str = "ts",
    result_ts: str = "result_ts",
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Take earlier results that are not older than `ttl`; score the remaining requests.

    The lookup is written once because hits and misses go different ways.

    The lookup is a point-in-time join on the fingerprint, so a repeated or dominating fingerprint
    neither multiplies rows nor lands in one task."""
    view = FeatureView("results", results, fingerprint, tuple(values), ttl, result_ts, result_ts)
    asked = requests.withColumn("reused", F.lit(True))
    found = written(point_in_time(asked, view, ts=request_ts, max_rows=max_rows), "lookups")
    hit = F.col(values[0]).isNotNull()
    missed = found.filter(~hit).select(*requests.columns)
    scored = score(missed).withColumn("reused", F.lit(False))
    return found.filter(hit).unionByName(scored.select(*found.columns))


def compare_versions(versions: DataFrame, metrics: DataFrame, metric: str) -> DataFrame:
    """Versions with the metric of their run, best first; versions without it drop out."""
    wanted = metrics.filter(F.col("key") == metric).select("run_id", F.col("value").alias(metric))
    return versions.join(wanted, "run_id").orderBy(metric, "version")


def shared_columns(current: DataFrame, reference: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c in current.columns and c in reference.columns]


def tag_and_union(current: DataFrame, reference: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Shared columns of both frames with `is_reference` telling the side."""
    cols = shared_columns(current, reference, cols)
    return current.select(*cols, F.lit(False).alias("is_reference")).unionByName(
        reference.select(*cols, F.lit(True).alias("is_reference"))
    )
