"""Model registry as an append-only event table.

Event columns: model_name, event_ts, event_id, action ('register' or 'promote'), version (target of
a promotion), params, metrics. The state is always derived from the events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.columns import params_hash
from parcelwise.operators.ordering import day_number, rank_within
from parcelwise.scale import MAX_GROUP_ROWS, join_keys


def registered_versions(events: DataFrame, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Versions v1, v2, ... in registration order with the hash of their parameters, and their runs if events name them."""
    added = events.filter(F.col("action") == "register")
    numbered = rank_within(
        added, ["model_name"], ["event_ts", "event_id"], "number", day_number(F.col("event_ts")), max_rows
    )
    return numbered.select(
        "model_name",
        F.col("number"),
        F.concat(F.lit("v"), F.col("number").cast("string")).alias("version"),
        params_hash(F.col("params")).alias("hash"),
        F.col("event_ts").alias("created_at"),
        *[c for c in ("run_id",) if c in events.columns],
    )


def registry_state(events: DataFrame, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Every version with its stage: the last promoted one is in production, earlier ones archived.

    A promotion naming a version that does not exist (yet) has no effect."""
    versions = registered_versions(events, max_rows)
    raw = events.filter(F.col("action") == "promote").select("model_name", "version", "event_ts", "event_id")
    known = versions.select("model_name", "version", "created_at")
    valid = raw.join(known, ["model_name", "version"]).filter(F.col("event_ts") >= F.col("created_at"))
    last = valid.groupBy("model_name").agg(
        F.max(F.struct("event_ts", "event_id", "version")).alias("__last")
    )
    promoted = valid.groupBy("model_name", "version").agg(F.max("event_ts").alias("promoted_at"))
    staged = join_keys(join_keys(versions, promoted, ["model_name", "version"]), last, ["model_name"])
    stage = (
        F.when(F.col("__last.version") == F.col("version"), "production")
        .when(F.col("promoted_at").isNotNull(), "archived")
        .otherwise("staging")
    )
    return staged.withColumn("stage", stage).drop("__last")


def production_models(state: DataFrame) -> DataFrame:
    return state.filter(F.col("stage") == "production")


def rollback_targets(state: DataFrame) -> DataFrame:
    """Version registered just before the one in production; appending it as a promotion rolls back."""
    current = production_models(state).select("model_name", (F.col("number") - 1).alias("number"))
    return current.join(state.select("model_name", "number", "version", "hash"), ["model_name", "number"])


def promote_event(events: DataFrame, targets: DataFrame, at) -> DataFrame:
    """Promotion rows for `targets` (model_name, version), ready to append to `events`."""
    rows = targets.select(
        "model_name",
        F.lit(at).cast("timestamp_ntz").alias("event_ts"),
        F.lit(None).cast("long").alias("event_id"),
        F.lit("promote").alias("action"),
        "version",
    )
    return events.unionByName(rows, allowMissingColumns=True)
