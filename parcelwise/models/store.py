"""Versioned models in a shared folder: artefacts per run, registered by an event that is written last.

A run's folder holds the fitted pipeline, the fitted features and the group statistics. The event in the
registry's table is the commit: artefacts without one are of a run that did not finish and are written again
by its next try, and a run that has one is never registered twice."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.operators.aggregates import GroupStats
from parcelwise.operators.encoding import FeatureFit, RobustScale
from parcelwise.operators.registry import production_models, registry_state
from parcelwise.scale import lookup_side

EVENTS = (
    "model_name STRING, event_ts TIMESTAMP_NTZ, event_id BIGINT, action STRING, version STRING, params STRING,"
    " metrics STRING, run_id STRING"
)


@dataclass(frozen=True)
class StoredModel:
    version: str
    run_id: str
    model: PipelineModel
    features: FeatureFit | None


@dataclass(frozen=True)
class ModelStore:
    spark: SparkSession
    root: str

    def _artefacts(self, name: str, run_id: str) -> str:
        return f"{self.root}/artefacts/{name}/{run_id}"

    def _append(self, folder: str, **values) -> None:
        """One event in a folder named by what it says, so that saying it again changes nothing."""
        row = self.spark.range(1).select(
            *[
                F.lit(values.get(f.name)).cast(f.dataType).alias(f.name)
                if f.name != "event_ts"
                else F.current_timestamp().cast(f.dataType).alias(f.name)
                for f in self.spark.createDataFrame([], EVENTS).schema.fields
            ]
        )
        row.coalesce(1).write.mode("ignore").parquet(f"{self.root}/events/{folder}")

    def events(self) -> DataFrame:
        self.spark.createDataFrame([], EVENTS).write.mode("ignore").parquet(f"{self.root}/events/none")
        return self.spark.read.schema(EVENTS).option("recursiveFileLookup", True).parquet(f"{self.root}/events")

    def state(self) -> DataFrame:
        return registry_state(self.events())

    def register(
        self,
        name: str,
        run_id: str,
        model: Model,
        params: Mapping[str, object],
        metrics: Mapping[str, float],
        features: FeatureFit | None = None,
    ) -> str:
        """Store a run's model and register it; returns its version. A registered run is left as it is."""
        mine = (F.col("model_name") == name) & (F.col("run_id") == run_id)
        if self.events().filter(mine).isEmpty():
            path = self._artefacts(name, run_id)
            PipelineModel([model]).write().overwrite().save(f"{path}/model")
            if features is not None:
                save_features(features, f"{path}/features")
            self._append(
                f"register-{name}-{run_id}",
                model_name=name,
                event_id=0,
                action="register",
                params=json.dumps(dict(params), sort_keys=True),
                metrics=json.dumps(dict(metrics), sort_keys=True),
                run_id=run_id,
            )
        return self.state().filter(mine).first()["version"]

    def promote(self, name: str, version: str) -> None:
        """Put a version into production. Each promotion is an event of its own."""
        n = self.events().filter((F.col("model_name") == name) & (F.col("action") == "promote")).count()
        self._append(f"promote-{name}-{n}", model_name=name, event_id=n + 1, action="promote", version=version)

    def load(self, name: str, version: str | None = None) -> StoredModel:
        """A version, or the one in production."""
        state = self.state().filter(F.col("model_name") == name)
        found = state.filter(F.col("version") == version) if version else production_models(state)
        row = found.first()
        if row is None:
            raise ValueError(f"no version {version or 'in production'} of {name}")
        path = self._artefacts(name, row["run_id"])
        return StoredModel(
            row["version"],
            row["run_id"],
            PipelineModel.load(f"{path}/model"),
            load_features(self.spark, f"{path}/features"),
        )


def save_features(fit: FeatureFit, path: str) -> None:
    """Fitted features: statistics and projection first, then the row that names them."""
    if fit.stats is None or fit.scale is None:
        raise ValueError("fit the features before storing them")
    spark = fit.stats.table.sparkSession
    fit.stats.table.write.mode("overwrite").parquet(f"{path}/stats")
    if fit.projection is not None:
        fit.projection.write().overwrite().save(f"{path}/projection")
    named = {
        "keys": fit.keys,
        "exclude": fit.exclude,
        "components": fit.components,
        "columns": fit.columns,
        "center": fit.scale.center,
        "spread": fit.scale.spread,
    }
    spark.createDataFrame([(json.dumps(named),)], "settings STRING").write.mode("overwrite").parquet(f"{path}/settings")


def load_features(spark: SparkSession, path: str) -> FeatureFit | None:
    """Stored features, or None where a model has none."""
    spark.createDataFrame([], "settings STRING").write.mode("ignore").parquet(f"{path}/settings")
    row = spark.read.schema("settings STRING").parquet(f"{path}/settings").first()
    if row is None:
        return None
    named = json.loads(row["settings"])
    keys = tuple(named["keys"])
    return FeatureFit(
        keys,
        tuple(named["exclude"]),
        named["components"],
        GroupStats(keys, lookup_side(spark.read.parquet(f"{path}/stats"))),
        RobustScale(named["center"], named["spread"]),
        tuple(named["columns"]),
        PipelineModel.load(f"{path}/projection") if named["components"] else None,
    )
