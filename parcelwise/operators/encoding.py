"""Category encoding, robust scaling, projection and grid cells."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from parcelwise.functions.columns import numeric_columns, sanitize
from parcelwise.functions.features import flag, training_features
from parcelwise.operators.aggregates import GroupStats, fit_group_stats, out_of_fold_stats
from parcelwise.operators.ordering import rank_within
from parcelwise.operators.quantiles import quantile_values
from parcelwise.scale import MAX_GROUP_ROWS, MAX_SMALL_ROWS, join_keys, small_rows, written


def frequency_index(df: DataFrame, column: str, out: str, sizes: DataFrame | None = None) -> DataFrame:
    """Category number by falling frequency; equal frequencies in value order."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")) if sizes is None else sizes
    small = small_rows(counts)
    if small is not None:
        place = F.row_number().over(Window.orderBy(F.desc("n"), column))
        index = small.select(column, (place - 1).cast("double").alias(out))
        return join_keys(df, F.broadcast(index), [column])
    ranked = rank_within(counts.withColumn("__neg", -F.col("n")), [], ["__neg", column], "__rank")
    return join_keys(df, ranked.select(column, (F.col("__rank") - 1).cast("double").alias(out)), [column])


def one_hot_vector(df: DataFrame, column: str, out: str, invalid: str = "error") -> PipelineModel:
    """Fitted index and one-hot encoder; the rarest category is the all-zero vector.

    The index holds its labels on the driver, so their number is counted first."""
    categories = df.agg(F.count_distinct(column)).first()[0]
    if categories > MAX_SMALL_ROWS:
        raise ValueError(f"{column} has {categories} categories, more than {MAX_SMALL_ROWS}; use frequency_index")
    index = StringIndexer(inputCol=column, outputCol=f"{column}_index", handleInvalid=invalid)
    return Pipeline(stages=[index, OneHotEncoder(inputCol=f"{column}_index", outputCol=out)]).fit(df)


@dataclass(frozen=True)
class TopCategories:
    """The k most frequent categories; all others share one `other` column."""

    column: str
    values: tuple[str, ...]

    def apply(self, df: DataFrame) -> DataFrame:
        col = F.col(self.column)
        out = {f"{self.column}_{v}": flag(col == v) for v in self.values}
        out[f"{self.column}_other"] = flag(~F.coalesce(col.isin(*self.values), F.lit(False)))
        return df.withColumns(out)


def fit_top_categories(df: DataFrame, column: str, k: int = 10) -> TopCategories:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    rows = counts.orderBy(F.desc("n"), column).limit(k).collect()
    return TopCategories(column, tuple(r[0] for r in rows))


@dataclass(frozen=True)
class RobustScale:
    """(x - median) / (q75 - q25) with fitted values; a zero range divides by 1."""

    center: dict[str, float]
    spread: dict[str, float]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: (F.col(c) - F.lit(m)) / F.lit(self.spread[c]) for c, m in self.center.items()}
        )


def fit_robust_scale(df: DataFrame, cols: Sequence[str], max_rows: int = MAX_GROUP_ROWS) -> RobustScale:
    found = quantile_values(df, cols, [0.25, 0.5, 0.75], max_rows=max_rows)
    center = {c: q[1] if q[1] is not None else 0.0 for c, q in found.items()}
    spread = {c: (q[2] - q[0]) if q[0] is not None and q[2] != q[0] else 1.0 for c, q in found.items()}
    return RobustScale(center, spread)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Vector in fixed column order; fails on a missing value instead of dropping the row."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def fit_pca(df: DataFrame, column: str, out: str, components: int = 50) -> PipelineModel:
    """Centred principal components, at most as many as there are input features."""
    width = len(df.select(column).first()[0])
    center = StandardScaler(withMean=True, withStd=False, inputCol=column, outputCol=f"{column}_centered")
    pca = PCA(k=min(components, width), inputCol=f"{column}_centered", outputCol=out)
    return Pipeline(stages=[center, pca]).fit(df)


def explained_variance(fitted: PipelineModel) -> list[float]:
    """Share of the whole variance that each component of `fit_pca` explains, largest first."""
    return [float(v) for v in fitted.stages[-1].explainedVariance]


def grid_cell(lat: str, lon: str, degrees: float) -> Column:
    """Id of the equal-angle cell a position lies in."""
    row = F.floor((F.col(lat) + 90) / F.lit(float(degrees)))
    column = F.floor((F.col(lon) + 180) / F.lit(float(degrees)))
    return F.concat_ws("_", row.cast("string"), column.cast("string"))


def grid_cells(df: DataFrame, lat: str = "latitude", lon: str = "longitude", coarse: float = 5.0, fine: float = 1.0) -> DataFrame:
    return df.withColumns({"cell_coarse": grid_cell(lat, lon, coarse), "cell_fine": grid_cell(lat, lon, fine)})


@dataclass
class FeatureFit:
    """Derived, calendar and group features, sanitised, scaled and optionally projected.

    Group statistics, scale and projection come from the fit alone; `apply` never looks at the
    distribution of the frame it transforms. Rows that a model is trained on come from `fit_training`, whose
    group statistics leave out the row's own fold and with it its price; later rows get the whole ones."""

    keys: tuple[str, ...] = ("zipcode",)
    exclude: tuple[str, ...] = ("price", "property_id", "sale_date", "created_at")
    components: int | None = None
    stats: GroupStats | None = None
    scale: RobustScale | None = None
    columns: tuple[str, ...] = ()
    projection: PipelineModel | None = None

    def _prepared(self, df: DataFrame) -> DataFrame:
        return sanitize(self.stats.apply(training_features(df)))

    def fit(self, df: DataFrame) -> FeatureFit:
        self.stats = fit_group_stats(training_features(df), self.keys)
        return self._fit_prepared(self._prepared(df))

    def fit_training(self, df: DataFrame, fold: Column, folds: int = 5) -> DataFrame:
        """Fit on `df` and return its features. `fold` (0 to `folds` - 1) should spread each group's rows."""
        derived = training_features(df)
        self.stats = fit_group_stats(derived, self.keys)
        marked = derived.withColumn("__own", fold.cast("int"))
        ready = written(sanitize(out_of_fold_stats(marked, self.keys, "__own", folds).drop("__own")), "training-features")
        return self._fit_prepared(ready)._assembled(ready)

    def _fit_prepared(self, ready: DataFrame) -> FeatureFit:
        self.columns = tuple(c for c in numeric_columns(ready) if c not in self.exclude)
        self.scale = fit_robust_scale(ready, self.columns)
        if self.components:
            vectors = assemble(self.scale.apply(ready), self.columns)
            self.projection = fit_pca(vectors, "features", "projected", self.components)
        return self

    def apply(self, df: DataFrame) -> DataFrame:
        if self.scale is None:
            raise ValueError("fit the features before applying them")
        return self._assembled(self._prepared(df))

    def _assembled(self, ready: DataFrame) -> DataFrame:
        out = assemble(self.scale.apply(ready), self.columns)
        return out if self.projection is None else self.projection.transform(out)
