"""Estimators with the published settings, all trained by MLlib on the executors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param.shared import HasInputCol, HasPredictionCol
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.functions.scalars import round_half_even
from tidecast.names import TARGET, lag_name
from tidecast.operators.quality import expect
from tidecast.sources.contracts import MODEL_METADATA, struct

FEATURES = "features"
SEED = 42


class _PersistenceParams(HasInputCol, HasPredictionCol):
    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(inputCol=lag_name(1), predictionCol="prediction")


class PersistenceForecaster(Estimator, _PersistenceParams, DefaultParamsReadable, DefaultParamsWritable):
    """Baseline: the forecast is an existing column (a lag). Nothing is learned."""

    @keyword_only
    def __init__(self, *, inputCol: str = lag_name(1), predictionCol: str = "prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PersistenceModel:
        return PersistenceModel(inputCol=self.getInputCol(), predictionCol=self.getPredictionCol())


class PersistenceModel(Model, _PersistenceParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCol: str = lag_name(1), predictionCol: str = "prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getPredictionCol(), F.col(self.getInputCol()).cast("double"))


def assembler(features: Sequence[str]) -> VectorAssembler:
    """Ordered feature vector; a NULL in any feature is an error, never dropped."""
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="error")


def checked_matrix(df: DataFrame, features: Sequence[str], target: str | None = TARGET) -> DataFrame:
    """Features (and target) as doubles, refused when any value is NULL."""
    names = [*features, *([target] if target else [])]
    expect(df, [(n, F.col(n).isNotNull()) for n in names])
    return assembler(features).transform(df.withColumns({n: F.col(n).cast("double") for n in names}))


def gbt_absolute(**params) -> GBTRegressor:
    """Boosted trees on absolute error."""
    settings = {"lossType": "absolute", "maxIter": 200, "stepSize": 0.3, "maxDepth": 6, "seed": SEED}
    return GBTRegressor(featuresCol=FEATURES, labelCol=TARGET, **(settings | params))


def gbt_leafmin(**params) -> GBTRegressor:
    """Boosted trees controlled by the minimum number of rows per leaf."""
    return gbt_absolute(**({"stepSize": 0.1, "maxDepth": 7, "minInstancesPerNode": 20} | params))


def gbt_squared(**params) -> GBTRegressor:
    settings = {"lossType": "squared", "maxIter": 100, "stepSize": 0.1, "maxDepth": 3, "seed": SEED}
    return GBTRegressor(featuresCol=FEATURES, labelCol=TARGET, **(settings | params))


def tree(**params) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(
        featuresCol=FEATURES, labelCol=TARGET, **({"maxDepth": 10, "seed": SEED} | params)
    )


def forest(**params) -> RandomForestRegressor:
    settings = {"numTrees": 100, "maxDepth": 15, "seed": SEED}
    return RandomForestRegressor(featuresCol=FEATURES, labelCol=TARGET, **(settings | params))


def forest_classifier(label: str, **params) -> RandomForestClassifier:
    settings = {"numTrees": 100, "maxDepth": 15, "seed": SEED}
    return RandomForestClassifier(featuresCol=FEATURES, labelCol=label, **(settings | params))


def pipeline(features: Sequence[str], estimator) -> Pipeline:
    return Pipeline(stages=[assembler(features), estimator])


def encoded_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A sparse 0/1 vector ``<column>_levels`` per category, every level kept and none refused."""
    places, vectors = [f"{c}_place" for c in columns], [f"{c}_levels" for c in columns]
    indexed = StringIndexer(inputCols=list(columns), outputCols=places, stringOrderType="alphabetAsc").fit(df).transform(df)
    return OneHotEncoder(inputCols=places, outputCols=vectors, dropLast=False).fit(indexed).transform(indexed).drop(*places)


IMPORTANCE = struct("rank int, feature string, importance double")


def importance_table(spark, model, features: Sequence[str]) -> DataFrame:
    """Features by importance; one row per feature, ties by name."""
    weights = [float(x) for x in model.featureImportances.toArray()]
    order = sorted(zip(features, weights, strict=True), key=lambda p: (-p[1], p[0]))
    return spark.createDataFrame([(i, f, x) for i, (f, x) in enumerate(order, 1)], IMPORTANCE)


def score(df: DataFrame, model, features: Sequence[str], name: str = "predicted_ride_count") -> DataFrame:
    """Predictions of a fitted pipeline, rounded half to even to whole rides.

    Scoring runs partition by partition on the executors; a NULL feature fails the
    job in the assembler.
    """
    typed = df.withColumns({f: F.col(f).cast("double") for f in features})
    scored = model.transform(typed)
    keep = [F.col(c) for c in df.columns]
    return scored.select(*keep, round_half_even("prediction").alias(name))


def metadata_row(
    spark,
    name: str,
    kind: str,
    params: Mapping[str, object],
    features: Sequence[str],
    trained_at: str,
    metrics: Mapping[str, float],
    cv: Mapping[str, float],
    rows: int,
    target: str = TARGET,
) -> DataFrame:
    row = (
        name,
        kind,
        {k: str(x) for k, x in params.items()},
        list(features),
        target,
        trained_at,
        {k: metrics.get(k) for k in ("train_mae", "train_mse", "train_rmse", "test_mae", "test_mse", "test_rmse")},
        {k: cv.get(k) for k in ("cv_folds", "cv_mae_mean", "cv_mae_std")},
        rows,
        len(features),
    )
    return spark.createDataFrame([row], MODEL_METADATA)
