"""Training and scoring pipelines."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions import fixed_values as fixed
from tidecast.learning import models, registry
from tidecast.learning.validation import POOL, Trial, evaluate, grid_search, two_stage_search
from tidecast.names import HOUR, TARGET
from tidecast.operators.windows import assign_folds
from tidecast.plans.features import split_by_time
from tidecast.sources import writers
from tidecast.sources.storage import materialise


#: Rows of the training table per partition: below it, a tree level costs more in tasks than in rows.
ROWS_PER_PARTITION = 5_000
#: The same where a pool of fits keeps the cores busy: a task holds and sends the statistics of all nodes of a level,
#: however few of their rows it has.
POOLED_ROWS = 20_000


@dataclass(frozen=True)
class Search:
    """A parameter search: rates tried with the ``first`` settings, then ``second``; without rates one grid."""

    second: Sequence[dict]
    rates: Sequence[float] = ()
    first: dict | None = None


def all_of(**options: Sequence) -> list[dict]:
    """Every combination of the options, the last one changing fastest."""
    return [dict(zip(options, values, strict=True)) for values in product(*options.values())]


def published_searches(trees: float = 1.0) -> dict[str, Search]:
    """The three published searches; ``trees`` scales the numbers of trees (at least 1), nothing else."""

    def scaled(numbers):
        return [max(1, round(n * trees)) for n in numbers]

    def start(settings):
        return settings | {"maxIter": scaled([settings["maxIter"]])[0]}

    return {
        "absolute": Search(
            all_of(
                maxIter=scaled(fixed.SEARCH_TREES), maxDepth=fixed.SEARCH_DEPTHS, subsamplingRate=fixed.SEARCH_SAMPLES,
                minInstancesPerNode=fixed.SEARCH_LEAVES,
            ),
            fixed.SEARCH_RATES, start(fixed.SEARCH_FIRST),
        ),
        "leafmin": Search(
            all_of(
                maxIter=scaled(fixed.LEAFMIN_TREES), maxDepth=fixed.LEAFMIN_DEPTHS, stepSize=fixed.LEAFMIN_RATES,
                subsamplingRate=fixed.LEAFMIN_SAMPLES, minInstancesPerNode=fixed.LEAFMIN_LEAVES,
            )
        ),
        "batch": Search(
            all_of(
                maxIter=scaled(fixed.BATCH_TREES), maxDepth=fixed.BATCH_DEPTHS, subsamplingRate=fixed.BATCH_SAMPLES,
                minInstancesPerNode=fixed.BATCH_LEAVES, minInfoGain=fixed.BATCH_GAINS,
            ),
            fixed.BATCH_RATES, start(fixed.BATCH_FIRST),
        ),
    }


def searched(estimator: Estimator, vectors: DataFrame, search: Search, n_folds: int = 5, parallelism: int = POOL):
    """(best trial, all trials, best parameters) of a search over vectors with ``fold``."""

    def named(settings: dict) -> dict:
        return {estimator.getParam(k): x for k, x in settings.items()}

    second = [named(p) for p in search.second]
    if not search.rates:
        return grid_search(estimator, vectors, second, n_folds, parallelism)
    return two_stage_search(estimator, vectors, estimator.stepSize, search.rates, named(search.first or {}), second, n_folds, parallelism)


def few_partitions(df: DataFrame, rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """Small tables in few partitions, so that the many small jobs of a fit have few tasks; large ones stay."""
    return df.coalesce(max(1, -(-df.count() // rows_per_partition)))


@dataclass
class TrainingResult:
    model: PipelineModel
    version: int
    best: Trial
    trials: list[Trial]
    metrics: dict[str, float]
    metadata: DataFrame


def training_table(df: DataFrame, features: Sequence[str], n_folds: int, mode: str = "chronological") -> DataFrame:
    """Fold ids and doubles, written once: every fit and evaluation re-reads this table."""
    typed = df.select(
        *[F.col(f).cast("double").alias(f) for f in features],
        F.col(TARGET).cast("double").alias(TARGET),
        HOUR,
        "zone",
    )
    folds = assign_folds(typed, n_folds, mode, zone="zone")
    return materialise(folds, "training")


def train(
    df: DataFrame,
    features: Sequence[str],
    cut: Column,
    root: str,
    name: str,
    search: Search | None = None,
    n_folds: int = 5,
    trained_at: str = "",
    created: int = 0,
    parallelism: int = POOL,
    estimator: Estimator | None = None,
    fold_mode: str = "chronological",
) -> TrainingResult:
    """Split by time, tune on the training side, refit, evaluate, register, log.

    ``search`` is the published one of absolute loss by default (see ``published_searches`` for the others), and
    ``estimator`` the boosting variant to tune; ``fold_mode`` is ``chronological`` or ``positional``.
    """
    spark = df.sparkSession
    train_side, test_side = split_by_time(df, cut)
    folds = training_table(train_side, features, n_folds, fold_mode)
    vectors = models.checked_matrix(folds, features).select(models.FEATURES, TARGET, "fold")
    estimator = estimator or models.gbt_absolute()
    search = search or published_searches()["absolute"]
    vectors = few_partitions(vectors, POOLED_ROWS)
    vectors.persist()
    try:
        best, trials, params = searched(estimator, vectors, search, n_folds, parallelism)
        model = models.pipeline(features, estimator.copy(params)).fit(few_partitions(folds))
    finally:
        vectors.unpersist()
    typed_test = test_side.withColumns({f: F.col(f).cast("double") for f in features})
    sides = {r["side"]: r for r in evaluate(model, folds.select(*features, TARGET), typed_test.select(*features, TARGET)).collect()}
    metrics = {f"{s}_{m}": sides[s][m] for s in ("train", "test") if s in sides for m in ("mae", "mse", "rmse")}
    version = registry.register(spark, root, name, model, f"{name}-{created}", created)
    metadata = models.metadata_row(
        spark,
        name,
        type(estimator).__name__,
        best.params,
        features,
        trained_at,
        metrics,
        {"cv_folds": n_folds, "cv_mae_mean": best.cv_mae_mean, "cv_mae_std": best.cv_mae_std},
        sides["train"]["n"],
    )
    writers.write_model_metadata(metadata, f"{root}/metadata/{name}/{version}")
    runs = {
        f"{name}-{created}-{i}": {"param": trial.params, "metric": {"cv_mae_mean": trial.cv_mae_mean, "cv_mae_std": trial.cv_mae_std}}
        for i, trial in enumerate(trials)
    }
    writers.log_run(writers.runs_rows(spark, runs, created, f"{name}-{created}"), f"{root}/runs")
    return TrainingResult(model, version, best, trials, metrics, metadata)


def score_next_hour(rows: DataFrame, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Contract rows ``(hour, zone, predicted_ride_count)``; the hour is the scored one."""
    from tidecast.sources.contracts import PREDICTIONS, conform

    return conform(models.score(rows, model, features), PREDICTIONS)
