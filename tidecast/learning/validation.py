"""Expanding-window cross-validation and parameter search."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Estimator
from pyspark.ml.param import Param
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.learning import growth
from tidecast.names import TARGET
from tidecast.operators.aggregates import regression_metrics
from tidecast.sources.contracts import struct

#: Fits that run at the same time; each is a chain of small jobs, so that one alone leaves most cores idle.
POOL = 8

SCORES = struct("fold int, n bigint, mae double")


def cv_summary(scores: DataFrame, score: str = "mae") -> DataFrame:
    """Mean and population standard deviation of fold scores."""
    return scores.agg(F.avg(score).alias("cv_mae_mean"), F.stddev_pop(score).alias("cv_mae_std"))


@dataclass
class Trial:
    """One evaluated parameter set."""

    params: dict[str, object]
    cv_mae_mean: float
    cv_mae_std: float
    fold_maes: list[float] = field(default_factory=list)
    stage: int = 1


def fold_scores(
    estimator: Estimator,
    df: DataFrame,
    n_folds: int,
    params: dict | None = None,
    fold: str = "fold",
    target: str = TARGET,
    parallelism: int = 2,
) -> DataFrame:
    """MAE of every expanding fold: fit on folds before i, test on fold i.

    ``df`` carries the fold id and should be persisted by the caller: each fit and
    each evaluation is a distributed job over it, and only one number per fold
    comes back.
    """

    def run(i: int):
        model = estimator.fit(df.where(F.col(fold) < i), params or {})
        scored = model.transform(df.where(F.col(fold) == i))
        row = regression_metrics(scored, target, "prediction").first()
        return (i, row["n"], row["mae"])

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        rows = list(pool.map(run, range(1, n_folds + 1)))
    return df.sparkSession.createDataFrame(rows, SCORES)


def evaluate(model, train: DataFrame, test: DataFrame, target: str = TARGET) -> DataFrame:
    """MAE, MSE and RMSE on the training and the test side, one row per side."""
    sides = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return regression_metrics(model.transform(sides), target, "prediction", by=["side"])


def staged_maes(model, df: DataFrame, counts: Sequence[int]) -> list[float]:
    """MAE on ``df`` of the first n trees of a boosted model for each n of ``counts``, from one pass."""
    after = model.evaluateEachIteration(df, "absolute")
    return [after[min(n, len(after)) - 1] for n in counts]


def grid_trials(
    estimator: Estimator, df: DataFrame, grid: Sequence[dict[Param, object]], n_folds: int = 5, parallelism: int = POOL, stage: int = 1
) -> list[Trial]:
    """Every parameter set scored on every expanding fold, in the order of ``grid``.

    Boosting adds trees one by one, so sets that differ only in the number of trees are one fit with the
    most, scored at each number. Where tasks can hold the rows, each boosted fit is a task (``growth``); else all
    fits, of all sets and folds, share one pool of ``parallelism`` threads.
    """
    boosted = isinstance(estimator, GBTRegressor)
    fits: dict[tuple, list[int]] = {}
    for k, params in enumerate(grid):
        rest = tuple(sorted((p.name, x) for p, x in params.items() if not (boosted and p.name == "maxIter")))
        fits.setdefault(rest, []).append(k)

    def counts_of(sets: list[int]) -> list[int]:
        return [grid[k].get(estimator.maxIter, estimator.getMaxIter()) for k in sets]

    def run(job: tuple[list[int], int]) -> list[float]:
        sets, fold = job
        test = df.where(F.col("fold") == fold)
        if not boosted:
            model = estimator.fit(df.where(F.col("fold") < fold), grid[sets[0]])
            return [regression_metrics(model.transform(test), TARGET, "prediction").first()["mae"]] * len(sets)
        counts = counts_of(sets)
        model = estimator.fit(df.where(F.col("fold") < fold), {**grid[sets[0]], estimator.maxIter: max(counts)})
        return staged_maes(model, test, counts)

    # the longest first
    jobs = [(sets, fold) for fold in range(n_folds, 0, -1) for sets in fits.values()]
    if boosted and growth.grows(estimator, df, grid):
        scored = growth.boosted_scores(estimator, df, [(grid[sets[0]], counts_of(sets), fold) for sets, fold in jobs])
    else:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            scored = list(pool.map(run, jobs))
    maes: dict[int, list[float]] = {k: [0.0] * n_folds for k in range(len(grid))}
    for (sets, fold), found in zip(jobs, scored, strict=True):
        for k, mae in zip(sets, found, strict=True):
            maes[k][fold - 1] = mae
    trials = []
    for k, params in enumerate(grid):
        mean = sum(maes[k]) / n_folds
        std = (sum((m - mean) ** 2 for m in maes[k]) / n_folds) ** 0.5
        trials.append(Trial({p.name: x for p, x in params.items()}, mean, std, maes[k], stage))
    return trials


def trials_frame(spark, trials: Sequence[Trial]) -> DataFrame:
    rows = [({k: str(x) for k, x in t.params.items()}, t.cv_mae_mean, t.cv_mae_std) for t in trials]
    return spark.createDataFrame(rows, "params map<string,string>, cv_mae_mean double, cv_mae_std double")


def best_of(trials: Sequence[Trial]) -> int:
    """Place of the smallest mean fold MAE (the first on ties)."""
    return min(range(len(trials)), key=lambda i: trials[i].cv_mae_mean)


def grid_search(
    estimator: Estimator, df: DataFrame, grid: Sequence[dict[Param, object]], n_folds: int = 5, parallelism: int = POOL, stage: int = 1
) -> tuple[Trial, list[Trial], dict[Param, object]]:
    """The best set of the grid, all trials, and the best set as parameters."""
    trials = grid_trials(estimator, df, grid, n_folds, parallelism, stage)
    best = best_of(trials)
    return trials[best], trials, grid[best]


def two_stage_search(
    estimator: Estimator,
    df: DataFrame,
    rate: Param,
    rates: Sequence[float],
    first: dict[Param, object],
    second: Sequence[dict[Param, object]],
    n_folds: int = 5,
    parallelism: int = POOL,
) -> tuple[Trial, list[Trial], dict[Param, object]]:
    """Tune the learning rate at fixed other parameters, then the others at the best rate.

    The best set is the best of the second stage. ``df`` carries ``fold`` and should be persisted and of few
    partitions where it is small.
    """
    stage_one = [{**first, rate: r} for r in rates]
    best_rate, trials, _ = grid_search(estimator, df, stage_one, n_folds, parallelism, 1)
    chosen = best_rate.params[rate.name]
    stage_two = [{**params, rate: chosen} for params in second]
    best, more, params = grid_search(estimator, df, stage_two, n_folds, parallelism, 2)
    return best, trials + more, params
