"""Random search with shuffled k-fold validation."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.param import Param
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame

from tidecast.functions.scalars import hash_fraction
from tidecast.learning import growth
from tidecast.names import TARGET


def sample_params(space: Mapping[Param, Sequence], n: int, seed: int = 42) -> list[dict[Param, object]]:
    """``n`` distinct random combinations of the space (all of them when it is smaller)."""
    size = 1
    for options in space.values():
        size *= len(options)
    rng = random.Random(seed)
    chosen = sorted(rng.sample(range(size), min(n, size)))
    out = []
    for index in chosen:
        params = {}
        for param, options in space.items():
            index, i = divmod(index, len(options))
            params[param] = options[i]
        out.append(params)
    return out


def random_search(
    estimator: Estimator,
    df: DataFrame,
    space: Mapping[Param, Sequence],
    keys: Sequence[str],
    n: int = 10,
    n_folds: int = 3,
    metric: str = "rmse",
    target: str = TARGET,
    seed: int = 42,
    parallelism: int = 2,
):
    """Fitted ``CrossValidatorModel`` over random parameter sets.

    Folds come from a hash of the row key, so they are the same on every recomputation. Where tasks can hold the rows,
    forests are grown by trees dealt to tasks (``growth``), so that neither their time nor the driver's memory is that of
    a job and a table of statistics for every level of every tree.
    """
    fold = (hash_fraction(*keys, seed=seed) * n_folds).cast("int")
    cv = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=sample_params(space, n, seed),
        evaluator=RegressionEvaluator(labelCol=target, predictionCol="prediction", metricName=metric),
        numFolds=n_folds,
        foldCol="__fold",
        parallelism=parallelism,
        seed=seed,
    )
    dealt = df.withColumn("__fold", fold)
    grid = cv.getEstimatorParamMaps()
    if metric in ERRORS and isinstance(estimator, RandomForestRegressor) and growth.grows(estimator, dealt, grid):
        return _grown(cv, dealt, grid, metric)
    return cv.fit(dealt)


#: Errors from the number of rows and their sums of squared and of absolute errors.
ERRORS = {
    "rmse": lambda n, squares, distances: math.sqrt(squares / n),
    "mse": lambda n, squares, distances: squares / n,
    "mae": lambda n, squares, distances: distances / n,
}


def _grown(cv: CrossValidator, df: DataFrame, grid: Sequence[dict], metric: str) -> CrossValidatorModel:
    """What ``cv`` fits, with trees grown in tasks."""
    errors = growth.forest_errors(cv.getEstimator(), df, grid, cv.getNumFolds(), cv.getFoldCol())
    scores = [[ERRORS[metric](*fold) for fold in folds] for folds in errors]
    means = [sum(s) / len(s) for s in scores]
    spreads = [math.sqrt(sum((x - mean) ** 2 for x in s) / len(s)) for s, mean in zip(scores, means, strict=True)]
    best = growth.forest(cv.getEstimator(), df, grid[means.index(min(means))])
    return cv._copyValues(CrossValidatorModel(best, means, [], spreads))


def split_random(df: DataFrame, keys: Sequence[str], train_share: float = 0.67, seed: int = 42):
    """(train, test) by a hash of the key: stable under retries and reordering."""
    u = hash_fraction(*keys, seed=seed)
    return df.where(u < train_share), df.where(u >= train_share)
