"""Regression trees grown within tasks, where a task can hold the rows of a fit.

MLlib deals the rows of a fit over the cluster and runs a job for every level of a tree. A training side bounded by the
calendar is small, while a search grows tens of thousands of trees over it: here every task has all rows, and the trees
are dealt. Bins, gains, stop rules, bags and boosting are MLlib's, so that a fit without random choices, and a boosted
one with row samples, gives the trees that MLlib grows (but bins come from all rows, where MLlib draws 10,000 of them).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor, _RandomForestRegressorParams
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.learning import trees
from tidecast.sources.storage import work_path

#: Values (rows x features) of a training side that tasks hold: 64 MB, which also pass the driver once.
VALUES_IN_TASK = 8_000_000
#: Trees of a forest in one task.
TREES_PER_TASK = 20
#: Nodes whose splits are looked for at the same time.
NODES_AT_ONCE = 20_000
EPSILON = 2.0**-52
SUBSETS = {
    "all": lambda m, n: m,
    "auto": lambda m, n: m if n == 1 else math.ceil(m / 3),
    "onethird": lambda m, n: math.ceil(m / 3),
    "sqrt": lambda m, n: math.ceil(math.sqrt(m)),
    "log2": lambda m, n: max(1, math.ceil(math.log2(m))),
}


def settings(estimator: Estimator, params: dict | None = None) -> dict:
    """Parameters of a fit by name."""
    return {p.name: x for p, x in estimator.extractParamMap(params or {}).items()}


def grows(estimator: Estimator, df: DataFrame, grid: Sequence[dict]) -> bool:
    """Whether all fits of the grid are of the kinds grown here, over rows that a task can hold."""
    for s in [settings(estimator, params) for params in grid]:
        if isinstance(estimator, GBTRegressor):
            known = s["featureSubsetStrategy"] == "all" and "validationIndicatorCol" not in s
        else:
            known = isinstance(estimator, RandomForestRegressor) and s["featureSubsetStrategy"] in SUBSETS
        if not known or "weightCol" in s or s["minWeightFractionPerNode"] or s["maxBins"] > 256:
            return False
    column = estimator.getFeaturesCol()
    if "nominal" in df.schema[column].metadata.get("ml_attr", {}).get("attrs", {}):
        return False
    first = df.select(F.size(vector_to_array(column))).first()
    return first is not None and first[0] * df.count() <= VALUES_IN_TASK


@dataclass
class Rows:
    """The rows of a search: features, targets, folds and the partitions they lie in, in their order."""

    x: np.ndarray
    y: np.ndarray
    fold: np.ndarray
    partition: np.ndarray


def rows_of(df: DataFrame, features: str, target: str, fold: str | None = None) -> Rows:
    table = df.select(
        vector_to_array(features).alias("x"), F.col(target).cast("double").alias("y"),
        (F.col(fold).cast("int") if fold else F.lit(0)).alias("fold"), F.spark_partition_id().alias("partition"),
    ).toArrow().combine_chunks()
    y = table["y"].to_numpy()
    if not np.isfinite(y).all():
        raise ValueError("a target is null or not a number")
    x = np.concatenate([c.flatten().to_numpy() for c in table["x"].chunks])
    return Rows(x.reshape(len(y), -1), y, table["fold"].to_numpy(), table["partition"].to_numpy())


def cut_points(values: np.ndarray, max_bins: int) -> np.ndarray:
    """Thresholds of a feature: between any two values, or about equally many rows apart."""
    found, counts = np.unique(values, return_counts=True)
    middles = (found[:-1] + found[1:]) / 2
    most = min(max_bins, len(values)) - 1
    if len(middles) <= most:
        return middles
    stride, sums, out = len(values) / (most + 1), np.cumsum(counts).tolist(), []
    wanted = stride
    for k in range(len(middles)):
        if abs(sums[k] - wanted) < abs(sums[k + 1] - wanted):
            out.append(middles[k])
            wanted += stride
    return np.array(out)


@dataclass
class Bins:
    """Features as places among thresholds, one byte a value and one array a feature."""

    places: list[np.ndarray]
    cuts: list[np.ndarray]


def binned(x: np.ndarray, known: np.ndarray, max_bins: int) -> Bins:
    """All rows of ``x`` by thresholds from the ``known`` ones."""
    cuts = [cut_points(column[known], max_bins) for column in x.T]
    places = [np.searchsorted(c, column, side="left").astype(np.uint8) for c, column in zip(cuts, x.T, strict=True)]
    return Bins(places, cuts)


@dataclass
class Grown:
    """Nodes of a tree by number, parents first; ``yes`` and ``no`` of a leaf are itself."""

    feature: np.ndarray
    threshold: np.ndarray
    yes: np.ndarray
    no: np.ndarray
    value: np.ndarray
    depth: np.ndarray


def _variance(weight, total, squares):
    with np.errstate(divide="ignore", invalid="ignore"):
        return (squares - total * total / weight) / weight


def _best_splits(bins: Bins, rows, node, k: int, sums, weights, allowed, least: float):
    """(gain, feature, place) of the best split of each of ``k`` nodes over weighted ``rows``; the first on ties."""
    count, total, squares = sums
    impurity = _variance(count, total, squares)
    w, wy, wyy = weights
    gain, feature, place = np.full(k, -np.inf), np.zeros(k, dtype=np.int64), np.zeros(k, dtype=np.int64)
    for f, cuts in enumerate(bins.cuts):
        width = len(cuts) + 1
        if width < 2:
            continue
        if allowed is None:
            some, key = slice(None), node * width + bins.places[f][rows]
        else:
            some = allowed[node, f]
            key = node[some] * width + bins.places[f][rows[some]]
        left = [np.bincount(key, v[some], k * width).reshape(k, width).cumsum(axis=1)[:, :-1] for v in (w, wy, wyy)]
        right = [s[:, None] - v for s, v in zip(sums, left, strict=True)]
        with np.errstate(invalid="ignore"):  # a side without rows
            found = impurity[:, None] - left[0] / count[:, None] * _variance(*left) - right[0] / count[:, None] * _variance(*right)
        found[(left[0] < least) | (right[0] < least)] = -np.inf
        if allowed is not None:
            found[~allowed[:, f]] = -np.inf
        at = found.argmax(axis=1)
        best = found[np.arange(k), at]
        better = best > gain
        gain[better], feature[better], place[better] = best[better], f, at[better]
    return gain, feature, place


def grow(
    bins: Bins, y: np.ndarray, weight: np.ndarray, depth: int, least: int = 1, min_gain: float = 0.0, subset: int | None = None,
    rng: np.random.Generator | None = None,
) -> tuple[Grown, np.ndarray]:
    """A tree over the rows with a weight, and what it predicts for every row, also for those without one.

    ``subset`` features, drawn by ``rng``, are tried at a node (None: all).
    """
    m = len(bins.cuts)
    predicted = np.zeros(len(y))
    live, node, k, first, level = np.arange(len(y)), np.zeros(len(y), dtype=np.int64), 1, 0, 0
    levels: list[tuple] = []
    while k:
        inside = weight[live] > 0
        rows, at = live[inside], node[inside]
        w = weight[rows].astype(float)
        wy = w * y[rows]
        wyy = wy * y[rows]
        count, total, squares = (np.bincount(at, v, k) for v in (w, wy, wyy))
        value = total / count
        gain, feature, place = np.full(k, -np.inf), np.zeros(k, dtype=np.int64), np.zeros(k, dtype=np.int64)
        open_ = (count >= 2 * least) & (np.abs(_variance(count, total, squares)) >= EPSILON) if level < depth else np.zeros(k, dtype=bool)
        candidates = np.flatnonzero(open_)
        for start in range(0, len(candidates), NODES_AT_ONCE):
            some = candidates[start : start + NODES_AT_ONCE]
            number = np.full(k, -1)
            number[some] = np.arange(len(some))
            here = number[at]
            kept = slice(None) if len(some) == k else here >= 0
            allowed = None
            if subset is not None and subset < m:
                allowed = np.zeros((len(some), m), dtype=bool)
                drawn = rng.random((len(some), m)).argpartition(subset - 1, axis=1)[:, :subset]
                np.put_along_axis(allowed, drawn, True, axis=1)
            sums = (count[some], total[some], squares[some])
            gain[some], feature[some], place[some] = _best_splits(
                bins, rows[kept], here[kept], len(some), sums, (w[kept], wy[kept], wyy[kept]), allowed, least
            )
        split = (gain > 0) & (gain >= min_gain)
        order = np.cumsum(split) - 1
        numbers = np.arange(first, first + k)
        yes = np.where(split, first + k + 2 * order, numbers)
        no = np.where(split, yes + 1, numbers)
        limits = np.array([bins.cuts[f][p] if s else 0.0 for s, f, p in zip(split.tolist(), feature.tolist(), place.tolist(), strict=True)])
        levels.append((np.where(split, feature, 0), limits, yes, no, value, np.full(k, level)))
        moving = split[node]
        stay = ~moving
        predicted[live[stay]] = value[node[stay]]
        live, node = live[moving], node[moving]
        f, p, below = feature[node], place[node], np.zeros(len(live), dtype=bool)
        for g in np.unique(feature[split]):
            mine = f == g
            below[mine] = bins.places[g][live[mine]] <= p[mine]
        node = 2 * order[node] + ~below
        first, k, level = first + k, 2 * int(split.sum()), level + 1
    return Grown(*(np.concatenate(c) for c in zip(*levels, strict=True))), predicted


# -- MLlib's bags: each partition draws by a generator of its own ------------------------------------------------


def _rotated(x: int, r: int) -> int:
    return ((x << r) | (x >> (32 - r))) & 0xFFFFFFFF


def _murmur(data: bytes, seed: int) -> int:
    """MurmurHash3 (32 bits) of whole little-endian words."""
    h = seed
    for k in range(0, len(data), 4):
        word = int.from_bytes(data[k : k + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        h ^= _rotated(word, 15) * 0x1B873593 & 0xFFFFFFFF
        h = (_rotated(h, 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def _state(seed: int) -> int:
    data = (seed & 0xFFFFFFFFFFFFFFFF).to_bytes(8, "big")
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


def samples(partition: np.ndarray, seeds: Sequence[int], rate: float) -> np.ndarray:
    """One row a seed: which rows its tree has, by the generators of MLlib's bags without replacement."""
    out = np.zeros((len(seeds), len(partition)), dtype=bool)
    for p in np.unique(partition):
        state = np.array([_state(s + int(p) + 1) for s in seeds], dtype=np.uint64)

        def bits(n):
            nonlocal state
            state = state ^ (state << np.uint64(21))
            state = state ^ (state >> np.uint64(35))
            state = state ^ (state << np.uint64(4))
            return state & np.uint64((1 << n) - 1)

        for row in np.flatnonzero(partition == p):
            high = bits(26) << np.uint64(27)
            out[:, row] = (high + bits(27)) * 2.0**-53 < rate
    return out


# -- fits in tasks ----------------------------------------------------------------------------------------------


def sides(rows: Rows, train: np.ndarray, test: np.ndarray) -> tuple[Rows, np.ndarray]:
    """The rows of a fit, and which of them train; the others are tested. Neither side may be empty."""
    if not train.any() or not test.any():
        raise ValueError(f"a fold has {int(train.sum())} rows to train on and {int(test.sum())} to test on")
    kept = train | test
    return Rows(rows.x[kept], rows.y[kept], rows.fold[kept], rows.partition[kept]), train[kept]


def boosted_maes(rows: Rows, train: np.ndarray, s: dict, counts: Sequence[int]) -> list[float]:
    """MAE on the other rows of the first n trees of a boosted fit over the ``train`` ones, for each n of ``counts``."""
    bins, weight, n = binned(rows.x, train, s["maxBins"]), train.astype(float), max(counts)
    at, bags = np.flatnonzero(train), None
    predicted, maes = np.zeros(len(rows.y)), []
    for t in range(n):
        if s["subsamplingRate"] < 1:
            if t % 50 == 0:
                seeds = [s["seed"] + k for k in range(t, min(n, t + 50))]
                bags = samples(rows.partition[at], seeds, s["subsamplingRate"])
            weight[at] = bags[t % 50]
        away = rows.y - predicted
        if t == 0:
            target = rows.y
        else:
            target = 2 * away if s["lossType"] == "squared" else np.where(away < 0, -1.0, 1.0)
        _, values = grow(bins, target, weight, s["maxDepth"], s["minInstancesPerNode"], s["minInfoGain"])
        predicted = predicted + (s["stepSize"] if t else 1.0) * values
        maes.append(float(np.abs(rows.y - predicted)[~train].mean()))
    return [maes[k - 1] for k in counts]


def boosted_scores(estimator: GBTRegressor, df: DataFrame, jobs: Sequence[tuple[dict, list[int], int]], fold: str = "fold") -> list[list[float]]:
    """For each (parameters, numbers of trees, fold): the MAEs on the fold of a fit on the folds before."""
    context = df.sparkSession.sparkContext
    shared = context.broadcast(rows_of(df, estimator.getFeaturesCol(), estimator.getLabelCol(), fold))

    def run(job: tuple) -> list[float]:
        s, counts, at = job
        rows = shared.value
        return boosted_maes(*sides(rows, rows.fold < at, rows.fold == at), s, counts)

    try:
        fits = [(settings(estimator, params), counts, at) for params, counts, at in jobs]
        return context.parallelize(fits, max(1, len(fits))).map(run).collect()
    finally:
        shared.destroy()


def forest_trees(rows: Rows, train: np.ndarray, s: dict, numbers: Iterable[int]) -> Iterator[tuple[int, Grown, np.ndarray]]:
    """(number, tree, its predictions for all rows) of trees of a forest; each draws by its own number."""
    bins, m = binned(rows.x, train, s["maxBins"]), rows.x.shape[1]
    subset, rate = SUBSETS[s["featureSubsetStrategy"]](m, s["numTrees"]), s["subsamplingRate"]
    at = np.flatnonzero(train)
    for number in numbers:
        rng, weight = np.random.default_rng([s["seed"] & 0xFFFFFFFFFFFFFFFF, number]), train.astype(float)
        while True:  # a bag without rows is drawn again
            if s["bootstrap"]:
                weight[at] = rng.poisson(rate, len(at))
            elif rate < 1:
                weight[at] = rng.random(len(at)) < rate
            if weight.any():
                break
        grown, values = grow(bins, rows.y, weight, s["maxDepth"], s["minInstancesPerNode"], s["minInfoGain"], subset, rng)
        yield number, grown, values


def _runs(n: int) -> list[range]:
    return [range(k, min(n, k + TREES_PER_TASK)) for k in range(0, n, TREES_PER_TASK)]


def forest_errors(estimator: RandomForestRegressor, df: DataFrame, grid: Sequence[dict], n_folds: int, fold: str) -> list[list[tuple[int, float, float]]]:
    """For each set and fold, of a forest on the other folds: rows, sum of squared and of absolute errors on the fold.

    A task grows some trees and keeps the sum of their predictions only, so that no task and no driver holds a forest.
    """
    sets = [settings(estimator, params) for params in grid]
    jobs = [(k, s, f, run) for k, s in enumerate(sets) for f in range(n_folds) for run in _runs(s["numTrees"])]
    # the longest first: trees are as long as their leaves are small
    jobs.sort(key=lambda job: (job[1]["minInstancesPerNode"], -job[1]["maxDepth"]))
    context = df.sparkSession.sparkContext
    shared = context.broadcast(rows_of(df, estimator.getFeaturesCol(), estimator.getLabelCol(), fold))

    def run(job: tuple) -> tuple[tuple[int, int], tuple[int, np.ndarray]]:
        k, s, f, numbers = job
        mine, train = sides(shared.value, shared.value.fold != f, shared.value.fold == f)
        total = np.zeros(int((~train).sum()))
        for _, _, values in forest_trees(mine, train, s, numbers):
            total += values[~train]
        return (k, f), (len(numbers), total)

    def scored(found: tuple) -> tuple:
        (k, f), (n, total) = found
        error = total / n - shared.value.y[shared.value.fold == f]
        return k, f, len(error), float(error @ error), float(np.abs(error).sum())

    try:
        sums = context.parallelize(jobs, len(jobs)).map(run).reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), max(1, len(grid) * n_folds))
        found = {(k, f): rest for k, f, *rest in sums.map(scored).collect()}
    finally:
        shared.destroy()
    return [[tuple(found[k, f]) for f in range(n_folds)] for k in range(len(grid))]


class GrownForestModel(Model, HasFeaturesCol, HasPredictionCol, _RandomForestRegressorParams, DefaultParamsReadable, DefaultParamsWritable):
    """A forest whose node table is below the shared folder."""

    path = Param(Params._dummy(), "path", "folder of the node table", typeConverter=TypeConverters.toString)

    def __init__(self, path: str | None = None):
        super().__init__()
        if path is not None:
            self._set(path=path)

    def nodes(self, spark) -> DataFrame:
        return spark.read.parquet(self.getOrDefault("path"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        grown = trees.ensemble(self.nodes(dataset.sparkSession).toArrow().to_pandas())
        values = vector_to_array(self.getFeaturesCol())
        row = [values[i] for i in range(int(grown.feature.max()) + 1)]
        return dataset.withColumn(self.getPredictionCol(), trees.predictions(grown, row))


def forest(estimator: RandomForestRegressor, df: DataFrame, params: dict | None = None) -> GrownForestModel:
    """The forest over all rows, grown in tasks that write their trees' nodes."""
    spark, s = df.sparkSession, settings(estimator, params)
    rows = rows_of(df, estimator.getFeaturesCol(), estimator.getLabelCol())
    if not len(rows.y):
        raise ValueError("a forest without rows")
    shared, path, runs = spark.sparkContext.broadcast(rows), work_path(spark, "forest"), _runs(s["numTrees"])

    def grown(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in batch["id"]:
                every = np.ones(len(shared.value.y), dtype=bool)
                for number, tree, _ in forest_trees(shared.value, every, s, runs[part]):
                    yield pd.DataFrame(
                        {
                            "tree": number, "node": np.arange(len(tree.value)), "depth": tree.depth, "feature": tree.feature,
                            "threshold": tree.threshold, "strict": False, "yes": tree.yes, "no": tree.no, "missing": tree.no,
                            "value": tree.value / s["numTrees"],
                        }
                    )

    parts = spark.range(0, len(runs), numPartitions=len(runs))
    try:
        parts.mapInPandas(grown, trees.NODES).write.parquet(path)
    finally:
        shared.destroy()
    return estimator.copy(params or {})._copyValues(GrownForestModel(path))
