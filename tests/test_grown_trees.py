"""Trees grown in tasks: MLlib's where nothing is drawn, whole forests, and MLlib itself for more rows."""

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import functions as F

from tidecast.learning import growth, models, search, validation
from tidecast.names import HOUR, TARGET, ZONE
from tidecast.workload import q_learning

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def vectors(spark):
    """600 rows in 3 partitions: few and many values, a constant feature, and equal targets."""
    rng = np.random.default_rng(0)
    a, b, c = rng.integers(0, 5, 600), rng.normal(size=600), rng.integers(-40, 40, 600)
    target = (3 * a + (b > 0) * 4 + c // 10 + rng.integers(0, 4, 600)).astype(float)
    rows = [(float(x), float(y), float(z), 1.0, float(t), k % 3) for k, (x, y, z, t) in enumerate(zip(a, b, c, target))]
    df = spark.createDataFrame(rows, f"a double, b double, c double, d double, {TARGET} double, fold int").repartition(3)
    df = models.assembler(NAMES).transform(df).persist()
    yield df
    df.unpersist()


def predicted(model, df) -> np.ndarray:
    return np.array([r[0] for r in model.transform(df).select("prediction").collect()])


@pytest.mark.parametrize("depth, least, gain", [(30, 1, 0.0), (4, 1, 0.0), (10, 7, 0.0), (10, 1, 0.3)])
def test_a_tree_is_the_one_of_mllib(vectors, depth, least, gain):
    tree = models.forest(numTrees=1, maxDepth=depth, minInstancesPerNode=least, minInfoGain=gain, bootstrap=False)
    rows = growth.rows_of(vectors, models.FEATURES, TARGET)
    ((_, grown, values),) = growth.forest_trees(rows, np.ones(600, dtype=bool), growth.settings(tree), [0])
    assert values == pytest.approx(predicted(tree.fit(vectors), vectors), abs=1e-9)
    assert predicted(growth.forest(tree, vectors), vectors) == pytest.approx(values, abs=1e-9)
    assert grown.depth.max() <= depth


@pytest.mark.parametrize("rate, loss", [(1.0, "absolute"), (0.7, "absolute"), (0.7, "squared")])
def test_boosting_is_the_one_of_mllib(vectors, rate, loss):
    gbt = models.gbt_absolute(maxDepth=3, subsamplingRate=rate, lossType=loss)
    scored = growth.boosted_scores(gbt, vectors, [({gbt.maxIter: 60}, [1, 30, 60], 2)])
    model = gbt.copy({gbt.maxIter: 60}).fit(vectors.where("fold < 2"))
    assert scored[0] == pytest.approx(validation.staged_maes(model, vectors.where("fold = 2"), [1, 30, 60]), abs=1e-9)


def test_all_trees_of_a_forest_are_grown(vectors, monkeypatch):
    monkeypatch.setattr(growth, "TREES_PER_TASK", 2)
    forest = models.forest(maxDepth=4, featureSubsetStrategy="sqrt")
    grid = [{forest.numTrees: 7}, {forest.numTrees: 4, forest.bootstrap: False}]
    errors = growth.forest_errors(forest, vectors, grid, 3, "fold")
    rows = growth.rows_of(vectors, models.FEATURES, TARGET, "fold")
    for params, folds in zip(grid, errors, strict=True):
        s = growth.settings(forest, params)
        for k, (n, squares, distances) in enumerate(folds):
            train = rows.fold != k
            values = [v for _, _, v in growth.forest_trees(rows, train, s, range(s["numTrees"]))]
            assert len({v.tobytes() for v in values}) == s["numTrees"]
            away = (np.mean(values, axis=0) - rows.y)[~train]
            assert (n, squares, distances) == (200, pytest.approx(away @ away), pytest.approx(np.abs(away).sum()))
    model = growth.forest(forest, vectors, grid[0])
    assert model.getOrDefault("numTrees") == 7 and model.nodes(vectors.sparkSession).select("tree").distinct().count() == 7


def test_a_search_over_forests_is_near_that_of_mllib(vectors, monkeypatch):
    forest = models.forest(maxDepth=5)
    space = {forest.numTrees: [20, 30], forest.minInstancesPerNode: [1, 40]}
    keyed = vectors.withColumn("k", F.monotonically_increasing_id())
    found = search.random_search(forest, keyed, space, ["a", "b", "c"], n=3)
    assert isinstance(found.bestModel, growth.GrownForestModel) and found.getNumFolds() == 3 and len(found.getEstimatorParamMaps()) == 3
    monkeypatch.setattr(growth, "VALUES_IN_TASK", 600 * 4 - 1)
    other = search.random_search(forest, keyed, space, ["a", "b", "c"], n=3, parallelism=3)
    assert isinstance(other.bestModel, RandomForestRegressionModel)
    assert found.avgMetrics == pytest.approx(other.avgMetrics, rel=0.1) and found.stdMetrics == pytest.approx(other.stdMetrics, abs=0.3)
    assert found.bestModel.getOrDefault("minInstancesPerNode") == other.bestModel.getOrDefault("minInstancesPerNode") == 1


def test_what_is_not_grown_here_is_left_to_mllib(vectors):
    forest, gbt = models.forest(), models.gbt_absolute()
    assert growth.grows(forest, vectors, [{}]) and growth.grows(gbt, vectors, [{}])
    assert not growth.grows(models.tree(), vectors, [{}])
    assert not growth.grows(forest, vectors, [{}, {forest.featureSubsetStrategy: "3"}])
    assert not growth.grows(gbt, vectors, [{gbt.weightCol: "a"}])
    assert not growth.grows(forest, vectors.where("fold > 9"), [{}])


def test_missing_targets_and_empty_folds_are_refused(vectors):
    gbt = models.gbt_absolute(maxIter=2)
    with pytest.raises(ValueError, match="target"):
        growth.rows_of(vectors.withColumn(TARGET, F.when(F.col("a") > 0, F.col(TARGET))), models.FEATURES, TARGET)
    with pytest.raises(Exception, match="rows to train on"):
        growth.boosted_scores(gbt, vectors, [({}, [2], 0)])


def test_the_registered_random_search_has_all_published_trees(spark, monkeypatch):
    seen = {}

    class Done(Exception):
        pass

    def watched(estimator, train, space, keys, n, n_folds, parallelism):
        seen.update({p.name: list(x) for p, x in space.items()}, n=n, n_folds=n_folds, keys=keys)
        raise Done

    monkeypatch.setattr(q_learning, "_vectors", lambda *_: (None, None))
    monkeypatch.setattr(q_learning.search, "random_search", watched)
    with pytest.raises(Done):
        q_learning.ml_random_search(spark, "")
    assert seen == {
        "numTrees": [200, 400, 600, 800, 1000, 1200, 1400, 1600, 1800, 2000], "featureSubsetStrategy": ["all", "sqrt"],
        "maxDepth": [10, 20, 30], "minInstancesPerNode": [1, 2, 4, 10, 20], "bootstrap": [True, False], "n": 10, "n_folds": 3,
        "keys": [HOUR, ZONE],
    }
