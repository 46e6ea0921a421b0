import datetime as dt
import math
import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tidecast.learning import models, search, validation
from tidecast.names import COUNT, HOUR, TARGET, ZONE
from tidecast.operators.aggregates import regression_metrics
from tidecast.operators.windows import assign_folds
from tidecast.plans import training
from tidecast.plans.features import add_calendar, next_hour_rows, series_dataset, split_by_time
from tidecast.workload import q_learning

START = dt.datetime(2024, 1, 1)
FEATURES = ["hour_of_day", "is_weekend", "lag_1_ride_count", "lag_24_ride_count", "rolling_mean_3h"]


@pytest.fixture(scope="module")
def data(spark):
    """A demand series with a daily cycle, so that trees can beat persistence."""
    rng = random.Random(0)
    rows = []
    for z in (1, 2, 3):
        for h in range(24 * 20):
            level = 40 * z * (1.2 + math.sin(h % 24 / 24 * 2 * math.pi))
            rows.append((START + dt.timedelta(hours=h), z, int(level + rng.gauss(0, 4))))
    series = spark.createDataFrame(rows, f"{HOUR} timestamp_ntz, {ZONE} int, {COUNT} bigint")
    df = series_dataset(add_calendar(series)).withColumn("zone", F.col(ZONE)).persist()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def cut():
    return F.lit(START + dt.timedelta(days=15)).cast("timestamp_ntz")


def test_persistence_is_a_pipeline_stage(spark, data, tmp_path):
    model = Pipeline(stages=[models.PersistenceForecaster(inputCol=COUNT)]).fit(data)
    model.save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    rows = again.transform(data).select(COUNT, "prediction").collect()
    assert rows and all(r[0] == r[1] for r in rows)


@pytest.mark.parametrize("kind", ["gbt_absolute", "tree", "forest"])
def test_trees_beat_persistence(data, cut, kind):
    estimator = {
        "gbt_absolute": lambda: models.gbt_absolute(maxIter=15, maxDepth=4),
        "tree": lambda: models.tree(maxDepth=6),
        "forest": lambda: models.forest(numTrees=10, maxDepth=6),
    }[kind]()
    train, test = split_by_time(data, cut)
    model = models.pipeline(FEATURES, estimator).fit(train)
    scored = model.transform(test)
    own = regression_metrics(scored, TARGET, "prediction").first().mae
    base = regression_metrics(scored, TARGET, "lag_1_ride_count").first().mae
    assert own < 0.6 * base


def test_folds_never_train_on_later_rows(data):
    folds = assign_folds(data, 4, "chronological")
    edges = folds.groupBy("fold").agg(F.min(HOUR).alias("lo"), F.max(HOUR).alias("hi")).orderBy("fold").collect()
    assert [e.fold for e in edges] == [0, 1, 2, 3, 4]
    assert all(a.hi < b.lo for a, b in zip(edges, edges[1:]))


def test_fold_scores_of_persistence(data):
    folds = assign_folds(data, 3, "chronological")
    scores = {r.fold: r for r in validation.fold_scores(models.PersistenceForecaster(), folds, 3).collect()}
    want = regression_metrics(folds, TARGET, "lag_1_ride_count", by=["fold"]).where("fold > 0").collect()
    assert {r.fold: (r.n, pytest.approx(r.mae)) for r in want} == {k: (r.n, r.mae) for k, r in scores.items()}


def test_two_stage_search_keeps_the_best_rate(data):
    vectors = models.checked_matrix(assign_folds(data, 2), FEATURES).select("features", TARGET, "fold").persist()
    gbt = models.gbt_absolute(maxIter=4)
    best, trials, params = validation.two_stage_search(
        gbt, vectors, gbt.stepSize, [0.05, 0.5], {gbt.maxDepth: 3}, [{gbt.maxDepth: 2}, {gbt.maxDepth: 4}], 2
    )
    vectors.unpersist()
    stage_one, stage_two = trials[:2], trials[2:]
    rate = min(stage_one, key=lambda t: t.cv_mae_mean).params["stepSize"]
    assert all(t.params["stepSize"] == rate for t in stage_two)
    assert best.cv_mae_mean == min(t.cv_mae_mean for t in stage_two)
    assert params[gbt.stepSize] == rate and len(best.fold_maes) == 2


def test_random_search_samples_without_repetition():
    class P:
        def __init__(self, name):
            self.name = name

        def __hash__(self):
            return hash(self.name)

        def __eq__(self, other):
            return self.name == other.name

    space = {P("a"): [1, 2, 3], P("b"): [1, 2, 3, 4]}
    drawn = search.sample_params(space, 10)
    assert len({tuple(sorted((p.name, x) for p, x in d.items())) for d in drawn}) == 10
    assert drawn == search.sample_params(space, 10)
    assert len(search.sample_params(space, 99)) == 12


def test_null_features_are_refused(spark, data):
    broken = data.withColumn("rolling_mean_3h", F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="rolling_mean_3h"):
        models.checked_matrix(broken, FEATURES)


def test_importance_sums_to_one(spark, data):
    model = models.tree(maxDepth=5).fit(models.checked_matrix(data, FEATURES))
    rows = models.importance_table(spark, model, FEATURES).collect()
    assert sum(r.importance for r in rows) == pytest.approx(1.0)
    assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5]


def test_training_run_registers_logs_and_scores(spark, data, cut, tmp_path):
    root = str(tmp_path)
    result = training.train(
        data, FEATURES, cut, root, "demand", search=training.Search([{"maxIter": 3, "maxDepth": 3}], (0.3,), {"maxIter": 3, "maxDepth": 3}),
        n_folds=2, trained_at="t", created=7,
    )
    assert result.version == 1 and result.metrics["test_mae"] > 0
    log = spark.read.parquet(f"{root}/runs")
    assert {r.kind for r in log.collect()} == {"param", "metric"}
    assert log.select("parent_run_id").distinct().count() == 1
    newest = data.agg(F.max(HOUR)).first()[0]
    zones = spark.createDataFrame([(1,), (2,), (3,)], "LocationID int")
    rows = next_hour_rows(data, zones)
    assert {r[HOUR] for r in rows.collect()} == {newest}
    scored = training.score_next_hour(rows, result.model, FEATURES).collect()
    assert len(scored) == 3 and all(isinstance(r.predicted_ride_count, int) for r in scored)


@pytest.fixture(scope="module")
def fold_vectors(data):
    vectors = models.checked_matrix(assign_folds(data, 2), FEATURES).select("features", TARGET, "fold").persist()
    yield vectors
    vectors.unpersist()


def test_one_long_fit_scores_shorter_ones(fold_vectors):
    """Sets that differ in the number of trees only: the same errors as fits of their own."""
    gbt = models.gbt_absolute(maxDepth=3, subsamplingRate=0.8)
    grid = [{gbt.maxIter: n, gbt.minInstancesPerNode: m} for n in (2, 5, 8) for m in (1, 4)]
    trials = validation.grid_trials(gbt, fold_vectors, grid, 2)
    for params, trial in zip(grid, trials, strict=True):
        assert trial.params == {p.name: x for p, x in params.items()}
        alone = {r.fold: r.mae for r in validation.fold_scores(gbt, fold_vectors, 2, params).collect()}
        assert trial.fold_maes == pytest.approx([alone[1], alone[2]])
        assert trial.cv_mae_mean == pytest.approx(sum(alone.values()) / 2)


def test_published_searches_have_all_sets():
    searches = training.published_searches()
    assert [len(searches[k].second) for k in ("absolute", "leafmin", "batch")] == [16, 32, 32]
    assert {p["maxIter"] for p in searches["absolute"].second} == {200, 300} and searches["absolute"].first["maxIter"] == 200
    assert len(searches["absolute"].rates) == len(searches["batch"].rates) == 5 and not searches["leafmin"].rates
    fewer = training.published_searches(0.01)
    assert all(len({str(p) for p in s.second}) == len(s.second) for s in searches.values())
    assert {p["maxIter"] for p in fewer["absolute"].second} == {2, 3}


def test_other_estimators_are_searched_too(fold_vectors):
    forest = models.forest(numTrees=3)
    best, trials, params = validation.grid_search(forest, fold_vectors, [{forest.maxDepth: d} for d in (1, 4)], 2)
    assert params == {forest.maxDepth: 4} and best is trials[1]


def test_pl_train_searches_all_published_trees(spark, monkeypatch):
    seen = []

    class Done(Exception):
        pass

    def watched(*_, search, n_folds, **__):
        seen.append((search, n_folds))
        if len(seen) == 2:
            raise Done
        empty = spark.createDataFrame([], "model_name string, training_data_size long, feature_count int, cross_validation struct<cv_folds:double>")
        best = validation.Trial({}, 1.0, 0.0)
        return training.TrainingResult(None, 1, best, [best], {}, empty)

    monkeypatch.setattr(q_learning.v, "stored_dataset", lambda *_: None)
    monkeypatch.setattr(q_learning.training, "train", watched)
    with pytest.raises(Done):
        q_learning.pl_train(spark, "")
    published = training.published_searches()
    assert seen == [(published["absolute"], 5), (published["leafmin"], 5)]
