"""Model training, validation, scoring and registry."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidecast.functions.scalars import bucket_label, flag
from tidecast.functions.timeutil import plus_hours
from tidecast.learning import models, registry, search, trees, validation
from tidecast.names import HOUR, TARGET, WEATHER_COLUMNS, ZONE, lag_name
from tidecast.operators import aggregates as a
from tidecast.operators.windows import assign_folds
from tidecast.plans import fares, training
from tidecast.plans import features as feat
from tidecast.sources.contracts import DATASET_FEATURES, REGISTRY, STORE_FEATURES
from tidecast.sources.storage import materialise, work_path
from tidecast.workload import views as v
from tidecast.workload.q_features import STORE_CTES, store
from tidecast.workload.q_relational import METRICS_SQL, rounded
from tidecast.workload.q_rows import ntz
from tidecast.workload.registry import query

CUT = "2024-01-22 23:00:00"
SIDE_SQL = f"CASE WHEN hourly_timestamp <= TIMESTAMP '{CUT}' THEN 'train' ELSE 'test' END"
SCORES = ("mae", "mse", "rmse", "r2")
#: Settings of the registered runs beside the library's defaults, which are the published ones; tests take less.
SETTINGS: dict = {}
#: ``ml_two_stage_grid`` tries all published sets on all folds with this share of the published numbers of trees.
SEARCH_TREES = 1 / 20


def _sides(spark, sf):
    return feat.split_by_time(v.dataset(spark, sf), ntz(CUT))


def _vectors(spark, sf, rows_per_partition: int = training.ROWS_PER_PARTITION):
    """(train, test) feature vectors of the dataset, each side written once.

    The training side has partitions for its own rows: later hours add none, so neither do they add tasks to the
    many small jobs of a fit.
    """
    data = v.dataset(spark, sf).select(HOUR, ZONE, *DATASET_FEATURES, TARGET)
    data = data.withColumns({c: F.col(c).cast("double") for c in [*DATASET_FEATURES, TARGET]})
    train, test = feat.split_by_time(materialise(data, "learning"), ntz(CUT))
    train = materialise(training.few_partitions(train, rows_per_partition), "learning-train")
    return tuple(models.assembler(DATASET_FEATURES).transform(side) for side in (train, test))


@query(
    "ml_split_time",
    f"SELECT {SIDE_SQL} AS side, count(*) AS n, sum(target) AS target_sum FROM dataset GROUP BY 1",
)
def ml_split_time(spark, sf):
    train, test = feat.split_by_time(v.stored_dataset(spark, sf), ntz(CUT))
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.sum(TARGET).alias("target_sum"))


@query(
    "ml_split_random",
    """SELECT CASE WHEN ('0x' || substr(md5('42|' || CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0 < 0.67
              THEN 'train' ELSE 'test' END AS side, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
       FROM orders GROUP BY 1""",
)
def ml_split_random(spark, sf):
    train, test = search.split_random(v.table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query(
    "ml_assemble",
    "SELECT PULocationID, 20 AS n_features, count(*) AS n, round(sum("
    + " + ".join(DATASET_FEATURES)
    + "), 3) AS feature_sum FROM dataset GROUP BY PULocationID",
)
def ml_assemble(spark, sf):
    matrix = models.checked_matrix(v.stored_dataset(spark, sf), DATASET_FEATURES)
    row = vector_to_array(models.FEATURES)
    return (
        matrix.select(ZONE, F.size(row).alias("k"), F.aggregate(row, F.lit(0.0), lambda s, x: s + x).alias("s"))
        .groupBy(ZONE)
        .agg(F.max("k").alias("n_features"), F.count(F.lit(1)).alias("n"), F.round(F.sum("s"), 3).alias("feature_sum"))
    )


@query("ml_persistence", f"SELECT PULocationID, {METRICS_SQL} FROM errors GROUP BY PULocationID")
def ml_persistence(spark, sf):
    data = v.dataset(spark, sf)
    scored = models.PersistenceForecaster().fit(data).transform(data)
    return rounded(a.regression_metrics(scored, TARGET, "prediction", by=[ZONE]), *SCORES)


@query(
    "ml_evaluate",
    f"SELECT {SIDE_SQL} AS side, {METRICS_SQL} FROM errors GROUP BY 1",
)
def ml_evaluate(spark, sf):
    train, test = feat.split_by_time(v.stored_dataset(spark, sf), ntz(CUT))
    model = models.PersistenceForecaster().fit(train)
    return rounded(validation.evaluate(model, train, test), *SCORES)


@query(
    "ml_timeseries_cv",
    """WITH p AS (SELECT *, row_number() OVER (ORDER BY PULocationID, hourly_timestamp) - 1 AS pos, count(*) OVER () AS tot FROM errors),
       f AS (SELECT *, CASE WHEN pos < tot - 5 * (tot // 6) THEN 0 ELSE (pos - (tot - 5 * (tot // 6))) // (tot // 6) + 1 END AS fold FROM p)
       SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n, round(avg(absolute_error), 6) AS mae FROM f WHERE fold > 0 GROUP BY fold""",
)
def ml_timeseries_cv(spark, sf):
    """Persistence on the five positional folds: the fold machinery checked against SQL."""
    data = v.dataset(spark, sf).select(HOUR, ZONE, lag_name(1), TARGET)
    folds = materialise(assign_folds(data, 5, "positional"), "folds")
    return rounded(validation.fold_scores(models.PersistenceForecaster(), folds, 5), "mae")


def _fit_query(name, make):
    """Fit on the earlier days, test on the later ones beside the persistence forecast.

    SQL cannot grow the trees, but it checks the test rows, the persistence error
    and that the model's error is smaller. Squared error is compared because most
    cells of the small tables are empty, where absolute error rewards predicting 0.
    """

    @query(
        name,
        f"""SELECT '{name}' AS model, count(*) AS n, round(sqrt(avg(absolute_error ** 2)), 6) AS persistence_rmse,
                   1 AS beats_persistence
            FROM errors WHERE hourly_timestamp > TIMESTAMP '{CUT}'""",
    )
    def run(spark, sf):
        train, test = _vectors(spark, sf)
        scored = make().fit(train).transform(test)
        own = a.regression_metrics(scored, TARGET, "prediction")
        base = a.regression_metrics(scored, TARGET, lag_name(1))
        return base.select(
            F.lit(name).alias("model"),
            "n",
            F.round("rmse", 6).alias("persistence_rmse"),
            (own.select("rmse").scalar() < F.col("rmse")).cast("int").alias("beats_persistence"),
        )

    return run


# estimators need a running session, so they are built when the query runs
_FITS = {
    "ml_gbt_absolute": lambda: models.gbt_absolute(**SETTINGS.get("boosting", {})),
    "ml_gbt_leafmin": lambda: models.gbt_leafmin(**SETTINGS.get("boosting", {})),
    "ml_gbt_squared": lambda: models.gbt_squared(**SETTINGS.get("boosting", {})),
    "ml_tree": lambda: models.tree(),
    "ml_forest": lambda: models.forest(**SETTINGS.get("forest", {})),
}
for _name, _make in _FITS.items():
    _fit_query(_name, _make)


# the training side in five chronological folds behind the rows that are trained on first
FOLDS_SQL = f"""train_hours AS (
    SELECT hourly_timestamp, dense_rank() OVER (ORDER BY hourly_timestamp) - 1 AS pos, count(*) OVER () AS nh
    FROM (SELECT DISTINCT hourly_timestamp FROM dataset WHERE hourly_timestamp <= TIMESTAMP '{CUT}')),
  folds AS (SELECT d.*, CAST(CASE WHEN pos < nh - 5 * (nh // 6) THEN 0 ELSE (pos - (nh - 5 * (nh // 6))) // (nh // 6) + 1 END AS INTEGER) AS fold
            FROM dataset d JOIN train_hours USING (hourly_timestamp))"""


@query(
    "ml_timeseries_cv_gbt",
    f"""WITH {FOLDS_SQL} SELECT fold, count(*) AS n, round(avg(abs(target - lag_1_ride_count)), 6) AS persistence_mae, 1 AS in_range
        FROM folds WHERE fold > 0 GROUP BY fold""",
)
def ml_timeseries_cv_gbt(spark, sf):
    """Five expanding folds of the boosted trees beside the persistence forecast on the same rows.

    SQL cannot grow the trees; it checks the folds and that an error lies between 0 and the largest target. On
    nearly empty series the trees may well be worse than persistence.
    """
    train, _ = _vectors(spark, sf)
    folds = assign_folds(train.select(HOUR, ZONE, models.FEATURES, lag_name(1), TARGET), 5, "chronological").persist()
    try:
        gbt = models.gbt_absolute(**SETTINGS.get("boosting", {}))
        (trial,) = validation.grid_trials(gbt, folds, [{}], 5)
        base = a.regression_metrics(folds.where("fold > 0"), TARGET, lag_name(1), by=["fold"]).collect()
        most = folds.agg(F.max(TARGET)).first()[0]
    finally:
        folds.unpersist()
    rows = [(r["fold"], r["n"], round(r["mae"], 6), int(0 < trial.fold_maes[r["fold"] - 1] <= most)) for r in base]
    return spark.createDataFrame(rows, "fold int, n long, persistence_mae double, in_range int")


DEPTHS = (1, 2, 5, 8, 10, 15, 20, 30)


@query(
    "ml_depth_sweep",
    f"""SELECT CAST(depth AS INTEGER) AS depth, side, n, CAST(CASE side WHEN 'train' THEN 1 ELSE -1 END AS INTEGER) AS fits_no_worse
        FROM (SELECT unnest({list(DEPTHS)}) AS depth), (SELECT {SIDE_SQL} AS side, count(*) AS n FROM dataset GROUP BY 1)""",
)
def ml_depth_sweep(spark, sf):
    """Errors of trees of growing depth, from one fit; on the training side none may be worse than the one before.

    A tree grows level by level, so the deepest one cut at a depth is the tree of that depth.
    """
    train, test = _vectors(spark, sf)
    grown = trees.fitted_ensemble(spark, models.tree(maxDepth=max(DEPTHS)).fit(train))
    sides = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    scored = trees.predictions_by_depth(grown, DATASET_FEATURES, DEPTHS)
    cut = sides.select("side", TARGET, F.posexplode(scored).alias("place", "prediction"))
    cut = cut.withColumn("depth", F.element_at(F.lit(list(DEPTHS)), F.col("place") + 1))
    errors = a.regression_metrics(cut, TARGET, "prediction", by=["depth", "side"])
    shallower = Window.partitionBy("side").orderBy("depth")  # one row per depth
    no_worse = F.coalesce(F.col("mse") <= F.lag("mse").over(shallower) + 1e-9, F.lit(True)).cast("int")
    return errors.select("depth", "side", "n", F.when(F.col("side") == "train", no_worse).otherwise(-1).alias("fits_no_worse"))


def _set_sql(stage: int, **options) -> str:
    """All combinations of the options as rows; an option that is searched elsewhere is null."""
    names = ("maxIter", "maxDepth", "subsamplingRate", "minInstancesPerNode", "stepSize")
    kinds = {"subsamplingRate": "DOUBLE", "stepSize": "DOUBLE"}
    parts = [f"(SELECT unnest({list(options[n])})::{kinds.get(n, 'INTEGER')} AS {n})" for n in names if n in options]
    columns = [n if n in options else f"NULL::{kinds.get(n, 'INTEGER')} AS {n}" for n in names]
    return f"SELECT {stage} AS stage, {', '.join(columns)} FROM {', '.join(parts)}"


def _options(sets: list[dict]) -> dict:
    return {name: sorted({s[name] for s in sets}) for name in sets[0]}


# what the first stage leaves to the estimator
FIRST_REST = {"subsamplingRate": 1.0, "minInstancesPerNode": 1}
_ABSOLUTE = training.published_searches(SEARCH_TREES)["absolute"]
GRID_SQL = f"""WITH {FOLDS_SQL},
  sets AS ({_set_sql(1, stepSize=_ABSOLUTE.rates, **{k: [x] for k, x in (FIRST_REST | _ABSOLUTE.first).items()})}
           UNION ALL {_set_sql(2, **_options(list(_ABSOLUTE.second)))})
  SELECT sets.*, 5 AS n_folds, scored_rows, 1 AS rate_is_best, CAST(stage = 2 AS INTEGER) AS chosen_is_least
  FROM sets, (SELECT count(*) AS scored_rows FROM folds WHERE fold > 0)"""


@query("ml_two_stage_grid", GRID_SQL)
def ml_two_stage_grid(spark, sf):
    """The published two-stage search: all sets, all folds; SQL checks sets, scored rows and both choices."""
    train, _ = _vectors(spark, sf)
    folds = assign_folds(train.select(HOUR, ZONE, models.FEATURES, TARGET), 5, "chronological").persist()
    try:
        n = folds.where("fold > 0").count()
        best, trials, _ = training.searched(models.gbt_absolute(), folds, training.published_searches(SEARCH_TREES)["absolute"], 5)
    finally:
        folds.unpersist()
    first, second = ([t for t in trials if t.stage == k] for k in (1, 2))
    rate = first[validation.best_of(first)].params["stepSize"]
    chosen = int(best.cv_mae_mean == min(t.cv_mae_mean for t in second))
    names = ("maxIter", "maxDepth", "subsamplingRate", "minInstancesPerNode", "stepSize")
    rows = [
        (
            t.stage, *[None if name == "stepSize" and t.stage == 2 else (FIRST_REST | t.params).get(name) for name in names], len(t.fold_maes), n,
            int(t.stage == 1 or t.params["stepSize"] == rate), chosen if t.stage == 2 else 0,
        )
        for t in trials
    ]
    return spark.createDataFrame(
        rows,
        "stage int, maxIter int, maxDepth int, subsamplingRate double, minInstancesPerNode int, stepSize double, n_folds int, "
        "scored_rows long, rate_is_best int, chosen_is_least int",
    )


@query(
    "ml_random_search",
    f"""SELECT 10 AS n_sets, 10 AS n_distinct, 1 AS in_space, 3 AS n_folds, 1 AS best_is_least, count(*) AS n
        FROM dataset WHERE hourly_timestamp <= TIMESTAMP '{CUT}'""",
)
def ml_random_search(spark, sf):
    """Ten draws from the published space of forests (200 to 2000 trees, depths up to MLlib's 30) on three shuffled folds."""
    train, _ = _vectors(spark, sf, training.POOLED_ROWS)
    forest = models.forest()
    numbers = [max(1, round(n * SETTINGS.get("random", 1))) for n in range(200, 2001, 200)]
    space = {
        forest.numTrees: numbers, forest.featureSubsetStrategy: ["all", "sqrt"], forest.maxDepth: [10, 20, 30],
        forest.minInstancesPerNode: [1, 2, 4, 10, 20], forest.bootstrap: [True, False],
    }
    fitted = search.random_search(forest, train, space, [HOUR, ZONE], n=10, n_folds=3, parallelism=validation.POOL)
    sets = [{p.name: x for p, x in params.items()} for params in fitted.getEstimatorParamMaps()]
    inside = all(s[p.name] in options for s in sets for p, options in space.items())
    least = sets[fitted.avgMetrics.index(min(fitted.avgMetrics))]
    best = all(fitted.bestModel.getOrDefault(name) == x for name, x in least.items())
    row = (len(sets), len({str(s) for s in sets}), int(inside), fitted.getNumFolds(), int(best), train.count())
    return spark.createDataFrame([row], "n_sets int, n_distinct int, in_space int, n_folds int, best_is_least int, n long")


def _importance_checks(table):
    """How many features, whether their importances sum to one, and whether the ranks follow them."""
    later = Window.partitionBy().orderBy("rank")  # one row per feature
    falls = F.coalesce(F.col("importance") <= F.lag("importance").over(later), F.lit(True))
    checked = table.withColumn("falls", falls)
    return checked.agg(
        F.count(F.lit(1)).alias("n_features"), F.round(F.sum("importance"), 6).alias("total"),
        F.countDistinct("feature").alias("n_names"), F.min(F.col("falls").cast("int")).alias("ranked"),
    )


@query("ml_importance", f"SELECT {len(DATASET_FEATURES)}::BIGINT AS n_features, 1.0::DOUBLE AS total, {len(DATASET_FEATURES)}::BIGINT AS n_names, 1 AS ranked")
def ml_importance(spark, sf):
    train, _ = _vectors(spark, sf)
    return _importance_checks(models.importance_table(spark, models.tree().fit(train), DATASET_FEATURES))


@query("top_k_importance", 'SELECT unnest(range(1, 11))::INTEGER AS "rank", 1 AS is_feature, 1 AS falls')
def top_k_importance(spark, sf):
    """The ten features that a forest uses most; SQL checks ranks, names and that the importances fall."""
    train, _ = _vectors(spark, sf)
    table = models.importance_table(spark, models.forest(**SETTINGS.get("forest", {})).fit(train), DATASET_FEATURES)
    before = Window.partitionBy().orderBy("rank")  # one row per feature
    top = table.orderBy(F.desc("importance"), "feature").limit(10)
    return top.select(
        "rank", F.col("feature").isin(DATASET_FEATURES).cast("int").alias("is_feature"),
        F.coalesce(F.col("importance") <= F.lag("importance").over(before), F.lit(True)).cast("int").alias("falls"),
    )


#: Two published-style trees over the dataset: named children, a row below the threshold goes to yes.
DEMAND_DUMP = """[
 {"nodeid": 0, "split": "lag_1_ride_count", "split_condition": 0.5, "yes": 1, "no": 2, "missing": 1, "children": [
  {"nodeid": 1, "split": "hour_of_day", "split_condition": 7, "yes": 3, "no": 4, "missing": 3, "children": [
   {"nodeid": 3, "leaf": 0.25}, {"nodeid": 4, "leaf": 0.75}]},
  {"nodeid": 2, "leaf": 1.5}]},
 {"nodeid": 0, "split": "rolling_mean_24h", "split_condition": 0.4375, "yes": 1, "no": 2, "missing": 2, "children": [
  {"nodeid": 1, "leaf": 0.5},
  {"nodeid": 2, "split": "temperature", "split_condition": 60, "yes": 5, "no": 6, "missing": 6, "children": [
   {"nodeid": 5, "leaf": 2.0}, {"nodeid": 6, "leaf": 3.25}]}]}
]"""
DEMAND_CASE = """CASE WHEN lag_1_ride_count < 0.5 THEN CASE WHEN hour_of_day < 7 THEN 0.25 ELSE 0.75 END ELSE 1.5 END
  + CASE WHEN rolling_mean_24h < 0.4375 THEN 0.5 ELSE CASE WHEN temperature < 60 THEN 2.0 ELSE 3.25 END END + 0.125"""


@query(
    "ml_score",
    f"SELECT hourly_timestamp, PULocationID, CAST(round_even({DEMAND_CASE}, 0) AS INTEGER) AS predicted_ride_count FROM dataset",
)
def ml_score(spark, sf):
    """A published tree dump scored in batches; SQL has its trees as CASE."""
    data = v.dataset(spark, sf)
    model = trees.TreeDumpModel(dump=DEMAND_DUMP, features=DATASET_FEATURES, base=0.125)
    return models.score(data, models.pipeline(DATASET_FEATURES, model).fit(data), DATASET_FEATURES).select(HOUR, ZONE, "predicted_ride_count")


@query(
    "ml_score_column",
    """SELECT hourly_timestamp, PULocationID, CAST(round_even(rolling_mean_3h, 0) AS INTEGER) AS predicted_ride_count
       FROM dataset""",
)
def ml_score_column(spark, sf):
    data = v.dataset(spark, sf)
    features = ["rolling_mean_3h", lag_name(1)]
    model = models.pipeline(features, models.PersistenceForecaster(inputCol="rolling_mean_3h")).fit(data)
    return models.score(data, model, features).select(HOUR, ZONE, "predicted_ride_count")


@query(
    "ml_registry",
    """SELECT hourly_timestamp, PULocationID, 2 AS version, lag_24_ride_count AS prediction FROM dataset""",
)
def ml_registry(spark, sf):
    root = work_path(spark, "registry")
    data = v.stored_dataset(spark, sf).select(HOUR, ZONE, lag_name(1), lag_name(24))
    for version, column in enumerate([lag_name(1), lag_name(24)], 1):
        model = models.pipeline([column], models.PersistenceForecaster(inputCol=column)).fit(data)
        registry.register(spark, root, "persistence", model, f"run-{version}", version)
    model, version = registry.load_latest(spark, root, "persistence")
    return model.transform(data).select(HOUR, ZONE, F.lit(version).alias("version"), "prediction")


@query(
    "ml_registry_lookup",
    """SELECT o_orderpriority AS name, max(o_orderkey)::INTEGER AS version FROM orders GROUP BY 1""",
)
def ml_registry_lookup(spark, sf):
    table = v.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderkey").cast("int").alias("version"),
        F.col("o_orderstatus").alias("run_id"),
        F.col("o_orderstatus").alias("source"),
        F.col("o_custkey").alias("creation_timestamp"),
        F.lit("READY").alias("status"),
    )
    assert [f.name for f in REGISTRY] == table.columns
    return registry.latest_versions(table).select("name", "version")


def _fare_vectors(spark, sf):
    """Fare groups with weather and one-hot zones and boroughs as vectors, random 67/33 split."""
    g = fares.fare_groups(v.trips(spark, sf), "pickup_ts", "pu_zone", "total_amount", ["trip_distance", "total_amount"])
    e = fares.enrich(g, v.zones(spark, sf), "pu_zone").na.drop(subset=["trip_distance", "total_amount"])
    hourly = fares.interpolated_weather(v.observations(spark, sf), "observed_at", ["observed_at", "event_id"])
    # hours outside the weather table get 0: the vector refuses NULL
    e = fares.add_weather_by_parts(e, hourly).na.fill(0.0, subset=WEATHER_COLUMNS)
    e = e.withColumn("pu_zone", F.col("pu_zone").cast("string"))
    numeric = ["transaction_month", "transaction_day", "transaction_hour", "transaction_week_day", "weekend", "is_holiday"]
    numeric += WEATHER_COLUMNS
    saved = materialise(e.select("pu_zone", "Borough", "transaction_date", *numeric, "total_amount"), "fares")
    # sparse 0/1 vectors of all levels, however many there are
    keyed = saved.withColumn(TARGET, F.col("total_amount")).na.fill("", subset=["pu_zone", "Borough"])
    encoded = models.encoded_levels(keyed, ["pu_zone", "Borough"])
    vectors = models.assembler([*numeric, "pu_zone_levels", "Borough_levels"]).transform(encoded)
    return search.split_random(vectors, ["pu_zone", "transaction_date", "transaction_hour"])


FARE_TEST_SQL = """WITH g AS (
    SELECT pu_zone, CAST(pickup_ts AS DATE) AS day, hour(pickup_ts) AS hh, avg(trip_distance) AS trip_distance, avg(total_amount) AS total_amount
    FROM trips WHERE total_amount >= 0 AND total_amount < 200 GROUP BY ALL),
  test AS (SELECT * FROM g WHERE trip_distance IS NOT NULL AND ('0x' || substr(md5('42|' || pu_zone::VARCHAR || '|' || day::VARCHAR || '|' || hh::VARCHAR), 1, 8))::BIGINT
             / 4294967296.0 >= 0.67)"""


@query(
    "ml_forest_classifier",
    f"{FARE_TEST_SQL} SELECT count(*) FILTER (total_amount >= 100) AS high, count(*) FILTER (total_amount < 100) AS low, 1 AS adds_up FROM test",
)
def ml_forest_classifier(spark, sf):
    """High fares against the others; SQL checks the sides of the confusion counts and that their shares follow from them."""
    train, test = _fare_vectors(spark, sf)
    label = flag(bucket_label("total_amount", 100) == "high").alias("label")
    model = models.forest_classifier("label", **SETTINGS.get("forest", {})).fit(
        train.select(models.FEATURES, label.cast("double").alias("label"))
    )
    counts = a.confusion(model.transform(test.select(models.FEATURES, label)), "label", "prediction")
    right = F.try_divide(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))
    return counts.select(
        (F.col("tp") + F.col("fn")).alias("high"), (F.col("fp") + F.col("tn")).alias("low"),
        (right.eqNullSafe(F.col("accuracy"))).cast("int").alias("adds_up"),
    )


@query(
    "pl_fare_model",
    f"""{FARE_TEST_SQL} SELECT model, count(*) AS n, 1 AS has_errors
        FROM test, (SELECT unnest(['boosting', 'forest', 'tree']) AS model) GROUP BY model""",
)
def pl_fare_model(spark, sf):
    train, test = _fare_vectors(spark, sf)
    out = None
    fits = {
        "tree": models.tree(), "forest": models.forest(**SETTINGS.get("forest", {})),
        "boosting": models.gbt_squared(**SETTINGS.get("boosting", {})),
    }
    for name, estimator in fits.items():
        scored = estimator.fit(train).transform(test)
        row = a.regression_metrics(scored, TARGET, "prediction").select(
            F.lit(name).alias("model"), "n", ((F.col("mae") > 0) & (F.col("rmse") >= F.col("mae"))).cast("int").alias("has_errors")
        )
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "pl_train",
    f"""SELECT m.model_name, m.fold_mode, (SELECT count(*) FROM dataset WHERE hourly_timestamp <= TIMESTAMP '{CUT}') AS training_data_size,
               {len(DATASET_FEATURES)} AS feature_count, 5 AS cv_folds, m.trials, 1 AS best_is_least, 1 AS version
        FROM (VALUES ('demand_absolute', 'chronological', 21), ('demand_leafmin', 'positional', 32)) AS m(model_name, fold_mode, trials)""",
)
def pl_train(spark, sf):
    """Both boosting variants over their published sets, with all published trees: SQL checks sizes, trials and the choice in the last stage."""
    root, data = work_path(spark, "train"), v.stored_dataset(spark, sf)
    searches, out = training.published_searches(SETTINGS.get("search", 1.0)), None
    for name, make, mode, variant in (
        ("demand_absolute", models.gbt_absolute, "chronological", "absolute"), ("demand_leafmin", models.gbt_leafmin, "positional", "leafmin"),
    ):
        result = training.train(
            data, DATASET_FEATURES, ntz(CUT), root, name, search=searches[variant], n_folds=5, trained_at="2024-01-31T00:00:00",
            created=1, estimator=make(), fold_mode=mode,
        )
        last = max(t.stage for t in result.trials)
        least = min(t.cv_mae_mean for t in result.trials if t.stage == last)
        row = result.metadata.select(
            "model_name", F.lit(mode).alias("fold_mode"), "training_data_size", "feature_count",
            F.col("cross_validation.cv_folds").cast("int").alias("cv_folds"), F.lit(len(result.trials)).alias("trials"),
            F.lit(int(result.best.cv_mae_mean == least)).alias("best_is_least"), F.lit(result.version).alias("version"),
        )
        out = row if out is None else out.unionByName(row)
    return out


#: Two trees over the feature store: left and right children, a row up to the threshold goes left.
STORE_DUMP = """{"tree_info": [
 {"tree_structure": {"split_feature": "rolling_mean_24h", "threshold": 0.4, "decision_type": "<=", "default_left": true,
   "left_child": {"leaf_value": 0.3}, "right_child": {"split_feature": "is_rush_hour", "threshold": 0.5, "decision_type": "<=",
     "default_left": false, "left_child": {"leaf_value": 0.9}, "right_child": {"leaf_value": 1.7}}}},
 {"tree_structure": {"split_feature": "lag_24_ride_count", "threshold": 1.0, "decision_type": "<=", "default_left": true,
   "left_child": {"leaf_value": 0.1}, "right_child": {"leaf_value": 1.2}}}]}"""
STORE_CASE = """CASE WHEN rolling_mean_24h <= 0.4 THEN 0.3 ELSE CASE WHEN is_rush_hour <= 0.5 THEN 0.9 ELSE 1.7 END END
  + CASE WHEN lag_24_ride_count <= 1.0 THEN 0.1 ELSE 1.2 END"""


def _scored_next_hour(spark, sf, name, model):
    """Newest feature rows -> registered model -> whole rides, written per scored hour."""
    from tidecast.sources import writers

    root = work_path(spark, "score")
    rows = feat.next_hour_rows(materialise(store(spark, sf), "store"), v.zones(spark, sf), downtown=v.DOWNTOWN)
    registry.register(spark, root, name, models.pipeline(STORE_FEATURES, model).fit(rows), "run", 1)
    loaded, _ = registry.load_latest(spark, root, name)
    scored = training.score_next_hour(rows.withColumn(HOUR, plus_hours(HOUR, 1)), loaded, STORE_FEATURES)
    writers.write_partitioned(scored.withColumn("scored_hour", F.date_format(HOUR, "yyyyMMdd_HHmmss")), f"{root}/predictions", ["scored_hour"])
    return spark.read.parquet(f"{root}/predictions").drop("scored_hour")


@query(
    "pl_score",
    f"""{STORE_CTES} SELECT hourly_timestamp + INTERVAL 1 HOUR AS hourly_timestamp, PULocationID,
               CAST(round_even({STORE_CASE}, 0) AS INTEGER) AS predicted_ride_count
        FROM store WHERE hourly_timestamp = (SELECT max(hourly_timestamp) FROM store)""",
)
def pl_score(spark, sf):
    """The published tree model is registered, loaded and scores the next hour; SQL has its trees as CASE."""
    return _scored_next_hour(spark, sf, "trees", trees.TreeDumpModel(dump=STORE_DUMP, features=STORE_FEATURES))


@query(
    "pl_score_column",
    f"""{STORE_CTES} SELECT hourly_timestamp + INTERVAL 1 HOUR AS hourly_timestamp, PULocationID,
               CAST(round_even(rolling_mean_24h, 0) AS INTEGER) AS predicted_ride_count
        FROM store WHERE hourly_timestamp = (SELECT max(hourly_timestamp) FROM store)""",
)
def pl_score_column(spark, sf):
    return _scored_next_hour(spark, sf, "demand", models.PersistenceForecaster(inputCol="rolling_mean_24h"))


@query(
    "pl_score_trees",
    f"""{STORE_CTES} SELECT hourly_timestamp + INTERVAL 1 HOUR AS hourly_timestamp, PULocationID, 1 AS in_range, 1 AS same_by_nodes
        FROM store WHERE hourly_timestamp = (SELECT max(hourly_timestamp) FROM store)""",
)
def pl_score_trees(spark, sf):
    """A boosted model trained here; SQL checks the scored rows, and its node table must give the same predictions."""
    train, _ = _sides(spark, sf)
    typed = train.select(*[F.col(c).cast("double").alias(c) for c in [*STORE_FEATURES, TARGET]])
    typed = materialise(training.few_partitions(typed), "trees")
    model = models.pipeline(STORE_FEATURES, models.gbt_squared(**SETTINGS.get("boosting", {}))).fit(typed)
    low, high = typed.agg(F.min(TARGET), F.max(TARGET)).first()
    spread = high - low
    rows = feat.next_hour_rows(materialise(store(spark, sf), "store"), v.zones(spark, sf), downtown=v.DOWNTOWN)
    rows = materialise(rows.withColumn(HOUR, plus_hours(HOUR, 1)), "next-rows")
    nodes = trees.fitted_ensemble(spark, model.stages[-1])
    by_nodes = rows.select(HOUR, ZONE, F.rint(trees.predictions(nodes, STORE_FEATURES)).cast("int").alias("by_nodes"))
    scored = training.score_next_hour(rows, model, STORE_FEATURES)
    return scored.join(by_nodes, [HOUR, ZONE]).select(
        HOUR, ZONE, F.col("predicted_ride_count").between(F.lit(low - spread), F.lit(high + spread)).cast("int").alias("in_range"),
        (F.col("by_nodes") == F.col("predicted_ride_count")).cast("int").alias("same_by_nodes"),
    )
