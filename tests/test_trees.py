import json
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidecast.learning import models, trees
from tidecast.names import TARGET
from tidecast.workload.q_learning import DEMAND_DUMP, STORE_DUMP

NAMES = ["x", "y", "z"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, size=(400, 3)) / 2.0
    y = x[:, 0] * 2 + np.where(x[:, 1] > 2, 5.0, x[:, 2]) + rng.normal(0, 0.3, 400)
    rows = [(i, *map(float, r), Vectors.dense(r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ["i", *NAMES, "features", TARGET]).persist()
    yield df
    df.unpersist()


def walked(node, row):
    """One row through one nested tree, by recursion."""
    if "leaf" in node or "leaf_value" in node:
        return node.get("leaf", node.get("leaf_value"))
    if "split" in node:
        v = row[node["split"]]
        to = node["missing"] if v is None else node["yes"] if v < node["split_condition"] else node["no"]
        return walked(next(c for c in node["children"] if c["nodeid"] == to), row)
    v = row[node["split_feature"]]
    left = node["default_left"] if v is None else v <= node["threshold"]
    return walked(node["left_child"] if left else node["right_child"], row)


@pytest.mark.parametrize("text", [DEMAND_DUMP, STORE_DUMP])
def test_dumps_equal_a_walk_row_by_row(spark, text):
    parsed = json.loads(text)
    roots = [t["tree_structure"] for t in parsed["tree_info"]] if isinstance(parsed, dict) else parsed
    names = sorted(set(re.findall(r'"split(?:_feature)?": "(\w+)"', text)))
    rng = np.random.default_rng(1)
    rows = [tuple(None if rng.random() < 0.2 else float(rng.choice([0, 0.4, 0.4375, 0.5, 1, 7, 60, 90])) for _ in names) for _ in range(300)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    got = trees.TreeDumpModel(dump=text, features=names, base=0.5).transform(df).collect()
    for r in got:
        assert r.prediction == pytest.approx(0.5 + sum(walked(t, r.asDict()) for t in roots))


def test_many_functions_give_the_same_sum(table):
    whole = trees.ensemble(trees.read_dump(DEMAND_DUMP.replace("lag_1_ride_count", "x").replace("hour_of_day", "y").replace("rolling_mean_24h", "z").replace("temperature", "x"), NAMES))
    assert [len(p.value) for p in whole.parts(3)] == [5, 5] and len(list(whole.parts(100))) == 1
    a, b = (table.select("i", trees.predictions(whole, NAMES, n).alias("p")).orderBy("i").collect() for n in (100, 3))
    assert a == b


def test_dump_model_is_saved_and_loaded(table, tmp_path):
    dump = json.dumps([{"nodeid": 0, "split": "f2", "split_condition": 3, "yes": 1, "no": 2, "children": [{"nodeid": 1, "leaf": 1}, {"nodeid": 2, "leaf": 4}]}])
    model = Pipeline(stages=[trees.TreeDumpModel(dump=dump, features=NAMES)]).fit(table)
    model.save(str(tmp_path / "m"))
    rows = PipelineModel.load(str(tmp_path / "m")).transform(table).select("z", "prediction").collect()
    assert all(r.prediction == (1 if r.z < 3 else 4) for r in rows)


def test_a_single_leaf_and_unknown_features(table):
    single = trees.ensemble(trees.read_dump('[{"nodeid": 0, "leaf": 2.5}]', NAMES))
    assert {r.p for r in table.select(trees.predictions(single, NAMES).alias("p")).collect()} == {2.5}
    with pytest.raises(ValueError):
        trees.read_dump('[{"nodeid": 0, "split": "w", "split_condition": 1, "yes": 1, "no": 2, "children": [{"nodeid": 1, "leaf": 1}, {"nodeid": 2, "leaf": 2}]}]', NAMES)
    with pytest.raises(ValueError):
        trees.read_dump('[{"nodeid": 0, "split": 7, "split_condition": 1, "yes": 1, "no": 2, "children": [{"nodeid": 1, "leaf": 1}, {"nodeid": 2, "leaf": 2}]}]', NAMES)


@pytest.mark.parametrize("make", [lambda: models.tree(maxDepth=6), lambda: models.forest(numTrees=4, maxDepth=4), lambda: models.gbt_squared(maxIter=5)])
def test_fitted_models_as_node_tables(spark, table, make):
    model = make().fit(table)
    scored = model.transform(table).withColumn("own", trees.predictions(trees.fitted_ensemble(spark, model), NAMES))
    assert scored.where(F.abs(F.col("own") - F.col("prediction")) > 1e-9).count() == 0


def test_a_deep_tree_cut_equals_shallow_fits(spark, table):
    depths = [1, 2, 3, 5, 8]
    deep = trees.fitted_ensemble(spark, models.tree(maxDepth=8).fit(table))
    cut = table.select("i", trees.predictions_by_depth(deep, NAMES, depths).alias("p")).toPandas().sort_values("i")
    for k, depth in enumerate(depths):
        alone = models.tree(maxDepth=depth).fit(table).transform(table).select("i", "prediction").toPandas().sort_values("i")
        pd.testing.assert_series_equal(cut["p"].map(lambda p, k=k: p[k]), alone["prediction"], check_names=False, check_index=False)
