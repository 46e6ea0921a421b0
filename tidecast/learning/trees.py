"""Tree ensembles as node tables: read from model dumps or fitted models, scored in batches.

A node table has one row per node: its test (``value of feature < threshold`` or ``<=``), the nodes for yes,
no and a missing value, and what the node itself predicts. Published dumps of boosted trees (JSON, nested
nodes) and MLlib models become the same table, so either can be scored, stored and cut at any depth.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.sources.storage import work_path

NODES = (
    "tree int, node int, depth int, feature int, threshold double, strict boolean, yes int, no int, missing int, value double"
)
#: Nodes that one scoring function carries to the tasks (about 60 bytes each); more trees are cut into several.
NODES_PER_FUNCTION = 500_000


@dataclass
class Ensemble:
    """Nodes of all trees in arrays; children are places in them, a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    strict: np.ndarray
    yes: np.ndarray
    no: np.ndarray
    missing: np.ndarray
    value: np.ndarray
    depth: np.ndarray
    roots: np.ndarray

    def part(self, first: int, last: int) -> Ensemble:
        """The trees ``first`` to ``last`` - 1."""
        low = self.roots[first]
        high = self.roots[last] if last < len(self.roots) else len(self.value)
        cut = slice(low, high)
        children = (x[cut] - low for x in (self.yes, self.no, self.missing))
        return Ensemble(
            self.feature[cut], self.threshold[cut], self.strict[cut], *children, self.value[cut], self.depth[cut],
            self.roots[first:last] - low,
        )

    def parts(self, limit: int) -> Iterator[Ensemble]:
        """Runs of whole trees of at most ``limit`` nodes (a larger tree stands alone)."""
        ends, first = [*self.roots[1:].tolist(), len(self.value)], 0
        for k, end in enumerate(ends):
            if end - self.roots[first] > limit and k > first:
                yield self.part(first, k)
                first = k
        if ends and len(self.roots):
            yield self.part(first, len(self.roots))

    def _leaves(self, x: np.ndarray, root: int, least: int | None) -> np.ndarray:
        at = np.full(len(x), root)
        deepest = int(self.depth.max()) if len(self.depth) else 0
        for _ in range(deepest if least is None else min(least, deepest)):
            v = x[np.arange(len(x)), self.feature[at]]
            limit = self.threshold[at]
            passed = np.where(self.strict[at], v < limit, v <= limit)
            at = np.where(np.isnan(v), self.missing[at], np.where(passed, self.yes[at], self.no[at]))
        return at

    def predict(self, x: np.ndarray, depth: int | None = None) -> np.ndarray:
        """Sum over the trees of the value of the node that each row of ``x`` reaches, no deeper than ``depth``."""
        out = np.zeros(len(x))
        for root in self.roots:
            out += self.value[self._leaves(x, int(root), depth)]
        return out


def _nested(node: dict, features: Sequence[str]) -> Iterator[tuple]:
    """(id, children's ids, feature, threshold, strict, missing, value) of a nested node and all below it."""
    todo = [(node, 0)]
    while todo:
        n, depth = todo.pop()
        if "children" in n:  # named children by number; a row below the threshold goes to yes
            by_id = {c["nodeid"]: c for c in n["children"]}
            below, above, without = n["yes"], n["no"], n.get("missing", n["yes"])
            name, limit, strict = n["split"], float(n["split_condition"]), True
            ids = {i: i for i in by_id}
            children = list(by_id.values())
            own, value = n["nodeid"], float(n.get("base", 0.0))
        elif "left_child" in n:  # left and right; a row up to the threshold goes left
            children = [n["left_child"], n["right_child"]]
            ids = {k: id(c) for k, c in enumerate(children)}
            below, above, without = 0, 1, 0 if n.get("default_left", True) else 1
            name, limit, strict = n["split_feature"], float(n["threshold"]), False
            if n.get("decision_type", "<=") != "<=":
                raise ValueError(f"unknown test {n['decision_type']!r} in a tree dump")
            own, value = id(n), float(n.get("internal_value", 0.0))
        else:
            leaf = n["leaf"] if "leaf" in n else n["leaf_value"]
            own = n["nodeid"] if "nodeid" in n else id(n)
            yield own, depth, 0, 0.0, True, own, own, own, float(leaf)
            continue
        place = int(name[1:]) if isinstance(name, str) and name not in features and name[:1] == "f" and name[1:].isdigit() else name
        place = place if isinstance(place, int) else list(features).index(place)
        yield own, depth, place, limit, strict, ids[below], ids[above], ids[without], value
        todo += [(c, depth + 1) for c in children]


def read_dump(text: str, features: Sequence[str]) -> pd.DataFrame:
    """Node table of a JSON dump: a list of nested trees, or an object with ``tree_info``.

    Two published shapes are understood: nodes with ``split``, ``split_condition``, ``yes``, ``no``, ``missing`` and
    ``children``, and nodes with ``split_feature``, ``threshold``, ``default_left``, ``left_child`` and ``right_child``.
    Features are named, numbered or ``f<number>``. A feature that is not in ``features`` is an error.
    """
    parsed = json.loads(text)
    trees = [t.get("tree_structure", t) for t in parsed["tree_info"]] if isinstance(parsed, dict) else parsed
    rows = []
    for number, tree in enumerate(trees):
        nodes = list(_nested(tree, features))
        place = {n[0]: k for k, n in enumerate(nodes)}
        for own, depth, feature, limit, strict, below, above, without, value in nodes:
            if not 0 <= feature < len(features):
                raise ValueError(f"feature {feature} of a tree dump is none of {len(features)}")
            rows.append((number, place[own], depth, feature, limit, strict, place[below], place[above], place[without], value))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in NODES.split(", ")])


def ensemble(nodes: pd.DataFrame) -> Ensemble:
    """Arrays of a node table; ``node`` counts from 0 in each tree, where 0 is the root."""
    nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
    roots = np.flatnonzero(nodes["node"].to_numpy() == 0)
    base = np.repeat(roots, np.diff(np.append(roots, len(nodes))))
    columns = {c: nodes[c].to_numpy() for c in ("feature", "threshold", "strict", "value", "depth")}
    return Ensemble(
        columns["feature"], columns["threshold"].astype(float), columns["strict"].astype(bool),
        *(nodes[c].to_numpy() + base for c in ("yes", "no", "missing")), columns["value"].astype(float), columns["depth"], roots,
    )


def mllib_nodes(spark: SparkSession, model) -> DataFrame:
    """Node table of a fitted MLlib tree, forest or boosted ensemble, read from its saved form.

    Continuous features only. A forest's values are divided by the number of trees and a boosted
    model's multiplied by the tree weights, so that the sum over the trees is the prediction.
    """
    path = work_path(spark, "trees")
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "treeID" not in data.columns:
        data = data.select(F.lit(0).alias("treeID"), F.struct("*").alias("nodeData"))
    weights = [float(w) for w in model.treeWeights] if hasattr(model, "treeWeights") else [1.0]
    if "forest" in type(model).__name__.lower():
        weights = [w / len(weights) for w in weights]
    n, leaf = F.col("nodeData"), F.col("nodeData.leftChild") < 0
    rows = data.select(
        F.col("treeID").cast("int").alias("tree"), n["id"].cast("int").alias("node"),
        F.when(leaf, 0).otherwise(n["split"]["featureIndex"]).cast("int").alias("feature"),
        F.when(leaf, 0.0).otherwise(n["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.lit(False).alias("strict"),
        F.when(leaf, n["id"]).otherwise(n["leftChild"]).cast("int").alias("yes"),
        F.when(leaf, n["id"]).otherwise(n["rightChild"]).cast("int").alias("no"),
        (n["prediction"] * F.element_at(F.lit(np.array(weights)), F.col("treeID").cast("int") + 1)).alias("value"),
    )
    return rows.withColumn("missing", F.col("no"))


def with_depth(nodes: pd.DataFrame) -> pd.DataFrame:
    """``nodes`` with the depth of each node; parents come before their children."""
    nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
    depth = np.zeros(len(nodes), dtype=np.int64)
    start = dict(zip(nodes.loc[nodes["node"] == 0, "tree"], np.flatnonzero(nodes["node"] == 0)))
    for k, (tree, node, yes, no) in enumerate(zip(nodes["tree"], nodes["node"], nodes["yes"], nodes["no"])):
        if yes != node:
            depth[start[tree] + yes] = depth[start[tree] + no] = depth[k] + 1
    return nodes.assign(depth=depth)


def fitted_ensemble(spark: SparkSession, model) -> Ensemble:
    """A fitted model's trees on the driver: bounded by trees x 2^depth, whatever it was trained on."""
    return ensemble(with_depth(mllib_nodes(spark, model).toPandas()))


def predictions(trees: Ensemble, features: Sequence[str | Column], nodes_per_function: int = NODES_PER_FUNCTION) -> Column:
    """Sum over all trees for the row's features; null counts as missing.

    Nodes travel with the function, at most ``nodes_per_function`` of them: a larger ensemble is several
    functions over runs of its trees, whose results are added.
    """
    row, total = _row(features), F.lit(0.0)
    for part in trees.parts(nodes_per_function):
        total = total + _walker(part)(row)
    return total


def predictions_by_depth(trees: Ensemble, features: Sequence[str | Column], depths: Sequence[int]) -> Column:
    """An array: what the ensemble predicts if no tree is followed deeper than each of ``depths``."""

    @F.pandas_udf("array<double>")
    def walk(frame: pd.DataFrame) -> pd.Series:
        x = frame.to_numpy(dtype=float, na_value=np.nan)
        return pd.Series(list(np.column_stack([trees.predict(x, d) for d in depths])), dtype=object)

    return walk(_row(features))


def _row(features: Sequence[str | Column]) -> Column:
    columns = [F.col(f) if isinstance(f, str) else f for f in features]
    return F.struct(*[c.cast("double").alias(f"f{k}") for k, c in enumerate(columns)])


def _walker(part: Ensemble):
    @F.pandas_udf("double")
    def walk(frame: pd.DataFrame) -> pd.Series:
        return pd.Series(part.predict(frame.to_numpy(dtype=float, na_value=np.nan)))

    return walk


class _DumpParams(HasPredictionCol):
    dump = Param(Params._dummy(), "dump", "JSON dump of the trees", typeConverter=TypeConverters.toString)
    features = Param(Params._dummy(), "features", "feature columns in the model's order", typeConverter=TypeConverters.toListString)
    base = Param(Params._dummy(), "base", "added to the sum over the trees", typeConverter=TypeConverters.toFloat)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(predictionCol="prediction", base=0.0)


class TreeDumpModel(Model, _DumpParams, DefaultParamsReadable, DefaultParamsWritable):
    """A published tree model as a pipeline stage: it is saved, registered and loaded like any other."""

    @keyword_only
    def __init__(self, *, dump: str | None = None, features: Sequence[str] | None = None, base: float = 0.0, predictionCol: str = "prediction"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = self.getOrDefault("features")
        trees = ensemble(read_dump(self.getOrDefault("dump"), names))
        return dataset.withColumn(self.getPredictionCol(), predictions(trees, names) + F.lit(self.getOrDefault("base")))
