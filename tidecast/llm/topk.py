"""Exact top-k search by inner product with two cover trees.

Vectors and queries are dealt to blocks of bounded size. For each pair of a query block and a data
block a task builds a cover tree over either side: the children of a node are centres that lie
further apart than half the node's scale, and cover its points within it (with few clusters in many
dimensions only the first centres are taken, and points go to the nearest). Both trees are walked
together. With c the centres and r the covering radii of a query node and a data node, no
score between them exceeds

    <cq, cd> + |cq| rd + |cd| rq + rq rd,

so the pair is pruned if that is below the worst k-th score of the node's queries. The best of
all data blocks are merged at the end. Scores are integers, and equal scores are never pruned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.sources.storage import materialise

SCALE = 1024
NEIGHBOURS = 10
QUERY_EVERY = 100
BLOCK_VECTORS, BLOCK_QUERIES = 50_000, 10_000
#: Points of a data leaf and of a query leaf, and the most children of a node.
LEAF, QUERY_LEAF, CENTRES = 64, 1, 32
LEAVES_AT_ONCE = 256


class CoverTree:
    """Nodes in arrays: centre, covering radius, children (first, count) or points (first, count)."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        self.points = points
        self.order: list[np.ndarray] = []
        self.centre: list[np.ndarray] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        self.span: list[tuple[int, int]] = []
        self.placed = 0
        if len(points):
            self.build(np.arange(len(points)), leaf)
        self.order_ = np.concatenate(self.order) if self.order else np.zeros(0, dtype=np.int64)
        self.centres = np.array(self.centre).reshape(len(self.centre), points.shape[1])
        self.radii = np.array(self.radius)
        self.norms = np.sqrt((self.centres**2).sum(axis=1))

    def node(self, members: np.ndarray, leaf: int) -> tuple[int, np.ndarray]:
        """A new node around its first member; the distances of all members from it."""
        centre = self.points[members[0]]
        distance = np.sqrt(((self.points[members] - centre) ** 2).sum(axis=1))
        self.centre.append(centre)
        self.radius.append(float(distance.max()) * (1 + 1e-12))
        self.children.append([])
        self.span.append((self.placed, 0))
        return len(self.centre) - 1, distance

    def build(self, all_members: np.ndarray, leaf: int) -> None:
        waiting = [(all_members, -1)]
        while waiting:
            members, parent = waiting.pop()
            number, distance = self.node(members, leaf)
            if parent >= 0:
                self.children[parent].append(number)
            parts = self.split(members, distance) if len(members) > leaf and distance.max() > 0 else []
            if not parts:
                self.span[number] = (self.placed, len(members))
                self.order.append(members)
                self.placed += len(members)
            else:
                waiting += [(part, number) for part in parts]

    def split(self, members: np.ndarray, distance: np.ndarray) -> list[np.ndarray]:
        """Groups around centres that are further apart than half the node's scale.

        Where points are about equally far from each other (many dimensions, no clusters) nearly every point
        would be a centre; then the first CENTRES of them take all points, each the nearest ones.
        """
        scale = 2.0 ** np.ceil(np.log2(distance.max()) - 1)
        left, near, parts = members, distance, []
        while len(left) and len(parts) < CENTRES:
            inside = near <= scale
            parts.append(left[inside])
            left = left[~inside]
            if len(left):
                near = np.sqrt(((self.points[left] - self.points[left[0]]) ** 2).sum(axis=1))
        if len(left):
            centres = self.points[[part[0] for part in parts]]
            nearest = ((centres**2).sum(axis=1)[None, :] - 2 * self.points[members] @ centres.T).argmin(axis=1)
            groups = [members[nearest == k] for k in range(len(parts))]
            parts = [np.concatenate((g[g == p[0]], g[g != p[0]])) for g, p in zip(groups, parts, strict=True) if len(g)]
        if len(parts) > 1:
            return parts
        return [members[distance <= distance.max() / 2], members[distance > distance.max() / 2]]

    def members(self, node: int) -> np.ndarray:
        first, count = self.span[node]
        return self.order_[first : first + count]

    def below(self, node: int) -> np.ndarray:
        """Points of a node and all its descendants."""
        found, waiting = [], [node]
        while waiting:
            at = waiting.pop()
            found.append(self.members(at))
            waiting += self.children[at]
        return np.concatenate(found)


class Best:
    """The k best (score, smaller id first) of every query so far."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.ident = np.full((queries, k), np.iinfo(np.int64).max)

    def worst(self, some: np.ndarray) -> float:
        return float(self.score[some, -1].min())

    def offer(self, some: np.ndarray, scores: np.ndarray, idents: np.ndarray) -> None:
        score = np.concatenate((self.score[some], scores), axis=1)
        ident = np.concatenate((self.ident[some], np.broadcast_to(idents, scores.shape)), axis=1)
        if score.shape[1] > 4 * self.k:
            # all that reach the k-th score, ties included, before the exact sort
            kth = -np.partition(-score, self.k - 1, axis=1)[:, self.k - 1 : self.k]
            width = int((score >= kth).sum(axis=1).max())
            top = np.argpartition(-score, min(width, score.shape[1] - 1), axis=1)[:, : width]
            score, ident = np.take_along_axis(score, top, axis=1), np.take_along_axis(ident, top, axis=1)
        order = np.lexsort((ident, -score), axis=1)[:, : self.k]
        self.score[some] = np.take_along_axis(score, order, axis=1)
        self.ident[some] = np.take_along_axis(ident, order, axis=1)


class DualSearch:
    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, copies: list[np.ndarray], k: int) -> None:
        """``copies`` holds the ids of each distinct data vector in ascending order, k + 1 at most."""
        self.queries, self.query_ids, self.data = queries, query_ids, data
        self.q, self.d = CoverTree(queries, QUERY_LEAF), CoverTree(data)
        self.best = Best(len(queries), k)
        self.ids = np.full((len(copies), max((len(c) for c in copies), default=1)), -1, dtype=np.int64)
        for i, c in enumerate(copies):
            self.ids[i, : len(c)] = c
        self.seeds: dict[int, int] = {}
        self.compared = 0

    def look(self, qnode: int, dnodes: np.ndarray) -> None:
        """All points of some data leaves against the queries of a query leaf."""
        some, part = self.q.members(qnode), np.concatenate([self.d.members(n) for n in dnodes.tolist()])
        scores = self.queries[some] @ self.data[part].T
        self.compared += scores.size
        for c in range(self.ids.shape[1]):
            has = self.ids[part, c] >= 0 if c else slice(None)
            ids = self.ids[part, c][has]
            if len(ids):
                own = np.where(ids[None, :] == self.query_ids[some][:, None], -np.inf, scores[:, has])
                self.best.offer(some, own, ids[None, :])

    def bounds(self, qnode: int, dnodes: np.ndarray) -> np.ndarray:
        rq, rd = self.q.radii[qnode], self.d.radii[dnodes]
        value = self.d.centres[dnodes] @ self.q.centres[qnode] + self.q.norms[qnode] * rd + self.d.norms[dnodes] * rq + rq * rd
        return value + 1e-6 * (1 + np.abs(value))

    def run(self) -> Best:
        if not len(self.q.centre) or not len(self.d.centre):
            return self.best
        leaves = np.array([i for i in range(len(self.d.centre)) if self.d.span[i][1]])
        for qnode in range(len(self.q.centre)):
            if self.q.span[qnode][1]:  # a first k-th score for every query from the leaf that promises most
                self.seeds[qnode] = int(leaves[self.bounds(qnode, leaves).argmax()])
                self.look(qnode, np.array([self.seeds[qnode]]))
        self.walk(0, np.array([0]))
        return self.best

    def walk(self, root: int, data_roots: np.ndarray) -> None:
        waiting = [(root, data_roots)]
        while waiting:
            qnode, dnodes = waiting.pop()
            own = self.q.below(qnode)
            dnodes = dnodes[self.bounds(qnode, dnodes) >= self.best.worst(own)]
            inner = [c for n in dnodes.tolist() for c in self.d.children[n]]
            ends = np.array([n for n in dnodes.tolist() if self.d.span[n][1]], dtype=np.int64)
            if self.q.children[qnode]:
                below = np.concatenate((ends, np.array(inner, dtype=np.int64)))
                waiting += [(child, below) for child in self.q.children[qnode]]
                continue
            while inner:  # a query leaf: go down to the data leaves
                nodes = np.array(inner)
                nodes = nodes[self.bounds(qnode, nodes) >= self.best.worst(own)]
                ends = np.concatenate((ends, [n for n in nodes.tolist() if self.d.span[n][1]])).astype(np.int64)
                inner = [c for n in nodes.tolist() for c in self.d.children[n]]
            ends = ends[ends != self.seeds[qnode]]
            limits = self.bounds(qnode, ends)
            order = np.argsort(-limits, kind="stable")
            ends, limits = ends[order], limits[order]
            at, step = 0, 2
            while at < len(ends) and limits[at] >= self.best.worst(own):
                # the most promising leaves first; more of them at once the longer it takes
                upto = at + int((limits[at : at + step] >= self.best.worst(own)).sum())
                self.look(qnode, ends[at:upto])
                at, step = upto, min(2 * step, LEAVES_AT_ONCE)


def as_matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows padded with zeros."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def search_block(frame: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of one data block for each query of one query block."""
    width = int(frame["vector"].map(len).max())
    queries, data = frame[frame["is_query"]], frame[~frame["is_query"]].sort_values("vec_id")
    q, d = as_matrix(queries["vector"], width), as_matrix(data["vector"], width)
    largest = max(int(np.abs(q).max(initial=0)), int(np.abs(d).max(initial=0)))
    if width * largest * largest < 2**52:
        q, d = q.astype(np.float64), d.astype(np.float64)
    distinct, which = np.unique(d, axis=0, return_inverse=True) if len(d) else (d, np.zeros(0, dtype=int))
    which = which.reshape(-1)
    order = np.argsort(which, kind="stable")
    ids = data["vec_id"].to_numpy()[order]
    edges = np.searchsorted(which[order], np.arange(len(distinct) + 1))
    copies = [np.unique(ids[a:b])[: k + 1] for a, b in zip(edges[:-1], edges[1:], strict=True)]
    best = DualSearch(q, queries["vec_id"].to_numpy(), distinct, copies, k).run()
    found = np.isfinite(best.score)
    rows = np.nonzero(found)[0]
    return pd.DataFrame(
        {"query_id": queries["vec_id"].to_numpy()[rows], "vec_id": best.ident[found], "score": best.score[found].astype("int64")}
    )


def neighbours(
    vectors: DataFrame,
    every: int = QUERY_EVERY,
    k: int = NEIGHBOURS,
    block_vectors: int = BLOCK_VECTORS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest inner products of every query with other rows.

    ``vectors`` needs ``vec_id`` and ``embedding`` (array of numbers); other columns are ignored. Queries
    are the rows whose id is divisible by ``every``; candidates are all rows with another id. Components
    become floor(1024 x). Rows with a null id, a null vector, or a null or non-finite component take no
    part; a shorter vector counts as padded with zeros. Ties go to the smaller id. Rows that repeat an
    id and vector count once. Fewer candidates than k give fewer rows; an empty table gives none.

    Queries are sent to every block of vectors, in blocks; no task holds more than a block of either.
    """
    whole = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False))
    )
    ints = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    rows = vectors.where(F.col("vec_id").isNotNull() & whole).select(
        F.col("vec_id").cast("long").alias("vec_id"), ints.alias("vector"), F.monotonically_increasing_id().alias("row")
    )
    rows = materialise(rows, "vectors")
    is_query = F.col("vec_id") % every == 0
    counted = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    data_blocks, query_blocks = max(1, -(-counted[0] // block_vectors)), max(1, -(-counted[1] // block_queries))
    deal = F.xxhash64("row")
    data = rows.select(
        "vec_id", "vector", F.lit(False).alias("is_query"), F.pmod(deal, F.lit(data_blocks)).alias("data_block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))).alias("query_block"),
    )
    asked = rows.where(is_query).dropDuplicates(["vec_id", "vector"]).select(
        "vec_id", "vector", F.lit(True).alias("is_query"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(data_blocks - 1).cast("long"))).alias("data_block"),
        F.pmod(deal, F.lit(query_blocks)).alias("query_block"),
    )
    schema = "query_id long, vec_id long, score long"
    pairs = data.unionByName(asked).groupBy("data_block", "query_block").applyInPandas(lambda frame: search_block(frame, k), schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        pairs.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
