"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.sources.storage import materialise

MAX_ROUNDS = 60


def _summary(links: DataFrame) -> tuple:
    return links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()[:]


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialise(both.groupBy("a").agg(F.least("a", F.min("b")).alias("root")), "least")
    return (
        both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to its smallest neighbour."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = materialise(down.groupBy("a").agg(F.min("b").alias("root")), "least")
    moved = down.join(least, "a").where("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return moved.unionByName(least.select("a", F.col("root").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``links`` (``a``, ``b``, long); root is the smallest node reached.

    Alternates the large-star and small-star steps, which move links towards the smallest node and
    need a number of rounds that grows with the logarithm of the number of nodes. A hub is combined
    in the tasks before the shuffle; its smallest neighbour is written first, so that both sides of the
    look-up are plain exchanges, whose hot partitions adaptive execution splits. Every step is
    written to the shared folder, which cuts the lineage. Null nodes and loops are dropped.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = materialise(links.distinct(), "links")
    before = _summary(links)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        links = materialise(_small_star(_large_star(links)), "links")
        after = _summary(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
