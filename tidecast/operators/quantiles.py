"""Quantiles of large columns without gathering the column in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Places for each power of two in the first pass of exact quantiles.
STEPS = 4096


def approx_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``(column, q0, q1, ...)`` from mergeable sketches in one scan."""
    sketched = df.agg(
        *[
            F.percentile_approx(F.col(c).cast("double"), F.lit(list(probs)), F.lit(10_000)).alias(f"s{i}")
            for i, c in enumerate(columns)
        ]
    )
    rows = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("q")) for i, c in enumerate(columns)]
    )
    return sketched.select(F.explode(rows).alias("r")).select(
        "r.column", *[F.col("r.q")[i].alias(f"q{i}") for i in range(len(probs))]
    )


def _place(value: Column) -> Column:
    """A whole number that never falls as ``value`` grows: sign, exponent and the first 12 bits of the fraction.

    The logarithm may be off by one next to a power of two; the fraction is then 0 or 1 and the number the same.
    """
    size = F.abs(value)
    exponent = F.floor(F.log2(size))
    fraction = size / F.pow(F.lit(2.0), exponent) - 1.0
    number = ((exponent + 1100) * STEPS + F.floor(fraction * STEPS) + 1).cast("long")
    number = F.when(size == F.lit(float("inf")), F.lit(1 << 40)).otherwise(number)
    return F.when(value == 0, F.lit(0).cast("long")).when(value > 0, number).otherwise(-number)


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Exact, linearly interpolated quantiles: ``(*keys, column, n, q0, q1, ...)``, without a job before the query runs.

    One scan counts equal values, combined in the tasks. The counts are summed by :func:`_place`, a few
    thousand numbers for each power of two that a column spans, which finds the places that hold the wanted
    ranks; only the distinct values of those places are then sorted. So neither a column nor a hot key is
    ever in one buffer. Null and NaN count nowhere; a column (of a key) without values has no row.
    """
    ks = [f"__k{i}" for i in range(len(keys))]
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    values = df.select(*[F.col(k).alias(name) for k, name in zip(keys, ks, strict=True)], F.explode(entries).alias("p"))
    values = values.select(*ks, "p.column", "p.value").where("value is not null and not isnan(value)")
    group = [*ks, "column"]
    counted = values.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("rows")).withColumn("place", _place(F.col("value")))

    by_place = Window.partitionBy(*group).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    places = counted.groupBy(*group, "place").agg(F.sum("rows").alias("rows"))
    places = places.select("*", F.sum("rows").over(by_place).alias("upto"), F.sum("rows").over(Window.partitionBy(*group)).alias("n"))
    places = places.withColumn("before", F.col("upto") - F.col("rows"))
    positions = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    ranks = [f(position) for position in positions for f in (F.floor, F.ceil)]
    wanted = F.lit(False)
    for rank in ranks:
        wanted = wanted | ((F.col("before") <= rank) & (rank < F.col("upto")))
    chosen = places.where(wanted).select(*[F.col(g).alias(f"{g}_") for g in group], F.col("place").alias("place_"), "before", "n")

    # null-safe on all columns: keys may be null, and both sides read the counts in the same form
    same = F.lit(True)
    for g in [*group, "place"]:
        same = same & F.col(g).eqNullSafe(F.col(f"{g}_"))
    inside = Window.partitionBy(*group, "place").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.join(chosen, same).withColumn("upto", F.col("before") + F.sum("rows").over(inside))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("upto") - F.col("rows") <= rank) & (rank < F.col("upto")), F.col("value")))

    aggregates = []
    for i, position in enumerate(positions):
        aggregates += [at(F.floor(position)).alias(f"lo{i}"), at(F.ceil(position)).alias(f"hi{i}"), F.max(position - F.floor(position)).alias(f"part{i}")]
    between = [
        F.when(F.col(f"lo{i}") == F.col(f"hi{i}"), F.col(f"lo{i}"))
        .otherwise(F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"part{i}")).alias(f"q{i}")
        for i in range(len(probs))
    ]
    found = ranked.groupBy(*group).agg(F.max("n").alias("n"), *aggregates)
    return found.select(*[F.col(name).alias(k) for k, name in zip(keys, ks, strict=True)], "column", "n", *between)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, quartiles and max of each column, one row per column, in two scans."""
    moments = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(F.col(c).cast("double")).alias("min"),
            F.max(F.col(c).cast("double")).alias("max"),
        ).alias(f"s{i}")
        for i, c in enumerate(columns)
    ]
    stats = df.agg(*moments).select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(columns))])).alias("s")).select("s.*")
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "column", F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75")
    )
    return stats.join(quartiles, "column", "left")
