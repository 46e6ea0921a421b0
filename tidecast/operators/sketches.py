"""Sketches stored per period: monitoring reads a few binary rows instead of the base table again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameters: a quantile sketch's rank error is near 1.7 / K, a distinct sketch's standard error 0.83 / 2^(LG_K / 2).
KLL_K, HLL_LG_K = 200, 12


def period_sketches(df: DataFrame, period: Column, measures: Sequence[str], identities: Sequence[str] = ()) -> DataFrame:
    """``(period, column, n, n_null, lo, hi, quantiles, distinct)``: one row per period and column, from one scan.

    ``measures`` get a quantile sketch and extremes, ``identities`` a sketch of their distinct values; the other
    cells are null. NaN counts as null.
    """
    entries = []
    for c in measures:
        x = F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
        entries.append(
            F.struct(
                F.lit(c).alias("column"), F.count(x).alias("n"), F.count_if(x.isNull()).alias("n_null"), F.min(x).alias("lo"), F.max(x).alias("hi"),
                F.kll_sketch_agg_double(x, F.lit(KLL_K)).alias("quantiles"), F.lit(None).cast("binary").alias("distinct"),
            )
        )
    for c in identities:
        none = F.lit(None).cast("double")
        entries.append(
            F.struct(
                F.lit(c).alias("column"), F.count(c).alias("n"), F.count_if(F.col(c).isNull()).alias("n_null"), none.alias("lo"), none.alias("hi"),
                F.lit(None).cast("binary").alias("quantiles"), F.hll_sketch_agg(F.col(c), F.lit(HLL_LG_K)).alias("distinct"),
            )
        )
    names = [f"e{i}" for i in range(len(entries))]
    grouped = df.groupBy(period.alias("period")).agg(*[e.alias(n) for e, n in zip(entries, names, strict=True)])
    return grouped.select("period", F.explode(F.array(*names)).alias("e")).select("period", "e.*")


def merged(stored: DataFrame) -> DataFrame:
    """``(column, periods, n, n_null, lo, hi, quantiles, distinct)`` over all stored periods."""
    return stored.groupBy("column").agg(
        F.count_distinct("period").alias("periods"), F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("distinct").alias("distinct"),
    )


def estimates(stored: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``(column, periods, n, n_null, lo, hi, q0, q1, ..., n_distinct)``; null where a column has no such sketch."""
    whole = merged(stored)
    found = [
        F.when(F.col("lo").isNotNull(), F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))).alias(f"q{i}") for i, p in enumerate(probs)
    ]
    distinct = F.when(F.col("lo").isNull(), F.hll_sketch_estimate("distinct")).alias("n_distinct")
    return whole.select("column", "periods", "n", "n_null", "lo", "hi", *found, distinct)


def stored_shift(stored: DataFrame, column: str, is_current: Column, bins: int = 10) -> DataFrame:
    """Population stability per bin between stored base and current periods: ``(bin, base_share, current_share, psi)``.

    Bins are between the base's quantiles, which come from its sketch (``bins - 1`` numbers, read from the stored
    rows before the query), as do the shares of either side. An empty bin counts as one millionth.
    """
    own = stored.where((F.col("column") == column) & (F.col("n") > 0))
    base, current = merged(own.where(~is_current)), merged(own.where(is_current))
    cuts = [F.kll_sketch_get_quantile_double("quantiles", F.lit(i / bins)) for i in range(1, bins)]
    edges = base.select(F.array(*cuts)).first()
    if edges is None:
        raise LookupError(f"no stored base period has values of {column}")
    both = base.select(F.col("quantiles").alias("base")).join(current.select(F.col("quantiles").alias("current")))  # one row and one row

    def shares(side: str) -> list[Column]:
        ranks = [F.lit(0.0), *[F.kll_sketch_get_rank_double(side, F.lit(e)) for e in edges[0]], F.lit(1.0)]
        return [high - low for low, high in zip(ranks, ranks[1:])]

    rows = F.array(
        *[F.struct(F.lit(i).alias("bin"), b.alias("base_share"), c.alias("current_share")) for i, (b, c) in enumerate(zip(shares("base"), shares("current")))]
    )
    floor = F.lit(1e-6)
    p, q = F.greatest("base_share", floor), F.greatest("current_share", floor)
    return both.select(F.explode(rows).alias("r")).select("r.*").withColumn("psi", (q - p) * F.ln(q / p))
