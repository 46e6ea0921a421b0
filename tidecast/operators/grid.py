"""Hour spines, dense hour x zone grids, hourly counts and as-of carries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.timeutil import hour_bucket, time_block
from tidecast.names import COUNT, HOUR, ZONE

ONE_HOUR = "interval 1 hour"


def hour_span(df: DataFrame, ts: str, mode: str = "round") -> tuple[Column, Column]:
    """First and last hour bucket of ``df`` as scalar subqueries (one one-column scan).

    Bucketing keeps order, so only the minimum and maximum are bucketed.
    """
    span = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).select(
        F.struct(hour_bucket("lo", mode).alias("lo"), hour_bucket("hi", mode).alias("hi")).alias("s")
    )
    packed = span.scalar()
    return packed.getField("lo"), packed.getField("hi")


def hours(start: Column, end: Column) -> Column:
    """Every hour from start to end, both included, as a generator column."""
    return F.explode(F.sequence(start, end, F.expr(ONE_HOUR)))


def hour_spine(df: DataFrame, ts: str, mode: str = "round", hour: str = HOUR) -> DataFrame:
    span = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    return span.select(hours(hour_bucket("lo", mode), hour_bucket("hi", mode)).alias(hour))


def zone_hours(
    zones: DataFrame, start: Column, end: Column, zone: str = ZONE, hour: str = HOUR
) -> DataFrame:
    """The complete grid: each zone row expands its own hours in place, without a join."""
    return zones.select(F.col(zone), hours(start, end).alias(hour))


def hourly_counts(
    df: DataFrame, ts: str, zone: str = ZONE, hour: str = HOUR, count: str = COUNT, mode: str = "round"
) -> DataFrame:
    """Rows per (hour, zone). Partial counts are merged map-side, so a hot zone costs
    at most one row per hour and task in the shuffle."""
    return (
        df.groupBy(hour_bucket(ts, mode).alias(hour), F.col(zone))
        .agg(F.count(F.lit(1)).alias(count))
    )


def densify(
    counts: DataFrame, grid: DataFrame, keys: Sequence[str] = (HOUR, ZONE), fill: dict | None = None
) -> DataFrame:
    """Grid left-joined with measured rows; missing cells become the fill value (default 0)."""
    fill = fill or {COUNT: 0}
    return grid.join(counts, list(keys), "left").na.fill(fill)


def dense_hourly_counts(
    df: DataFrame,
    ts: str,
    grid: DataFrame,
    zone: str = ZONE,
    hour: str = HOUR,
    count: str = COUNT,
    mode: str = "round",
) -> DataFrame:
    """Hourly counts on the complete grid with a single aggregation instead of
    aggregate + join: grid cells enter as zero rows and only their cells survive."""
    observed = df.select(
        F.col(zone), hour_bucket(ts, mode).alias(hour), F.lit(1).alias("n"), F.lit(0).alias("cell")
    )
    cells = grid.select(F.col(zone), F.col(hour), F.lit(0).alias("n"), F.lit(1).alias("cell"))
    return (
        observed.unionByName(cells)
        .groupBy(hour, zone)
        .agg(F.sum("n").alias(count), F.max("cell").alias("cell"))
        .where("cell = 1")
        .drop("cell")
    )


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    values: Sequence[str],
    tie_break: Sequence[str] = (),
    block: str = "day",
    left_grain: str | None = None,
) -> DataFrame:
    """Each left row with the newest right row of its key at or before it.

    The right row travels as one struct, so NULLs inside it survive. Rows of both
    sides are interleaved per (key, time block) - never a whole key in one task -
    and a second, tiny window over one row per block carries the newest right row
    of earlier blocks forward. ``block`` (hour, day, month, year) can be lowered when
    one key is dense. A NULL key or time matches nothing: such right rows are dropped,
    such left rows come back with NULL values. ``left_grain`` names the grain of the left
    times where they are whole hours or days: the right side is then reduced, map-side, to
    the newest row per key and next full step, so a dense key never reaches the windows.
    """
    keys = list(keys)
    complete = [F.col(k).isNotNull() for k in keys]
    right = right.where(reduce(and_, complete, F.col(right_ts).isNotNull()))
    matchable = reduce(and_, complete, F.col(left_ts).isNotNull())
    unmatched = left.where(~matchable)
    left = left.where(matchable)
    packed = F.struct(*[F.col(v) for v in values])
    if left_grain:
        tied = F.struct(F.col(right_ts), *[F.col(t) for t in tie_break])
        floor = F.date_trunc(left_grain, right_ts).cast("timestamp_ntz")
        step = F.when(floor == F.col(right_ts), floor).otherwise(floor + F.expr(f"interval 1 {left_grain}"))
        newest_in_step = right.groupBy(*keys, step.alias("__step")).agg(F.max_by(packed, tied).alias("__packed"))
        right, right_ts, tie_break = newest_in_step, "__step", ()
        packed = F.col("__packed")

    carried = [c for c in left.columns if c not in keys]
    lefts = left.select(
        *keys,
        F.col(left_ts).alias("__at"),
        time_block(left_ts, block).alias("__block"),
        F.lit(1).alias("__side"),
        F.struct(*carried).alias("__left"),
    )
    tie = F.struct(*[F.col(t) for t in tie_break]) if tie_break else F.lit(0)
    rights = right.select(
        *keys,
        F.col(right_ts).alias("__at"),
        time_block(right_ts, block).alias("__block"),
        F.lit(0).alias("__side"),
        tie.alias("__order"),
        packed.alias("__right"),
    )
    both = rights.unionByName(lefts, allowMissingColumns=True)

    inside = (
        Window.partitionBy(*keys, "__block")
        .orderBy("__at", "__side", "__order")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    local = both.withColumn("__here", F.last("__right", ignorenulls=True).over(inside)).where(
        "__side = 1"
    )

    newest = F.max_by("__right", F.struct("__at", "__order")).alias("__right")
    ends = rights.groupBy(*keys, "__block").agg(newest)
    blocks = lefts.select(*keys, "__block").distinct()
    across = (
        Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
        if keys
        else Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = (
        blocks.withColumn("__wanted", F.lit(True))
        .unionByName(ends, allowMissingColumns=True)
        .groupBy(*keys, "__block")
        .agg(F.max("__wanted").alias("__wanted"), F.first("__right", ignorenulls=True).alias("__right"))
        .withColumn("__before", F.last("__right", ignorenulls=True).over(across))
        .where("__wanted")
        .select(*keys, "__block", "__before")
    )
    joined = local.join(carry, [*keys, "__block"], "left")
    hit = F.coalesce("__here", "__before")
    matched = joined.select(
        *keys,
        *[F.col("__left").getField(c).alias(c) for c in carried],
        *[hit.getField(v).alias(v) for v in values],
    )
    return matched.unionByName(unmatched.select(*keys, *carried), allowMissingColumns=True)
