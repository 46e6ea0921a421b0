"""Per-key time-series columns on regular (one row per key and hour) series.

A series has one row per key and hour, so the rows of one key are bounded by the
calendar, whatever the number of raw events. All columns of one call share a
single window specification and therefore one exchange and one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.timeutil import time_block
from tidecast.names import COUNT, HOUR, ZONE, lag_name, rolling_name


def series_window(keys: Sequence[str] | str = ZONE, ts: str = HOUR):
    keys = [keys] if isinstance(keys, str) else list(keys)
    return Window.partitionBy(*keys).orderBy(ts)


def lag_columns(steps: Sequence[int], column: str = COUNT, window=None, default=None) -> dict[str, Column]:
    w = window or series_window()
    return {lag_name(k, column): F.lag(column, k, default).over(w).cast("double") for k in steps}


def rolling_columns(
    hours: Sequence[int],
    column: str = COUNT,
    window=None,
    include_current: bool = False,
    min_periods: int | None = None,
) -> dict[str, Column]:
    """Mean of the last ``h`` rows; NULL until ``min_periods`` (default: all ``h``) are there."""
    w = window or series_window()
    out = {}
    for h in hours:
        frame = w.rowsBetween(-(h - 1), 0) if include_current else w.rowsBetween(-h, -1)
        need = h if min_periods is None else min_periods
        mean = F.avg(column).over(frame)
        out[rolling_name(h)] = F.when(F.count(column).over(frame) >= need, mean)
    return out


def lead_column(column: str = COUNT, steps: int = 1, window=None) -> Column:
    return F.lead(column, steps).over(window or series_window()).cast("double")


def add_lags(df: DataFrame, steps, column=COUNT, keys=ZONE, ts=HOUR, default=None) -> DataFrame:
    return df.withColumns(lag_columns(steps, column, series_window(keys, ts), default))


def add_rolling(
    df: DataFrame, hours, column=COUNT, keys=ZONE, ts=HOUR, include_current=False, min_periods=None
) -> DataFrame:
    return df.withColumns(
        rolling_columns(hours, column, series_window(keys, ts), include_current, min_periods)
    )


def add_target(df: DataFrame, column=COUNT, keys=ZONE, ts=HOUR, name="target") -> DataFrame:
    return df.withColumn(name, lead_column(column, 1, series_window(keys, ts)))


def _ordered(keys: Sequence[str], ts: str, forward: bool):
    """Rows of a key in the direction of a fill.

    A backward fill is a forward fill over the reversed order: a frame that starts at the current
    row and ends at the last one would be computed anew for every row.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(ts).asc() if forward else F.col(ts).desc())
    return w.rowsBetween(Window.unboundedPreceding, 0)


def _known(df: DataFrame, points: dict[str, Column], keys: Sequence[str], ts: str, forward: bool, block: str | None):
    """Add, for each named expression, its last non-NULL value up to the row (in the fill's direction)."""
    if block is None:
        w = _ordered(keys, ts, forward)
        return df.withColumns({name: F.last(e, ignorenulls=True).over(w) for name, e in points.items()})

    # (key, time block) groups only; one value per block and column crosses block borders
    blocked = df.withColumn("__block", time_block(ts, block)).withColumns({f"__at_{n}": e for n, e in points.items()})
    inside = _ordered([*keys, "__block"], ts, forward)
    edge = F.max_by if forward else F.min_by
    ends = blocked.groupBy(*keys, "__block").agg(
        *[edge(f"__at_{n}", F.when(F.col(f"__at_{n}").isNotNull(), F.col(ts))).alias(n) for n in points]
    )
    order = F.col("__block").asc() if forward else F.col("__block").desc()
    across = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*keys, "__block", *[F.last(n, ignorenulls=True).over(across).alias(f"__carry_{n}") for n in points])
    return (
        blocked.withColumns({f"__in_{n}": F.last(f"__at_{n}", ignorenulls=True).over(inside) for n in points})
        .join(carry, [*keys, "__block"])
        .select(*df.columns, *[F.coalesce(f"__in_{n}", f"__carry_{n}").alias(n) for n in points])
    )


def _fill(df: DataFrame, columns: Sequence[str], keys, ts: str, forward: bool, block: str | None):
    keys = [keys] if isinstance(keys, str) else list(keys)
    found = _known(df, {f"__fill_{c}": F.col(c) for c in columns}, keys, ts, forward, block)
    return found.select(*[F.col(f"__fill_{c}").alias(c) if c in columns else F.col(c) for c in df.columns])


def ffill(df: DataFrame, columns: Sequence[str], keys=ZONE, ts=HOUR, block: str | None = None) -> DataFrame:
    """Last known value per key. ``block`` (hour, day, month, year) splits long or hot keys
    by time; it needs distinct, non-NULL keys and timestamps."""
    return _fill(df, columns, keys, ts, True, block)


def bfill(df: DataFrame, columns: Sequence[str], keys=ZONE, ts=HOUR, block: str | None = None) -> DataFrame:
    """Next known value per key; ``block`` as in :func:`ffill`."""
    return _fill(df, columns, keys, ts, False, block)


def fill_chain(df: DataFrame, defaults: dict, keys=ZONE, ts=HOUR, block: str | None = None) -> DataFrame:
    """Forward fill, then backward fill, then the column's default; ``block`` as in :func:`ffill`."""
    columns = list(defaults)
    return bfill(ffill(df, columns, keys, ts, block), columns, keys, ts, block).withColumns(
        {c: F.coalesce(F.col(c), F.lit(value)) for c, value in defaults.items()}
    )


def _numbered(df: DataFrame, keys: Sequence[str], ts: str, block: str | None) -> DataFrame:
    """Row number per key as ``__rn``; with ``block`` from the number inside the block and the sizes of earlier ones."""
    if block is None:
        return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(ts)))
    blocked = df.withColumn("__block", time_block(ts, block))
    sizes = blocked.groupBy(*keys, "__block").agg(F.count(F.lit(1)).alias("__size"))
    earlier = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    skips = sizes.select(*keys, "__block", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__skip"))
    inside = F.row_number().over(Window.partitionBy(*keys, "__block").orderBy(ts))
    return (
        blocked.withColumn("__in", inside)
        .join(skips, [*keys, "__block"])
        .select(*df.columns, (F.col("__in") + F.col("__skip")).alias("__rn"))
    )


def interpolate(df: DataFrame, columns: Sequence[str], keys=ZONE, ts=HOUR, block: str | None = None) -> DataFrame:
    """Linear interpolation by row position; the tail repeats the last value, the head stays NULL.

    ``block`` as in :func:`ffill`.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    numbered = _numbered(df, keys, ts, block)
    points = {c: F.when(F.col(c).isNotNull(), F.struct(F.col("__rn").alias("rn"), F.col(c).alias("v"))) for c in columns}
    around = _known(numbered, {f"__before_{c}": e for c, e in points.items()}, keys, ts, True, block)
    around = _known(around, {f"__after_{c}": e for c, e in points.items()}, keys, ts, False, block)
    filled = {}
    for c in columns:
        before, after = F.col(f"__before_{c}"), F.col(f"__after_{c}")
        step = (F.col("__rn") - before["rn"]) / (after["rn"] - before["rn"])
        filled[c] = (
            F.when(F.col(c).isNotNull(), F.col(c))
            .when(after.isNull(), before["v"])
            .otherwise(before["v"] + (after["v"] - before["v"]) * step)
            .alias(c)
        )
    return around.select(*[filled.get(c, F.col(c)) for c in df.columns])


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given total order.

    Spark limits each key to one candidate row before the shuffle (window group
    limit), so copies of a hot key never meet in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def first_n_per_key(df: DataFrame, n: int, keys=ZONE, ts=HOUR) -> DataFrame:
    return (
        df.withColumn("__rn", F.row_number().over(series_window(keys, ts)))
        .where(F.col("__rn") <= n)
        .drop("__rn")
    )


def positional_folds(df: DataFrame, n_folds: int, zone=ZONE, ts=HOUR, name: str = "fold") -> DataFrame:
    """Expanding-window folds by row position in (zone, time) order.

    Fold 0 is only ever trained on; fold i (1..n) is tested after training on all
    rows before it. Positions come from one count per zone plus the row number
    inside the zone: no global sort of the rows.
    """
    sizes = df.groupBy(zone).agg(F.count(F.lit(1)).alias("__size"))
    # one row per zone: this window is as long as the zone dimension
    order = Window.orderBy(zone)
    offsets = sizes.select(
        F.col(zone),
        (F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__size")).alias("__skip"),
        F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__all"),
    )
    position = F.row_number().over(series_window(zone, ts)) - 1 + F.col("__skip")
    block = F.floor(F.col("__all") / (n_folds + 1))
    start = F.col("__all") - n_folds * block
    return (
        df.join(offsets, zone)
        .withColumn("__pos", position)
        .withColumn(
            name,
            F.when(F.col("__pos") < start, F.lit(0))
            .otherwise(F.floor((F.col("__pos") - start) / block) + 1)
            .cast("int"),
        )
        .drop("__skip", "__all", "__pos")
    )


def chronological_folds(df: DataFrame, n_folds: int, ts=HOUR, name: str = "fold") -> DataFrame:
    """Expanding-window folds over the distinct hours: every zone shares the same cuts."""
    # one row per distinct hour: the window is as long as the calendar
    order = Window.orderBy(ts)
    distinct_hours = df.select(ts).distinct()
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    block = F.floor(F.col("__n") / (n_folds + 1))
    start = F.col("__n") - n_folds * block
    folds = (
        distinct_hours.withColumn("__pos", F.row_number().over(order) - 1)
        .withColumn("__n", F.count(F.lit(1)).over(everything))
        .select(
            ts,
            F.when(F.col("__pos") < start, F.lit(0))
            .otherwise(F.floor((F.col("__pos") - start) / block) + 1)
            .cast("int")
            .alias(name),
        )
    )
    return df.join(folds, ts)


def assign_folds(df: DataFrame, n_folds: int = 5, mode: str = "chronological", zone=ZONE, ts=HOUR) -> DataFrame:
    if mode == "positional":
        return positional_folds(df, n_folds, zone, ts)
    if mode == "chronological":
        return chronological_folds(df, n_folds, ts)
    raise ValueError(f"unknown fold mode: {mode}")
