"""Dimension lookups, key-set filters and point-in-time lookups.

No broadcast hints: Spark broadcasts a side only while its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (re-checked at run time by AQE) and uses a
shuffle join, with skew splitting, beyond it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.timeutil import plus_hours
from tidecast.names import ACTUAL, HOUR, PREDICTED, ZONE
from tidecast.operators.windows import dedup


def lookup(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, columns: Mapping[str, str]
) -> DataFrame:
    """Fact left-joined with a dimension whose key has another name.

    ``columns`` maps dimension columns to output names.
    """
    side = dim.select(
        F.col(dim_key).alias("__key"), *[F.col(c).alias(name) for c, name in columns.items()]
    )
    return fact.join(side, F.col(fact_key) == F.col("__key"), "left").drop("__key")


def newest_by_parts(hourly: DataFrame, ts: str, names: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per (month, day, hour), named by ``names``: the newest year's values."""
    parts = [F.month(ts).alias(names[0]), F.day(ts).alias(names[1]), F.hour(ts).alias(names[2])]
    return (
        hourly.groupBy(*parts)
        .agg(F.max_by(F.struct(*columns), ts).alias("__newest"))
        .select(*names, *[F.col("__newest").getField(c).alias(c) for c in columns])
    )


def on_calendar_parts(fact: DataFrame, hourly: DataFrame, fact_ts: str, hourly_ts: str) -> DataFrame:
    """Left join on (month, day, hour) without the year; a fact row comes back once.

    Where the hourly side has several years, the newest one counts.
    """
    names = ["__month", "__day", "__hour"]
    left = fact.withColumns(dict(zip(names, (F.month(fact_ts), F.day(fact_ts), F.hour(fact_ts)), strict=True)))
    right = newest_by_parts(hourly, hourly_ts, names, [c for c in hourly.columns if c != hourly_ts])
    return left.join(right, names, "left").drop(*names)


def keys_in(df: DataFrame, keys: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    allowed = keys.select(F.col(dim_key or key).alias(key))
    return df.join(allowed, key, "left_semi")


def keys_missing(wanted: DataFrame, present: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Wanted keys that never occur."""
    return wanted.join(present, keys, "left_anti")


def values_at(
    df: DataFrame,
    at: Column,
    offsets: Mapping[str, tuple[str, int]],
    zone: str = ZONE,
    hour: str = HOUR,
    zones: DataFrame | None = None,
) -> DataFrame:
    """Per zone, the value of a column ``k`` hours before ``at``; absent rows give 0.

    ``offsets`` maps output names to (column, hours back). All lookups are one
    conditional aggregation over the needed hours instead of one join per offset. A zone
    without a row at any of these hours is absent, unless ``zones`` lists it.
    """
    needed = sorted({k for _, k in offsets.values()})
    rows = df.where(F.col(hour).isin([plus_hours(at, -k) for k in needed]))
    found = rows.groupBy(zone).agg(
        *[
            F.coalesce(
                F.max(F.when(F.col(hour) == plus_hours(at, -k), F.col(c).cast("double"))), F.lit(0.0)
            ).alias(name)
            for name, (c, k) in offsets.items()
        ]
    )
    return found if zones is None else zones.select(zone).distinct().join(found, zone, "left").na.fill(0.0, list(offsets))


def predictions_vs_actuals(
    predictions: DataFrame, actuals: DataFrame, keys: Sequence[str] = (HOUR, ZONE)
) -> DataFrame:
    """Every prediction with its measured value (0 when nothing was measured)."""
    return predictions.join(actuals, list(keys), "left").na.fill({ACTUAL: 0}).withColumn(
        "absolute_error", F.abs(F.col(ACTUAL) - F.col(PREDICTED))
    )


def upsert_frame(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], version: str | None = None
) -> DataFrame:
    """Union of both sides keeping one row per key, the new side (or higher version) winning."""
    both = existing.withColumn("__batch", F.lit(0)).unionByName(
        new.withColumn("__batch", F.lit(1)), allowMissingColumns=True
    )
    order = [F.desc("__batch")] + ([F.desc(version)] if version else [])
    rest = [F.col(c).asc_nulls_last() for c in sorted(existing.columns) if c not in keys]
    return dedup(both, keys, order + rest).drop("__batch")
