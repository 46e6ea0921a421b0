"""Feature sets on the hour x zone grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.fixed_values import (
    BUSY_ZONES,
    DATASET_LAGS,
    DOWNTOWN_ZONES,
    EVENING_RUSH_HOURS,
    EVENT_HOURS,
    ROLLING_HOURS,
    STORE_LAGS,
)
from tidecast.functions.scalars import flag, flag_above, flag_in
from tidecast.functions.timeutil import calendar_features, plus_hours
from tidecast.names import (
    CALENDAR_COLUMNS,
    COUNT,
    HOUR,
    TARGET,
    WEATHER_COLUMNS,
    ZONE,
    lag_name,
    rolling_name,
)
from tidecast.operators.aggregates import latest_mean
from tidecast.operators.grid import dense_hourly_counts, hour_span, zone_hours
from tidecast.operators.joins import lookup, values_at
from tidecast.operators.quality import between_ts
from tidecast.operators.windows import (
    lag_columns,
    lead_column,
    rolling_columns,
    series_window,
)


def add_calendar(df: DataFrame, ts: str = HOUR) -> DataFrame:
    return df.withColumns(calendar_features(ts))


def add_zone_features(
    df: DataFrame,
    zones: DataFrame | None = None,
    downtown: Sequence[int] = DOWNTOWN_ZONES,
    zone: str = ZONE,
    zone_key: str = "LocationID",
    columns: dict[str, str] | None = None,
) -> DataFrame:
    if zones is not None:
        df = lookup(df, zones, zone, zone_key, columns or {"Zone": "zone_name"})
    return df.withColumn("is_downtown", flag_in(zone, downtown))


def add_weather(df: DataFrame, weather: DataFrame) -> DataFrame:
    return df.join(weather.select(HOUR, *WEATHER_COLUMNS), HOUR, "left").na.fill(
        {"amount_of_precipitation": 0.0}
    )


def add_interactions(
    df: DataFrame,
    busy_zones: Sequence[int] = BUSY_ZONES,
    event_hours: Sequence[int] = EVENT_HOURS,
    zone: str = ZONE,
) -> DataFrame:
    """Event, rain and rush flags with their products."""
    weekend = F.col("is_weekend") == 1
    hour = F.col("hour_of_day")
    base = df.withColumns(
        {
            "has_event": flag(F.col(zone).isin(list(busy_zones)) & hour.isin(list(event_hours)) & weekend),
            "is_raining": flag_above("amount_of_precipitation"),
            "is_evening_rush": flag(hour.isin(EVENING_RUSH_HOURS) & ~weekend),
        }
    )
    return interact(
        base,
        {
            "is_raining_downtown": ("is_raining", "is_downtown"),
            "is_weekend_hour": ("is_weekend", "hour_of_day"),
            "is_rush_hour_downtown": ("is_rush_hour", "is_downtown"),
            "is_downtown_hour": ("is_downtown", "hour_of_day"),
        },
    )


def interact(df: DataFrame, products: dict[str, tuple[str, str]]) -> DataFrame:
    return df.withColumns({name: F.col(a) * F.col(b) for name, (a, b) in products.items()})


def hourly_series(
    events: DataFrame,
    ts: str,
    zones: DataFrame,
    zone: str = ZONE,
    zone_key: str = "LocationID",
    start: Column | None = None,
    end: Column | None = None,
    only_observed: bool = False,
    mode: str = "round",
) -> DataFrame:
    """Complete hourly counts per zone: ``(hour, zone, count)``.

    Without explicit bounds the grid spans the observed hours. ``only_observed``
    keeps zones that occur in the events (and in the dimension); otherwise every
    zone of the dimension gets a series.
    """
    if start is None or end is None:
        low, high = hour_span(events, ts, mode)
        start, end = (low if start is None else start), (high if end is None else end)
    keys = zones.select(F.col(zone_key).alias(zone)).distinct()
    if only_observed:
        keys = keys.join(events.select(zone).distinct(), zone, "left_semi")
    grid = zone_hours(keys, start, end, zone)
    return dense_hourly_counts(events, ts, grid, zone, mode=mode)


def featured(
    series: DataFrame, weather: DataFrame, zones: DataFrame | None = None, downtown: Sequence[int] = DOWNTOWN_ZONES
) -> DataFrame:
    """Series with calendar, zone and weather columns, all recomputed on the grid."""
    out = add_weather(add_zone_features(add_calendar(series), zones, downtown), weather)
    return out.withColumn("zone", F.col(ZONE))


def series_dataset(
    base: DataFrame,
    lags: Sequence[int] = DATASET_LAGS,
    rolling: Sequence[int] = ROLLING_HOURS,
    on_missing: str = "drop",
) -> DataFrame:
    """Lags, rolling means of the preceding hours and the next-hour target.

    One window specification serves all columns: one exchange, one sort.
    """
    w = series_window()
    columns = {
        **lag_columns(lags, COUNT, w),
        **rolling_columns(rolling, COUNT, w),
        TARGET: lead_column(COUNT, 1, w),
    }
    out = base.withColumns(columns)
    if on_missing == "drop":
        return out.na.drop(subset=list(columns))
    if on_missing == "zero":
        return out.na.fill(0.0, subset=list(columns))
    raise ValueError("on_missing must be 'drop' or 'zero'")


def feature_store(
    events: DataFrame,
    ts: str,
    zones: DataFrame,
    weather: DataFrame,
    start: Column,
    end: Column,
    downtown: Sequence[int] = DOWNTOWN_ZONES,
) -> DataFrame:
    """Serving features of a period: every zone of the dimension, rolling means that
    include the current hour, and 0 wherever history is missing."""
    period = events.where(between_ts(ts, start, end, closed="both"))
    series = hourly_series(period, ts, zones, start=start, end=end)
    base = featured(series, weather, zones, downtown).withColumn("LocationID", F.col(ZONE))
    w = series_window()
    return base.withColumns(
        {
            **lag_columns(STORE_LAGS, COUNT, w),
            **rolling_columns(ROLLING_HOURS, COUNT, w, include_current=True, min_periods=1),
        }
    ).na.fill(0.0)


def next_hour_rows(
    store: DataFrame,
    zones: DataFrame,
    weather: DataFrame | None = None,
    downtown: Sequence[int] = DOWNTOWN_ZONES,
    mode: str = "aligned",
    zone_key: str = "LocationID",
) -> DataFrame:
    """Feature rows for scoring the hour after the newest stored hour, all zones.

    ``aligned``: the stored rows of the newest hour, whose target *is* the next hour; a zone whose
    newest row is older has no such row and none here.
    ``parity``: a row keyed by the next hour itself with its own calendar, weather
    (or the mean weather of the newest hour) and looked-up lags.
    """
    newest = store.agg(F.max(HOUR)).scalar()
    keys = zones.select(F.col(zone_key).alias(ZONE)).distinct()
    if mode == "aligned":
        return store.where(F.col(HOUR) == newest).join(keys, ZONE, "left_semi")
    if mode != "parity":
        raise ValueError("mode must be 'aligned' or 'parity'")
    target = plus_hours(newest, 1)
    offsets = {lag_name(k): (COUNT, k) for k in STORE_LAGS}
    offsets |= {rolling_name(h): (rolling_name(h), 1) for h in ROLLING_HOURS}
    history = values_at(store, target, offsets, zones=keys)
    rows = add_zone_features(add_calendar(keys.withColumn(HOUR, target)), None, downtown)
    if weather is None:
        packed = latest_mean(store, HOUR, WEATHER_COLUMNS).select(F.struct(*WEATHER_COLUMNS)).scalar()
        rows = rows.withColumns({c: packed.getField(c) for c in WEATHER_COLUMNS})
    else:
        rows = rows.join(weather.select(HOUR, *WEATHER_COLUMNS), HOUR, "left")
    return (
        rows.join(history, ZONE, "left")
        .na.fill(0.0)
        .select(HOUR, ZONE, *CALENDAR_COLUMNS, *WEATHER_COLUMNS, "is_downtown", *offsets)
    )


def split_by_time(df: DataFrame, cut: Column, ts: str = HOUR) -> tuple[DataFrame, DataFrame]:
    """(rows up to and including the cut, rows after it)."""
    return df.where(F.col(ts) <= cut), df.where(F.col(ts) > cut)
