"""Hourly weather dimension from irregular observations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.fixed_values import CLOUD_COVER, CLOUD_COVER_DEFAULT, PRECIPITATION_WORDS
from tidecast.functions.scalars import clean_numeric, recode
from tidecast.functions.timeutil import hour_bucket
from tidecast.names import HOUR
from tidecast.operators.grid import hour_spine

OBSERVED = ["temperature", "humidity", "wind_speed", "cloud_cover", "amount_of_precipitation"]
FILLED = ["temperature", "humidity", "wind_speed", "cloud_cover_numeric"]


def clean_observations(
    obs: DataFrame,
    cloud_map: Mapping[str, float] = CLOUD_COVER,
    cloud_default: float | None = CLOUD_COVER_DEFAULT,
    words: Mapping[str, float] = PRECIPITATION_WORDS,
) -> DataFrame:
    """Numeric cloud cover and precipitation from their text columns."""
    return obs.withColumns(
        {
            "cloud_cover_numeric": recode("cloud_cover", cloud_map, cloud_default),
            "amount_of_precipitation": clean_numeric("amount_of_precipitation", words, 0.0),
        }
    )


def resample_hourly(obs: DataFrame, ts: str, columns: list[str], order: list[str]) -> DataFrame:
    """One row per hour between the first and last observation.

    An hour without observations repeats the newest earlier row as a whole, NULLs
    included. Several observations of one hour keep the newest. The window runs
    over the hour dimension (8,760 rows per year), never over the observations:
    those are first reduced to one row per hour with mergeable partial maxima.
    """
    per_hour = obs.groupBy(hour_bucket(ts).alias(HOUR)).agg(
        F.max_by(F.struct(*columns), F.struct(*order)).alias("__row")
    )
    carried = Window.orderBy(HOUR).rowsBetween(Window.unboundedPreceding, 0)
    return (
        hour_spine(obs, ts)
        .join(per_hour, HOUR, "left")
        .select(HOUR, F.last("__row", ignorenulls=True).over(carried).alias("__row"))
        .select(HOUR, *[F.col("__row").getField(c).alias(c) for c in columns])
    )


def weather_by_hour(
    obs: DataFrame, ts: str, order: list[str], zero_head: bool = False, **cleaning
) -> DataFrame:
    """Resample -> clean -> column-wise forward fill; precipitation gaps are 0.

    Text is cleaned after the reduction to one row per hour: cleaning is row-wise, so
    the result is the same and only hours are parsed, not observations. Weather
    depends on the hour only, so filling here equals filling after the join to the
    zones. ``zero_head`` also closes leading gaps with 0.
    """
    hourly = clean_observations(resample_hourly(obs, ts, OBSERVED, order), **cleaning)
    carried = Window.orderBy(HOUR).rowsBetween(Window.unboundedPreceding, 0)
    filled = hourly.select(
        HOUR,
        *[F.last(c, ignorenulls=True).over(carried).alias(c) for c in FILLED],
        F.coalesce("amount_of_precipitation", F.lit(0.0)).alias("amount_of_precipitation"),
    )
    return filled.na.fill({c: 0.0 for c in FILLED}) if zero_head else filled
