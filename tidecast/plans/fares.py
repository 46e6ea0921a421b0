"""Exploratory fare model: clean trips -> hourly means per zone -> enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.functions.fixed_values import CLOUD_FRACTION, PRECIPITATION_WORDS
from tidecast.functions.scalars import clean_numeric, recode
from tidecast.functions.timeutil import date_parts, hour_bucket, is_us_holiday, week_day, weekend_flag
from tidecast.names import HOUR, WEATHER_COLUMNS
from tidecast.operators.aggregates import mean_and_count
from tidecast.operators.joins import lookup, newest_by_parts
from tidecast.operators.windows import bfill, interpolate
from tidecast.plans.weather import OBSERVED

CATEGORIES = [
    "transaction_date",
    "transaction_month",
    "transaction_day",
    "transaction_hour",
]


def fare_groups(
    trips: DataFrame,
    ts: str,
    zone: str,
    total: str,
    measures: Sequence[str],
    low: float = 0,
    high: float = 200,
) -> DataFrame:
    """Mean measures and trip count per zone and hour of trips with ``low <= total < high``."""
    kept = trips.where((F.col(total) >= low) & (F.col(total) < high))
    parted = kept.withColumns(date_parts(ts))
    return mean_and_count(parted, [zone, *CATEGORIES], measures, "count_of_transactions")


def enrich(groups: DataFrame, zones: DataFrame, zone: str, zone_key: str = "LocationID") -> DataFrame:
    day = "transaction_date"
    dated = groups.withColumns(
        {
            "transaction_week_day": week_day(day),
            "weekend": weekend_flag(day),
            "is_holiday": is_us_holiday(day).cast("int"),
        }
    )
    return lookup(dated, zones, zone, zone_key, {"Borough": "Borough"})


def interpolated_weather(obs: DataFrame, ts: str, order: Sequence[str]) -> DataFrame:
    """Newest observation per hour with gaps interpolated, the head filled backward.

    Cloud cover is a fraction here and unknown words are gaps. The fills run over one
    row per observed hour, a year of hours in one task.
    """
    newest = (
        obs.groupBy(hour_bucket(ts, "floor").alias(HOUR))
        .agg(F.max_by(F.struct(*OBSERVED), F.struct(*order)).alias("r"))
        .select(HOUR, "r.*")
    )
    hourly = newest.select(
        HOUR,
        "temperature",
        "humidity",
        "wind_speed",
        recode("cloud_cover", CLOUD_FRACTION).alias("cloud_cover_numeric"),
        clean_numeric("amount_of_precipitation", PRECIPITATION_WORDS, None).alias("amount_of_precipitation"),
    )
    filled = interpolate(hourly, WEATHER_COLUMNS, keys=[], block="year")
    return bfill(filled, WEATHER_COLUMNS, keys=[], block="year")


def add_weather_by_parts(groups: DataFrame, hourly: DataFrame) -> DataFrame:
    """Weather joined on (month, day, hour); of several years the newest one counts."""
    parts = ["transaction_month", "transaction_day", "transaction_hour"]
    keyed = newest_by_parts(hourly, HOUR, parts, WEATHER_COLUMNS)
    return groups.join(keyed, parts, "left")
