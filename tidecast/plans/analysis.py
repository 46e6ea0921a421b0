"""Error analysis and monitoring reports on scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.fixed_values import DRIFT_RATIO, MAP_RADIUS_DIVISOR
from tidecast.functions.scalars import absolute_error
from tidecast.functions.timeutil import week_day
from tidecast.names import ACTUAL, HOUR, PREDICTED, ZONE
from tidecast.operators.aggregates import drift, error_slices, hourly_mae, top_groups
from tidecast.operators.windows import first_n_per_key

SLICE_DIMENSIONS = [ZONE, "hour", "day_of_week", "is_rush_hour", "is_holiday", "is_weekend"]
ZONE_SLICE_DIMENSIONS = ["hour", "day_of_week", "is_rush_hour", "is_weekend"]


def error_table(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Actual, predicted and absolute error per hour and zone, with slice columns."""
    return scored.select(
        HOUR,
        ZONE,
        "zone",
        "is_rush_hour",
        "is_holiday",
        "is_weekend",
        F.col(actual).cast("double").alias(ACTUAL),
        F.col(predicted).cast("double").alias(PREDICTED),
        absolute_error(actual, predicted).cast("double").alias("absolute_error"),
        F.hour(HOUR).alias("hour"),
        week_day(HOUR).alias("day_of_week"),
    )


def slice_report(errors: DataFrame, dims: Sequence[str] = tuple(SLICE_DIMENSIONS)) -> DataFrame:
    return error_slices(errors, list(dims))


def busiest_zones(errors: DataFrame, k: int = 10) -> DataFrame:
    return top_groups(errors, [ZONE, "zone"], "absolute_error", k, "absolute_error")


def zone_slice_report(errors: DataFrame, k: int = 10) -> DataFrame:
    """The slices inside each of the k zones with the highest mean error."""
    top = busiest_zones(errors, k).select(ZONE)
    rows = errors.join(top, ZONE, "left_semi")
    return error_slices(rows, ZONE_SLICE_DIMENSIONS, within=[ZONE])


def zone_series(errors: DataFrame, k: int = 10, first_hours: int = 24 * 7) -> DataFrame:
    """Actual and predicted values of the first hours of the k worst zones."""
    top = busiest_zones(errors, k).select(ZONE)
    rows = errors.join(top, ZONE, "left_semi")
    return first_n_per_key(rows, first_hours).select(ZONE, HOUR, ACTUAL, PREDICTED)


def online_vs_offline(errors: DataFrame, offline: DataFrame) -> DataFrame:
    """Online MAE per hour beside the constant offline scores of the model's metadata row."""
    packed = offline.select(F.struct(*offline.columns)).scalar()
    return hourly_mae(errors).withColumns({c: packed.getField(c) for c in offline.columns})


def drift_report(errors: DataFrame, offline_mae: Column | float, ratio: float = DRIFT_RATIO) -> DataFrame:
    return drift(hourly_mae(errors), offline_mae, ratio)


def scatter(errors: DataFrame, zones: DataFrame, zone_key: str = ZONE) -> DataFrame:
    keys = zones.select(F.col(zone_key).alias(ZONE)).distinct()
    return errors.join(keys, ZONE, "left_semi").select(ACTUAL, PREDICTED, HOUR, ZONE)


def demand_map(
    predictions: DataFrame,
    coordinates: DataFrame,
    predicted: str = "predicted_ride_count",
    divisor: float = MAP_RADIUS_DIVISOR,
) -> DataFrame:
    """Predicted demand with zone coordinates and marker radius; zones without coordinates drop out."""
    return predictions.join(coordinates, ZONE).select(
        HOUR, ZONE, "latitude", "longitude", predicted, (F.col(predicted) / divisor).alias("radius")
    )
