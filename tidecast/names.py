"""Column names shared by every stage (the published data contract)."""

HOUR = "hourly_timestamp"
ZONE = "PULocationID"
COUNT = "ride_count"
TARGET = "target"
ACTUAL = "actual"
PREDICTED = "predicted"

CALENDAR_COLUMNS = [
    "hour_of_day",
    "day_of_week",
    "day_of_month",
    "is_weekend",
    "is_holiday",
    "is_rush_hour",
]
WEATHER_COLUMNS = [
    "temperature",
    "humidity",
    "wind_speed",
    "cloud_cover_numeric",
    "amount_of_precipitation",
]


def lag_name(steps: int, column: str = COUNT) -> str:
    return f"lag_{steps}_{column}"


def rolling_name(hours: int) -> str:
    return f"rolling_mean_{hours}h"
