"""Schema contracts of the stage outputs (fixed values: names and types are the interface)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.functions.fixed_values import DATASET_LAGS, ROLLING_HOURS, STORE_LAGS
from tidecast.names import COUNT, HOUR, TARGET, WEATHER_COLUMNS, ZONE, lag_name, rolling_name


_TYPES = {
    "tinyint": T.ByteType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct(text: str) -> T.StructType:
    """``name type, name type`` as a schema (usable before any session exists)."""
    fields = []
    for item in text.split(","):
        name, kind = item.strip().rsplit(" ", 1)
        fields.append(T.StructField(name.strip("` "), _TYPES[kind]))
    return T.StructType(fields)


RAW_TRIP = struct(
    """tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, VendorID int,
    RatecodeID int, PULocationID int, DOLocationID int, payment_type int, passenger_count double,
    trip_distance double, fare_amount double, tip_amount double, tolls_amount double,
    total_amount double, congestion_surcharge double, store_and_fwd_flag string"""
)
ZONE_LOOKUP = struct("LocationID int, Borough string, Zone string, service_zone string")
OBSERVATION_FILE = struct(
    """`date and time` string, temperature double, humidity double, `wind speed` double,
    `cloud cover` string, `amount of precipitation` string"""
)

_KEYS = f"{HOUR} timestamp_ntz, {ZONE} int, {COUNT} int"
_CALENDAR = """hour_of_day int, day_of_week int, day_of_month int,
    is_weekend tinyint, is_holiday tinyint, is_rush_hour tinyint"""
_WEATHER = ", ".join(f"{c} double" for c in WEATHER_COLUMNS)
_ROLLING = ", ".join(f"{rolling_name(h)} double" for h in ROLLING_HOURS)

FEATURED = struct(f"{_KEYS}, {_CALENDAR}, {_WEATHER}, is_downtown tinyint, zone int")
ENHANCED = T.StructType(
    FEATURED.fields
    + struct(
        """has_event tinyint, is_raining tinyint, is_raining_downtown tinyint, is_evening_rush tinyint,
        is_weekend_hour int, is_rush_hour_downtown tinyint, is_downtown_hour int"""
    ).fields
)
DATASET = T.StructType(
    FEATURED.fields
    + struct(", ".join(f"{lag_name(k)} double" for k in DATASET_LAGS)).fields
    + struct(f"{_ROLLING}, {TARGET} double").fields
)
FEATURE_STORE = struct(
    f"{_KEYS}, {_CALENDAR}, {_WEATHER}, is_downtown tinyint, "
    + ", ".join(f"{lag_name(k)} double" for k in STORE_LAGS)
    + f", {_ROLLING}, zone int, LocationID int, zone_name string"
)
PREDICTIONS = struct(f"{HOUR} timestamp_ntz, {ZONE} int, predicted_ride_count int")
MODEL_METADATA = T.StructType(
    struct("model_name string, model_type string").fields
    + [
        T.StructField("parameters", T.MapType(T.StringType(), T.StringType())),
        T.StructField("feature_columns", T.ArrayType(T.StringType())),
    ]
    + struct("target_column string, training_timestamp string").fields
    + [
        T.StructField(
            "metrics",
            struct(
                "train_mae double, train_mse double, train_rmse double, "
                "test_mae double, test_mse double, test_rmse double"
            ),
        ),
        T.StructField(
            "cross_validation", struct("cv_folds int, cv_mae_mean double, cv_mae_std double")
        ),
    ]
    + struct("training_data_size bigint, feature_count int").fields
)
REGISTRY = struct(
    "name string, version int, run_id string, source string, creation_timestamp bigint, status string"
)
RUN_LOG = struct(
    "run_id string, parent_run_id string, kind string, key string, value string, logged_at bigint"
)

DATASET_FEATURES = (
    ["hour_of_day", "day_of_week", "day_of_month", "is_weekend", "is_holiday", "is_rush_hour"]
    + WEATHER_COLUMNS
    + ["is_downtown"]
    + [lag_name(k) for k in DATASET_LAGS]
    + [rolling_name(h) for h in ROLLING_HOURS]
)
STORE_FEATURES = (
    ["hour_of_day", "day_of_week", "day_of_month", "is_weekend", "is_holiday", "is_rush_hour"]
    + WEATHER_COLUMNS
    + ["is_downtown"]
    + [lag_name(k) for k in STORE_LAGS]
    + [rolling_name(h) for h in ROLLING_HOURS]
)


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Exactly the contract's columns, order and types; a missing column is an error."""
    missing = [f.name for f in contract.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the contract: {missing}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in contract.fields])


def downcast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
