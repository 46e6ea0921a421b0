"""Views over the given tables that play the roles of trips, zones and observations.

They are defined once more, independently, in ``oracle_views`` as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.scalars import json_number
from tidecast.names import COUNT, HOUR, TARGET, ZONE, lag_name
from tidecast.plans.analysis import error_table
from tidecast.plans.features import featured, hourly_series, series_dataset
from tidecast.plans.weather import weather_by_hour
from tidecast.sources.storage import materialise

DOWNTOWN = [2, 7]
BUSY = [0, 3, 8, 11, 17]
HOME = "ASIA"
CLOUD_WORDS = ["no clouds", "20–30%.", "50%.", "70 – 80%.", "100%.", "haze"]
TRIP_ROLES = {
    "pickup": "pickup_ts",
    "dropoff": "dropoff_ts",
    "pickup_zone": "pu_zone",
    "dropoff_zone": "do_zone",
    "vendor": "vendor_id",
    "rate": "rate_code",
    "payment": "payment_type",
    "passengers": "passenger_count",
    "distance": "trip_distance",
    "fare": "fare_amount",
    "total": "total_amount",
    "tip": "tip_amount",
    "tolls": "tolls_amount",
    "surcharge": "congestion_surcharge",
}


# declared schemas: opening a table needs no schema-inference job
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,
        props string""",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf}/{name}.parquet")


def zones(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("n_name").alias("Zone"),
        F.col("r_name").alias("Borough"),
    )


def home_zones(spark, sf) -> DataFrame:
    return zones(spark, sf).where(F.col("Borough") == HOME)


def pickups(spark: SparkSession, sf: str) -> DataFrame:
    """Events as pickups: sub-hour timestamps in 25 zones."""
    e = table(spark, sf, "events")
    return e.select(
        "event_id",
        F.col("ts").alias("pickup_ts"),
        (F.col("user_id") % 25).cast("int").alias(ZONE),
        F.col("value").alias("amount"),
        F.col("event_type").alias("vendor"),
        "props",
    )


def _trip_values() -> list[Column]:
    """What an order line alone gives of a trip; every 5th to 19th part lacks a measure."""

    def gap(n, value):
        return F.when(F.col("l_partkey") % n != 0, value)

    return [
        (1 + F.col("l_suppkey") % 3).cast("int").alias("vendor_id"),
        F.col("l_linenumber").alias("rate_code"),
        (1 + F.col("l_partkey") % 7).cast("int").alias("payment_type"),
        gap(11, F.col("l_quantity") % 9).alias("passenger_count"),
        gap(13, F.col("l_quantity") * 2.5).alias("trip_distance"),
        gap(17, F.col("l_extendedprice") / 100).alias("fare_amount"),
        (F.col("l_discount") * 100 - 1).alias("tip_amount"),
        (F.col("l_tax") * 100 - 1).alias("tolls_amount"),
        gap(19, F.col("l_extendedprice") / 100 + F.col("l_discount") * 100).alias("total_amount"),
        gap(5, F.lit(2.5)).alias("congestion_surcharge"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
    ]


def _supplied_lines(spark: SparkSession, sf: str, lines: int | None = None) -> DataFrame:
    li, s = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    li = li if lines is None else li.limit(lines)
    return li.join(s, F.col("l_suppkey") == F.col("s_suppkey"))


def _placed_orders(spark: SparkSession, sf: str) -> DataFrame:
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    placed = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    return placed.select("o_orderkey", F.col("o_orderdate").alias("pickup_ts"), F.col("c_nationkey").alias("pu_zone"))


def trips(spark: SparkSession, sf: str, lines: int | None = None) -> DataFrame:
    """Order lines as trips between customer and supplier zones, with missing measures; all, or those of a few ``lines``.

    Orders find their customer and lines their supplier before the two meet, so that lines, the largest table, are
    dealt by one key only, however large the dimensions are.
    """
    joined = _supplied_lines(spark, sf, lines).join(_placed_orders(spark, sf), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "pickup_ts",
        F.col("l_shipdate").alias("dropoff_ts"),
        "pu_zone",
        F.col("s_nationkey").alias("do_zone"),
        *_trip_values(),
    )


def trip_lines(spark: SparkSession, sf: str) -> DataFrame:
    """:func:`trips` before they know their pick-up."""
    return _supplied_lines(spark, sf).select(
        "l_orderkey", F.col("l_shipdate").alias("dropoff_ts"), F.col("s_nationkey").alias("do_zone"), *_trip_values()
    )


def with_pickup(spark: SparkSession, sf: str, lines: DataFrame) -> DataFrame:
    return lines.join(_placed_orders(spark, sf), F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """Events as weather observations: irregular, with missing values and free text."""
    e = table(spark, sf, "events")
    k = json_number("props", "$.k").cast("int")
    words = F.array(*[F.lit(w) for w in CLOUD_WORDS])
    return e.select(
        "event_id",
        F.col("ts").alias("observed_at"),
        F.when(F.col("event_type") != "signup", F.col("value")).alias("temperature"),
        F.when(F.col("event_type") != "click", k.cast("double")).alias("humidity"),
        (F.col("value") / 10).alias("wind_speed"),
        F.element_at(words, k % 6 + 1).alias("cloud_cover"),
        F.when(F.col("event_type") == "error", F.lit("Trace of precipitation"))
        .when(F.col("event_type") == "view", (k / 4).cast("string"))
        .when(F.col("event_type") == "click", F.lit("none"))
        .alias("amount_of_precipitation"),
    )


def weather(spark, sf, zero_head: bool = False) -> DataFrame:
    return weather_by_hour(
        observations(spark, sf), "observed_at", ["observed_at", "event_id"], zero_head
    )


def series(spark, sf) -> DataFrame:
    return hourly_series(pickups(spark, sf), "pickup_ts", zones(spark, sf))


def featured_series(spark, sf) -> DataFrame:
    return featured(series(spark, sf), weather(spark, sf), None, DOWNTOWN)


def dataset(spark, sf) -> DataFrame:
    return series_dataset(featured_series(spark, sf))


def scored(spark, sf) -> DataFrame:
    """Dataset scored with the persistence forecast."""
    return dataset(spark, sf).withColumn("prediction", F.col(lag_name(1)))


def errors(spark, sf) -> DataFrame:
    return error_table(scored(spark, sf), TARGET, "prediction")


def small_series(spark, sf) -> DataFrame:
    """Series whose empty hours are unknown instead of zero (input of the fill operators)."""
    return series(spark, sf).withColumn("seen", F.when(F.col(COUNT) > 0, F.col(COUNT).cast("double"))).select(
        HOUR, ZONE, "seen"
    )


# Stage hand-over: a report that reads its input more than once works on the written
# stage output instead of repeating the stages from the raw events.
def stored_series(spark, sf) -> DataFrame:
    return materialise(series(spark, sf), "series")


def stored_seen(spark, sf) -> DataFrame:
    return materialise(small_series(spark, sf), "seen")


def stored_dataset(spark, sf) -> DataFrame:
    return materialise(dataset(spark, sf), "dataset")


def stored_errors(spark, sf) -> DataFrame:
    return materialise(errors(spark, sf), "errors")
