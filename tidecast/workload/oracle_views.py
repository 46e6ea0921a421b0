"""The views of ``views.py`` as plain SQL, written independently of the Spark code."""

from __future__ import annotations


def nearest_hour(ts: str) -> str:
    """Nearest hour by integer microseconds, ties to the even hour since the epoch."""
    q = f"(epoch_us({ts}) // 3600000000)"
    r = f"(epoch_us({ts}) % 3600000000)"
    return (
        f"make_timestamp(({q} + CASE WHEN {r} > 1800000000 OR ({r} = 1800000000 AND {q} % 2 = 1) "
        "THEN 1 ELSE 0 END) * 3600000000)"
    )


def holiday(day: str, actual: bool = False) -> str:
    """Federal holiday test of a date, by month-day text and weekday rules; ``actual`` adds unmoved dates."""

    def fixed(d):
        return (
            f"(strftime({d}, '%m-%d') IN ('01-01', '07-04', '11-11', '12-25') "
            f"OR (strftime({d}, '%m-%d') = '06-19' AND year({d}) >= 2021))"
        )

    d = f"CAST({day} AS DATE)"
    before, after = f"({d} - INTERVAL 1 DAY)", f"({d} + INTERVAL 1 DAY)"
    return f"""(
      (isodow({d}) = 1 AND month({d}) = 1 AND (day({d}) - 1) // 7 = 2)
      OR (isodow({d}) = 1 AND month({d}) = 2 AND (day({d}) - 1) // 7 = 2)
      OR (isodow({d}) = 1 AND month({d}) = 5 AND month({d} + INTERVAL 7 DAY) = 6)
      OR (isodow({d}) = 1 AND month({d}) = 9 AND (day({d}) - 1) // 7 = 0)
      OR (isodow({d}) = 1 AND month({d}) = 10 AND (day({d}) - 1) // 7 = 1)
      OR (isodow({d}) = 4 AND month({d}) = 11 AND (day({d}) - 1) // 7 = 3)
      OR (isodow({d}) <= 5 AND {fixed(d)})
      OR (isodow({d}) = 5 AND {fixed(after)})
      OR (isodow({d}) = 1 AND {fixed(before)})
      {f"OR {fixed(d)}" if actual else ""}
    )"""


CALENDAR = f"""
  CAST(hour(hourly_timestamp) AS INTEGER) AS hour_of_day,
  CAST(isodow(hourly_timestamp) - 1 AS INTEGER) AS day_of_week,
  CAST(day(hourly_timestamp) AS INTEGER) AS day_of_month,
  CAST(isodow(hourly_timestamp) >= 6 AS INTEGER) AS is_weekend,
  CAST({holiday('hourly_timestamp', actual=True)} AS INTEGER) AS is_holiday,
  CAST(isodow(hourly_timestamp) < 6 AND hour(hourly_timestamp) IN (7,8,9,16,17,18,19) AS INTEGER) AS is_rush_hour
"""

LAG_SQL = ",\n".join(
    f"CAST(lag(ride_count, {k}) OVER w AS DOUBLE) AS lag_{k}_ride_count" for k in (1, 2, 3, 6, 12, 24)
)
ROLL_SQL = ",\n".join(
    f"CASE WHEN count(ride_count) OVER (PARTITION BY PULocationID ORDER BY hourly_timestamp "
    f"ROWS BETWEEN {h} PRECEDING AND 1 PRECEDING) = {h} THEN avg(ride_count) OVER (PARTITION BY PULocationID "
    f"ORDER BY hourly_timestamp ROWS BETWEEN {h} PRECEDING AND 1 PRECEDING) END AS rolling_mean_{h}h"
    for h in (3, 24)
)

CTES: dict[str, str] = {
    "zones": """
        SELECT n_nationkey AS LocationID, n_name AS Zone, r_name AS Borough
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "pickups": """
        SELECT event_id, ts AS pickup_ts, CAST(user_id % 25 AS INTEGER) AS PULocationID,
               value AS amount, event_type AS vendor, props
        FROM events""",
    "trips": """
        SELECT l_orderkey, l_linenumber, l_partkey,
               o_orderdate AS pickup_ts, l_shipdate AS dropoff_ts,
               c_nationkey AS pu_zone, s_nationkey AS do_zone,
               CAST(1 + l_suppkey % 3 AS INTEGER) AS vendor_id, l_linenumber AS rate_code,
               CAST(1 + l_partkey % 7 AS INTEGER) AS payment_type,
               CASE WHEN l_partkey % 11 <> 0 THEN l_quantity % 9 END AS passenger_count,
               CASE WHEN l_partkey % 13 <> 0 THEN l_quantity * 2.5 END AS trip_distance,
               CASE WHEN l_partkey % 17 <> 0 THEN l_extendedprice / 100 END AS fare_amount,
               l_discount * 100 - 1 AS tip_amount, l_tax * 100 - 1 AS tolls_amount,
               CASE WHEN l_partkey % 19 <> 0 THEN l_extendedprice / 100 + l_discount * 100 END AS total_amount,
               CASE WHEN l_partkey % 5 <> 0 THEN CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
               l_returnflag AS store_and_fwd_flag
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey""",
    "obs": """
        SELECT event_id, ts AS observed_at,
               CASE WHEN event_type <> 'signup' THEN value END AS temperature,
               CASE WHEN event_type <> 'click' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS humidity,
               value / 10 AS wind_speed,
               list_extract(['no clouds', '20–30%.', '50%.', '70 – 80%.', '100%.', 'haze'],
                            CAST(json_extract_string(props, '$.k') AS INTEGER) % 6 + 1) AS cloud_cover,
               CASE event_type WHEN 'error' THEN 'Trace of precipitation'
                    WHEN 'view' THEN CAST(CAST(json_extract_string(props, '$.k') AS DOUBLE) / 4 AS VARCHAR)
                    WHEN 'click' THEN 'none' END AS amount_of_precipitation
        FROM events""",
    "obs_clean": """
        SELECT event_id, observed_at, temperature, humidity, wind_speed,
               CASE cloud_cover WHEN 'no clouds' THEN 0.0::DOUBLE WHEN '20–30%.' THEN 25 WHEN '50%.' THEN 50
                    WHEN '70 – 80%.' THEN 75 WHEN '100%.' THEN 100 ELSE 75 END AS cloud_cover_numeric,
               CASE WHEN amount_of_precipitation = 'Trace of precipitation' THEN 0.1::DOUBLE
                    ELSE coalesce(TRY_CAST(amount_of_precipitation AS DOUBLE), 0) END AS amount_of_precipitation
        FROM obs""",
    "span": f"""
        SELECT min({nearest_hour('ts')}) AS lo, max({nearest_hour('ts')}) AS hi FROM events""",
    "spine": """
        SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hourly_timestamp FROM span""",
    "obs_hour": f"""
        SELECT {nearest_hour('observed_at')} AS hourly_timestamp, *
        FROM obs_clean
        QUALIFY row_number() OVER (PARTITION BY {nearest_hour('observed_at')}
                                   ORDER BY observed_at DESC, event_id DESC) = 1""",
    "weather_raw": """
        SELECT s.hourly_timestamp, o.temperature, o.humidity, o.wind_speed,
               o.cloud_cover_numeric, o.amount_of_precipitation
        FROM spine s ASOF LEFT JOIN obs_hour o ON s.hourly_timestamp >= o.hourly_timestamp""",
    "weather": """
        SELECT hourly_timestamp,
               last_value(temperature IGNORE NULLS) OVER w AS temperature,
               last_value(humidity IGNORE NULLS) OVER w AS humidity,
               last_value(wind_speed IGNORE NULLS) OVER w AS wind_speed,
               last_value(cloud_cover_numeric IGNORE NULLS) OVER w AS cloud_cover_numeric,
               coalesce(amount_of_precipitation, 0) AS amount_of_precipitation
        FROM weather_raw
        WINDOW w AS (ORDER BY hourly_timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "counts": f"""
        SELECT {nearest_hour('pickup_ts')} AS hourly_timestamp, PULocationID, count(*) AS ride_count
        FROM pickups GROUP BY ALL""",
    "grid": """
        SELECT hourly_timestamp, LocationID AS PULocationID FROM spine, zones""",
    "series": """
        SELECT g.hourly_timestamp, g.PULocationID, coalesce(c.ride_count, 0) AS ride_count
        FROM grid g LEFT JOIN counts c USING (hourly_timestamp, PULocationID)""",
    "seen_series": """
        SELECT hourly_timestamp, PULocationID,
               CASE WHEN ride_count > 0 THEN CAST(ride_count AS DOUBLE) END AS seen
        FROM series""",
    "featured": f"""
        SELECT s.*, {CALENDAR},
               w.temperature, w.humidity, w.wind_speed, w.cloud_cover_numeric,
               coalesce(w.amount_of_precipitation, 0) AS amount_of_precipitation,
               CAST(PULocationID IN (2, 7) AS INTEGER) AS is_downtown, PULocationID AS zone
        FROM series s LEFT JOIN weather w USING (hourly_timestamp)""",
    "lagged": f"""
        SELECT *, {LAG_SQL},
               {ROLL_SQL},
               CAST(lead(ride_count, 1) OVER w AS DOUBLE) AS target
        FROM featured WINDOW w AS (PARTITION BY PULocationID ORDER BY hourly_timestamp)""",
    "dataset": """
        SELECT * FROM lagged WHERE target IS NOT NULL AND lag_24_ride_count IS NOT NULL
          AND rolling_mean_24h IS NOT NULL""",
    "errors": """
        SELECT hourly_timestamp, PULocationID, zone, is_rush_hour, is_holiday, is_weekend,
               target AS actual, lag_1_ride_count AS predicted,
               abs(target - lag_1_ride_count) AS absolute_error,
               CAST(hour(hourly_timestamp) AS INTEGER) AS hour,
               CAST(isodow(hourly_timestamp) - 1 AS INTEGER) AS day_of_week
        FROM dataset""",
}
