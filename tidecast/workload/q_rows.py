"""Projections, filters, quality rules and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecast.functions import scalars as S
from tidecast.functions import timeutil as t
from tidecast.names import HOUR, ZONE
from tidecast.operators import quality as q
from tidecast.operators.aggregates import one_hot
from tidecast.operators.grid import hour_span, hour_spine
from tidecast.operators.joins import keys_in
from tidecast.plans.features import interact
from tidecast.plans.ingest import clean_trips, cleaning_funnel
from tidecast.sources.contracts import downcast
from tidecast.workload import views as v
from tidecast.workload.oracle_views import holiday, nearest_hour
from tidecast.workload.registry import query


def ntz(text: str):
    return F.expr(f"timestamp_ntz'{text}'")


# -- projections --------------------------------------------------------------
@query(
    "prj_select_drop_rename",
    "SELECT event_id, pickup_ts AS started_at, PULocationID AS zone_id, amount FROM pickups",
)
def prj_select_drop_rename(spark, sf):
    p = v.pickups(spark, sf).drop("props", "vendor")
    return p.withColumnsRenamed({"pickup_ts": "started_at", ZONE: "zone_id"})


@query(
    "prj_drop_all_null",
    "SELECT event_id, pickup_ts, amount FROM pickups",
)
def prj_drop_all_null(spark, sf):
    p = v.pickups(spark, sf).select("event_id", "pickup_ts", "amount")
    return q.drop_all_null(p.withColumn("airport_fee", F.lit(None).cast("double")))


@query(
    "prj_downcast",
    """SELECT CAST(l_partkey AS INTEGER) AS l_partkey, CAST(l_quantity AS FLOAT) AS l_quantity,
              CAST(l_suppkey AS INTEGER) AS l_suppkey FROM lineitem""",
)
def prj_downcast(spark, sf):
    li = v.table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_suppkey")
    return downcast(li, {"l_partkey": "int", "l_quantity": "float", "l_suppkey": "int"})


@query(
    "prj_cast_keys_string",
    """SELECT CAST(pu_zone AS VARCHAR) AS pu_zone, CAST(do_zone AS VARCHAR) AS do_zone,
              CAST(payment_type AS VARCHAR) AS payment_type, count(*) AS n
       FROM trips GROUP BY ALL""",
)
def prj_cast_keys_string(spark, sf):
    names = ["pu_zone", "do_zone", "payment_type"]
    return downcast(v.trips(spark, sf), {n: "string" for n in names}).groupBy(*names).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "prj_flag_isin",
    """SELECT event_id, CAST(PULocationID IN (2, 7) AS INTEGER) AS is_downtown,
              CAST(vendor IN ('click', 'view') AS INTEGER) AS is_busy FROM pickups""",
)
def prj_flag_isin(spark, sf):
    return v.pickups(spark, sf).select(
        "event_id",
        S.flag_in(ZONE, v.DOWNTOWN).alias("is_downtown"),
        S.flag_in("vendor", ["click", "view"]).alias("is_busy"),
    )


@query(
    "prj_flag_compound",
    """SELECT event_id,
              CAST(hour(pickup_ts) IN (7,8,9,16,17,18,19) AND isodow(pickup_ts) <= 5 AS INTEGER) AS is_rush_hour,
              CAST(hour(pickup_ts) IN (16,17,18,19) AND isodow(pickup_ts) <= 5 AS INTEGER) AS is_evening_rush,
              CAST(PULocationID IN (0,3,8,11,17) AND hour(pickup_ts) >= 18 AND isodow(pickup_ts) > 5 AS INTEGER) AS has_event
       FROM pickups""",
)
def prj_flag_compound(spark, sf):
    from tidecast.functions.fixed_values import EVENING_RUSH_HOURS, EVENT_HOURS

    hour, weekend = F.hour("pickup_ts"), t.weekend_flag("pickup_ts") == 1
    return v.pickups(spark, sf).select(
        "event_id",
        t.rush_hour_flag("pickup_ts").alias("is_rush_hour"),
        S.flag(hour.isin(EVENING_RUSH_HOURS) & ~weekend).alias("is_evening_rush"),
        S.flag(F.col(ZONE).isin(v.BUSY) & hour.isin(EVENT_HOURS) & weekend).alias("has_event"),
    )


@query(
    "prj_flag_threshold",
    "SELECT event_id, CAST(amount_of_precipitation > 0 AS INTEGER) AS is_raining FROM obs_clean",
)
def prj_flag_threshold(spark, sf):
    from tidecast.plans.weather import clean_observations

    o = clean_observations(v.observations(spark, sf))
    return o.select("event_id", S.flag_above("amount_of_precipitation").alias("is_raining"))


@query(
    "prj_interactions",
    """SELECT hourly_timestamp, PULocationID, is_weekend * hour_of_day AS is_weekend_hour,
              is_rush_hour * is_downtown AS is_rush_hour_downtown FROM featured""",
)
def prj_interactions(spark, sf):
    out = interact(
        v.featured_series(spark, sf),
        {
            "is_weekend_hour": ("is_weekend", "hour_of_day"),
            "is_rush_hour_downtown": ("is_rush_hour", "is_downtown"),
        },
    )
    return out.select(HOUR, ZONE, "is_weekend_hour", "is_rush_hour_downtown")


@query(
    "prj_map_default",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2
              WHEN '3-MEDIUM' THEN 3 ELSE 9 END AS priority FROM orders""",
)
def prj_map_default(spark, sf):
    table = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}
    return v.table(spark, sf, "orders").select(
        "o_orderkey", S.recode("o_orderpriority", table, 9).alias("priority")
    )


@query(
    "prj_replace_try_cast",
    "SELECT event_id, amount_of_precipitation FROM obs_clean",
)
def prj_replace_try_cast(spark, sf):
    words = {"Trace of precipitation": 0.1}
    return v.observations(spark, sf).select(
        "event_id",
        S.clean_numeric("amount_of_precipitation", words, 0.0).alias("amount_of_precipitation"),
    )


@query(
    "prj_bucket_label",
    """SELECT o_orderkey, CASE WHEN o_totalprice <= 150000 THEN 'low' ELSE 'high' END AS earning_class,
              CASE WHEN o_totalprice <= 150000 THEN 0 ELSE 1 END AS earning_class_binary FROM orders""",
)
def prj_bucket_label(spark, sf):
    label = S.bucket_label("o_totalprice", 150_000)
    return v.table(spark, sf, "orders").select(
        "o_orderkey",
        label.alias("earning_class"),
        S.flag(label == "high").alias("earning_class_binary"),
    )


@query(
    "prj_error_columns",
    """SELECT hourly_timestamp, PULocationID, absolute_error, predicted - actual AS error FROM errors""",
)
def prj_error_columns(spark, sf):
    return v.errors(spark, sf).select(
        HOUR,
        ZONE,
        S.absolute_error("actual", "predicted").alias("absolute_error"),
        S.signed_error("actual", "predicted").alias("error"),
    )


@query(
    "prj_round_half_even",
    "SELECT l_orderkey, l_linenumber, CAST(round_even(l_quantity / 2, 0) AS INTEGER) AS half_quantity FROM lineitem",
)
def prj_round_half_even(spark, sf):
    return v.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", S.round_half_even(F.col("l_quantity") / 2).alias("half_quantity")
    )


@query(
    "prj_one_hot",
    """SELECT o_orderkey, o_totalprice, CAST(o_orderstatus = 'F' AS INTEGER) AS "o_orderstatus_F",
              CAST(o_orderstatus = 'O' AS INTEGER) AS "o_orderstatus_O",
              CAST(o_orderstatus = 'P' AS INTEGER) AS "o_orderstatus_P" FROM orders""",
)
def prj_one_hot(spark, sf):
    o = v.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return one_hot(o, "o_orderstatus", ["F", "O", "P"])


@query(
    "prj_const_columns",
    """SELECT LocationID AS PULocationID, (SELECT hi + INTERVAL 1 HOUR FROM span) AS hourly_timestamp FROM zones""",
)
def prj_const_columns(spark, sf):
    _, newest = hour_span(v.pickups(spark, sf), "pickup_ts")
    return v.zones(spark, sf).select(
        F.col("LocationID").alias(ZONE), t.plus_hours(newest, 1).alias(HOUR)
    )


# -- filters ------------------------------------------------------------------
@query(
    "flt_time_range",
    """SELECT event_id, pickup_ts FROM pickups
       WHERE pickup_ts >= TIMESTAMP '2024-01-05' AND pickup_ts <= TIMESTAMP '2024-01-20 12:00:00'""",
)
def flt_time_range(spark, sf):
    return v.pickups(spark, sf).where(
        q.between_ts("pickup_ts", ntz("2024-01-05 00:00:00"), ntz("2024-01-20 12:00:00"), "both")
    ).select("event_id", "pickup_ts")


@query(
    "flt_lookback",
    """SELECT event_id, pickup_ts FROM pickups
       WHERE pickup_ts >= (SELECT max(ts) FROM events) - INTERVAL 168 HOUR""",
)
def flt_lookback(spark, sf):
    p = v.pickups(spark, sf)
    newest = p.agg(F.max("pickup_ts")).scalar()
    return p.where(q.lookback("pickup_ts", newest, 168)).select("event_id", "pickup_ts")


@query(
    "flt_calendar_parts",
    """SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 3""",
)
def flt_calendar_parts(spark, sf):
    return v.table(spark, sf, "orders").where(
        (F.year("o_orderdate") == 1997) & (F.month("o_orderdate") == 3)
    ).select("o_orderkey", "o_orderdate")


@query(
    "flt_either_zone",
    """SELECT l_orderkey, l_linenumber, l_partkey, pu_zone, do_zone FROM trips
       WHERE pu_zone IN (SELECT LocationID FROM zones WHERE Borough = 'ASIA')
          OR do_zone IN (SELECT LocationID FROM zones WHERE Borough = 'ASIA')""",
)
def flt_either_zone(spark, sf):
    kept = q.either_in(v.trips(spark, sf), ["pu_zone", "do_zone"], v.home_zones(spark, sf), "LocationID")
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "pu_zone", "do_zone")


@query("flt_dimension_attr", "SELECT LocationID, Zone FROM zones WHERE Borough = 'ASIA'")
def flt_dimension_attr(spark, sf):
    return v.home_zones(spark, sf).select("LocationID", "Zone")


@query(
    "flt_order_consistency",
    "SELECT l_orderkey, l_linenumber, pickup_ts, dropoff_ts FROM trips WHERE dropoff_ts >= pickup_ts",
)
def flt_order_consistency(spark, sf):
    return v.trips(spark, sf).where("dropoff_ts >= pickup_ts").select(
        "l_orderkey", "l_linenumber", "pickup_ts", "dropoff_ts"
    )


@query(
    "flt_drop_null_subset",
    """SELECT l_orderkey, l_linenumber, passenger_count, trip_distance FROM trips
       WHERE passenger_count IS NOT NULL AND trip_distance IS NOT NULL""",
)
def flt_drop_null_subset(spark, sf):
    return v.trips(spark, sf).na.drop(subset=["passenger_count", "trip_distance"]).select(
        "l_orderkey", "l_linenumber", "passenger_count", "trip_distance"
    )


@query(
    "flt_domain",
    """SELECT l_orderkey, l_linenumber, vendor_id, rate_code, payment_type FROM trips
       WHERE vendor_id IN (1, 2) AND rate_code BETWEEN 1 AND 6 AND payment_type BETWEEN 1 AND 6""",
)
def flt_domain(spark, sf):
    from tidecast.plans.ingest import value_rules

    names = ("vendor", "rate", "payment")
    rules = [r for r in value_rules(v.TRIP_ROLES) if r[0] in names]
    return q.apply_rules(v.trips(spark, sf), rules).select(
        "l_orderkey", "l_linenumber", "vendor_id", "rate_code", "payment_type"
    )


@query(
    "flt_outlier_range",
    """SELECT l_orderkey, l_linenumber, trip_distance, fare_amount, total_amount, tip_amount FROM trips
       WHERE trip_distance BETWEEN 0 AND 100 AND fare_amount BETWEEN 0 AND 1000
         AND total_amount >= 0 AND total_amount < 200 AND tip_amount >= 0""",
)
def flt_outlier_range(spark, sf):
    from tidecast.plans.ingest import value_rules

    rules = [r for r in value_rules(v.TRIP_ROLES) if r[0] in ("distance", "fare", "tip")]
    rules.append(("total_open", (F.col("total_amount") >= 0) & (F.col("total_amount") < 200)))
    return q.apply_rules(v.trips(spark, sf), rules).select(
        "l_orderkey", "l_linenumber", "trip_distance", "fare_amount", "total_amount", "tip_amount"
    )


@query(
    "flt_point_in_time",
    "SELECT * FROM series WHERE hourly_timestamp = TIMESTAMP '2024-01-15 08:00:00'",
)
def flt_point_in_time(spark, sf):
    return v.series(spark, sf).where(F.col(HOUR) == ntz("2024-01-15 08:00:00"))


@query(
    "flt_key_selection",
    """SELECT event_id, PULocationID FROM pickups
       WHERE PULocationID IN (SELECT LocationID FROM zones WHERE Borough = 'EUROPE')""",
)
def flt_key_selection(spark, sf):
    chosen = v.zones(spark, sf).where("Borough = 'EUROPE'")
    return keys_in(v.pickups(spark, sf), chosen, ZONE, "LocationID").select("event_id", ZONE)


# -- quality ------------------------------------------------------------------
TRIP_START, TRIP_END = "1996-01-01 00:00:00", "1999-12-31 23:59:59"

BASIS_SQL = f"""
  SELECT * FROM trips
  WHERE pickup_ts >= TIMESTAMP '{TRIP_START}' AND pickup_ts <= TIMESTAMP '{TRIP_END}'
    AND (pu_zone IN (SELECT LocationID FROM zones WHERE Borough = 'ASIA')
         OR do_zone IN (SELECT LocationID FROM zones WHERE Borough = 'ASIA'))
    AND dropoff_ts >= pickup_ts"""
FILLED_SQL = """
  SELECT * REPLACE (
    coalesce(passenger_count, (SELECT median(passenger_count) FROM basis)) AS passenger_count,
    coalesce(trip_distance, (SELECT median(trip_distance) FROM basis)) AS trip_distance,
    coalesce(fare_amount, (SELECT median(fare_amount) FROM basis)) AS fare_amount,
    coalesce(total_amount, (SELECT median(total_amount) FROM basis)) AS total_amount,
    coalesce(congestion_surcharge, 0) AS congestion_surcharge)
  FROM """
STEPS = [
    ("time_range", f"pickup_ts >= TIMESTAMP '{TRIP_START}' AND pickup_ts <= TIMESTAMP '{TRIP_END}'"),
    (
        "either_zone",
        "(pu_zone IN (SELECT LocationID FROM zones WHERE Borough = 'ASIA') "
        "OR do_zone IN (SELECT LocationID FROM zones WHERE Borough = 'ASIA'))",
    ),
    ("time_order", "dropoff_ts >= pickup_ts"),
    ("critical_present", "pickup_ts IS NOT NULL AND pu_zone IS NOT NULL AND do_zone IS NOT NULL"),
    ("vendor", "vendor_id IN (1, 2)"),
    ("rate", "rate_code BETWEEN 1 AND 6"),
    ("payment", "payment_type BETWEEN 1 AND 6"),
    ("distance", "trip_distance BETWEEN 0 AND 100"),
    ("passengers", "passenger_count BETWEEN 0 AND 6"),
    ("fare", "fare_amount BETWEEN 0 AND 1000"),
    ("total", "total_amount BETWEEN 0 AND 1000"),
    ("tip", "tip_amount >= 0"),
    ("tolls", "tolls_amount >= 0"),
]


def _funnel_sql() -> str:
    parts = ["SELECT 0 AS step, 'input' AS rule, count(*) AS rows FROM filled"]
    for i, (name, _) in enumerate(STEPS, 1):
        where = " AND ".join(f"({s})" for _, s in STEPS[:i])
        parts.append(f"SELECT {i}, '{name}', count(*) FROM filled WHERE {where}")
    return (
        f"WITH basis AS ({BASIS_SQL}), filled AS ({FILLED_SQL} trips), steps AS ("
        + " UNION ALL ".join(parts)
        + ") SELECT step, rule, rows, round(rows * 100.0 / (SELECT count(*) FROM trips), 4)::DOUBLE AS retention_pct FROM steps"
    )


@query("dq_funnel", _funnel_sql())
def dq_funnel(spark, sf):
    return cleaning_funnel(
        v.trip_lines(spark, sf), v.home_zones(spark, sf), "LocationID", ntz(TRIP_START), ntz(TRIP_END), v.TRIP_ROLES,
        complete=lambda lines: v.with_pickup(spark, sf, lines),
    )


@query(
    "dq_clean_trips",
    f"WITH basis AS ({BASIS_SQL}), filled AS ({FILLED_SQL} basis) "
    "SELECT * REPLACE (CAST(passenger_count AS FLOAT) AS passenger_count, CAST(trip_distance AS FLOAT) AS trip_distance) "
    "FROM filled WHERE " + " AND ".join(s for _, s in STEPS[4:]),
)
def dq_clean_trips(spark, sf):
    trips = v.trips(spark, sf).withColumn("airport_fee", F.lit(None).cast("double"))
    return clean_trips(
        trips, v.home_zones(spark, sf), "LocationID", ntz(TRIP_START), ntz(TRIP_END), v.TRIP_ROLES,
        drop_empty=True, narrow={"passenger_count": "float", "trip_distance": "float"}, few=v.trips(spark, sf, 1000),
    )


NULLABLE = ["passenger_count", "trip_distance", "fare_amount", "total_amount", "congestion_surcharge", "pu_zone"]


def _per_column(template: str) -> str:
    return " UNION ALL ".join(template.replace("{c}", c) for c in NULLABLE)


@query(
    "dq_null_rates",
    _per_column("SELECT '{c}' AS \"column\", round(count(*) FILTER ({c} IS NULL) * 100.0 / count(*), 4)::DOUBLE AS null_pct FROM trips"),
)
def dq_null_rates(spark, sf):
    return q.null_profile(v.trips(spark, sf), NULLABLE).select("column", "null_pct")


@query(
    "dq_null_counts",
    _per_column("SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_null FROM trips"),
)
def dq_null_counts(spark, sf):
    return q.null_profile(v.trips(spark, sf), NULLABLE).select("column", "n_null")


@query(
    "dq_schema_profile",
    """SELECT 'event_id' AS "column", 'bigint' AS data_type, count(*) AS n_rows, count(*) FILTER (event_id IS NULL) AS n_null FROM events
       UNION ALL SELECT 'ts', 'timestamp_ntz', count(*), count(*) FILTER (ts IS NULL) FROM events
       UNION ALL SELECT 'user_id', 'bigint', count(*), count(*) FILTER (user_id IS NULL) FROM events
       UNION ALL SELECT 'event_type', 'string', count(*), count(*) FILTER (event_type IS NULL) FROM events
       UNION ALL SELECT 'value', 'double', count(*), count(*) FILTER (value IS NULL) FROM events
       UNION ALL SELECT 'props', 'string', count(*), count(*) FILTER (props IS NULL) FROM events""",
)
def dq_schema_profile(spark, sf):
    return q.null_profile(v.table(spark, sf, "events")).select("column", "data_type", "n_rows", "n_null")


@query(
    "dq_impute_median",
    """SELECT l_orderkey, l_linenumber,
              coalesce(passenger_count, (SELECT median(passenger_count) FROM trips)) AS passenger_count,
              coalesce(fare_amount, (SELECT median(fare_amount) FROM trips)) AS fare_amount FROM trips""",
)
def dq_impute_median(spark, sf):
    return q.impute_median(v.trips(spark, sf), ["passenger_count", "fare_amount"]).select(
        "l_orderkey", "l_linenumber", "passenger_count", "fare_amount"
    )


@query(
    "dq_impute_constant",
    """SELECT l_orderkey, l_linenumber, coalesce(congestion_surcharge, 0) AS congestion_surcharge,
              coalesce(passenger_count, 1) AS passenger_count FROM trips""",
)
def dq_impute_constant(spark, sf):
    return v.trips(spark, sf).na.fill({"congestion_surcharge": 0.0, "passenger_count": 1.0}).select(
        "l_orderkey", "l_linenumber", "congestion_surcharge", "passenger_count"
    )


@query(
    "dq_impute_from_column",
    """SELECT l_orderkey, l_linenumber, coalesce(total_amount, fare_amount) AS total_amount FROM trips""",
)
def dq_impute_from_column(spark, sf):
    return v.trips(spark, sf).select(
        "l_orderkey", "l_linenumber", F.coalesce("total_amount", "fare_amount").alias("total_amount")
    )


@query(
    "dq_assert",
    """SELECT 'fare_present' AS rule, count(*) FILTER (fare_amount IS NULL) AS n_violations FROM trips
       UNION ALL SELECT 'ordered', count(*) FILTER (NOT dropoff_ts >= pickup_ts) FROM trips
       UNION ALL SELECT 'zone_known', count(*) FILTER (pu_zone IS NULL) FROM trips""",
)
def dq_assert(spark, sf):
    rules = [
        ("fare_present", F.col("fare_amount").isNotNull()),
        ("ordered", F.col("dropoff_ts") >= F.col("pickup_ts")),
        ("zone_known", F.col("pu_zone").isNotNull()),
    ]
    return q.violations(v.trips(spark, sf), rules)


@query(
    "dq_coverage",
    """SELECT min(ts) AS first_seen, max(ts) AS last_seen,
              CAST(min(ts) <= TIMESTAMP '2024-01-01 01:00:00' AND max(ts) >= TIMESTAMP '2024-01-31 23:00:00' AS INTEGER) AS covers
       FROM events""",
)
def dq_coverage(spark, sf):
    return q.coverage(
        v.table(spark, sf, "events"), "ts", ntz("2024-01-01 01:00:00"), ntz("2024-01-31 23:00:00")
    )


# -- scalar functions ---------------------------------------------------------
@query(
    "fn_round_hour",
    f"""SELECT event_id, {nearest_hour('ts')} AS nearest, date_trunc('hour', ts)::TIMESTAMP AS floored FROM events""",
)
def fn_round_hour(spark, sf):
    return v.table(spark, sf, "events").select(
        "event_id", t.hour_bucket("ts").alias("nearest"), t.hour_bucket("ts", "floor").alias("floored")
    )


@query(
    "fn_calendar_parts",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
              CAST(day(ts) AS INTEGER) AS day_of_month FROM events""",
)
def fn_calendar_parts(spark, sf):
    c = t.calendar_features("ts")
    names = ["hour_of_day", "day_of_week", "day_of_month"]
    return v.table(spark, sf, "events").select("event_id", *[c[n].alias(n) for n in names])


@query(
    "fn_date_parts",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS transaction_date, CAST(year(o_orderdate) AS INTEGER) AS transaction_year,
              CAST(month(o_orderdate) AS INTEGER) AS transaction_month, CAST(day(o_orderdate) AS INTEGER) AS transaction_day,
              CAST(hour(o_orderdate) AS INTEGER) AS transaction_hour FROM orders""",
)
def fn_date_parts(spark, sf):
    return v.table(spark, sf, "orders").select(
        "o_orderkey", *[c.alias(n) for n, c in t.date_parts("o_orderdate").items()]
    )


@query(
    "fn_weekend_flag",
    "SELECT o_orderkey, CAST(isodow(o_orderdate) IN (6, 7) AS INTEGER) AS is_weekend FROM orders",
)
def fn_weekend_flag(spark, sf):
    return v.table(spark, sf, "orders").select("o_orderkey", t.weekend_flag("o_orderdate").alias("is_weekend"))


@query(
    "fn_holiday_calendar",
    f"""SELECT CAST(d AS DATE) AS holiday, CAST({holiday('d')} AS INTEGER) AS observed FROM (
          SELECT unnest(generate_series((SELECT min(o_orderdate)::DATE FROM orders)::TIMESTAMP,
                                        (SELECT max(o_orderdate)::DATE FROM orders)::TIMESTAMP, INTERVAL 1 DAY)) AS d)
        WHERE {holiday('d', actual=True)}""",
)
def fn_holiday_calendar(spark, sf):
    both = t.us_holidays(v.table(spark, sf, "orders"), "o_orderdate", "o_orderdate", include_actual=True)
    return both.withColumn("observed", t.is_us_holiday("holiday").cast("int"))


@query("fn_parse_ts", "SELECT event_id, date_trunc('minute', ts)::TIMESTAMP AS parsed FROM events")
def fn_parse_ts(spark, sf):
    text = F.date_format("ts", "dd.MM.yyyy HH:mm")
    return v.table(spark, sf, "events").select(
        "event_id", t.parse_timestamp(text, "dd.MM.yyyy HH:mm").alias("parsed")
    )


@query("fn_ts_cast", "SELECT event_id, CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS ts FROM events")
def fn_ts_cast(spark, sf):
    e = v.table(spark, sf, "events").select("event_id", F.col("ts").cast("string").alias("ts"))
    return e.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "fn_interval_arith",
    """SELECT o_orderkey, o_orderdate + INTERVAL 36 HOUR AS plus_36h, o_orderdate - INTERVAL 7 DAY AS minus_week,
              CAST(last_day(o_orderdate) AS TIMESTAMP) + INTERVAL 23 HOUR AS month_close,
              date_diff('second', TIMESTAMP '1995-01-01 00:00:00', o_orderdate) // 3600 AS hours_since
       FROM orders""",
)
def fn_interval_arith(spark, sf):
    return v.table(spark, sf, "orders").select(
        "o_orderkey",
        t.plus_hours("o_orderdate", 36).alias("plus_36h"),
        (F.col("o_orderdate") - F.expr("interval 7 days")).alias("minus_week"),
        t.month_end_hour("o_orderdate").alias("month_close"),
        t.hours_between(ntz("1995-01-01 00:00:00"), "o_orderdate").alias("hours_since"),
    )


@query("fn_format_ts", "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS token FROM events")
def fn_format_ts(spark, sf):
    return v.table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyyMMdd_HHmmss").alias("token"))


@query("fn_epoch_seconds", "SELECT event_id, epoch_us(ts) // 1000000 AS epoch_s FROM events")
def fn_epoch_seconds(spark, sf):
    return v.table(spark, sf, "events").select("event_id", t.epoch_seconds("ts").alias("epoch_s"))


@query("fn_hour_spine", "SELECT hourly_timestamp FROM spine")
def fn_hour_spine(spark, sf):
    return hour_spine(v.table(spark, sf, "events"), "ts")


@query(
    "fn_math",
    """SELECT l_orderkey, l_linenumber, abs(l_tax - l_discount) AS gap, round(sqrt(l_quantity), 6) AS root,
              l_quantity * l_quantity AS squared, round_even(l_quantity / 4, 0) AS rounded FROM lineitem""",
)
def fn_math(spark, sf):
    return v.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.abs(F.col("l_tax") - F.col("l_discount")).alias("gap"),
        F.round(F.sqrt("l_quantity"), 6).alias("root"),
        (F.col("l_quantity") * F.col("l_quantity")).alias("squared"),
        F.bround(F.col("l_quantity") / 4, 0).alias("rounded"),
    )


@query(
    "fn_string_lower_name",
    """SELECT o_orderkey, 'cleaned_' || lower(strftime(o_orderdate, '%B')) || '_' || strftime(o_orderdate, '%Y') AS file_name FROM orders""",
)
def fn_string_lower_name(spark, sf):
    return v.table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(
            F.lit("cleaned_"),
            F.lower(F.date_format("o_orderdate", "MMMM")),
            F.lit("_"),
            F.date_format("o_orderdate", "yyyy"),
        ).alias("file_name"),
    )


@query(
    "fn_json_path",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, CAST(-1 AS DOUBLE) AS missing FROM events""",
)
def fn_json_path(spark, sf):
    return v.table(spark, sf, "events").select(
        "event_id",
        S.json_number("props", "$.k").alias("k"),
        S.json_number("props", "$.absent", -1.0).alias("missing"),
    )
