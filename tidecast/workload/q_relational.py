"""Joins, aggregations, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecast.functions.fixed_values import WEEKLY_LAG
from tidecast.functions.timeutil import hour_bucket, plus_hours
from tidecast.names import ACTUAL, COUNT, HOUR, PREDICTED, TARGET, ZONE, lag_name
from tidecast.operators import aggregates as a
from tidecast.operators import joins as j
from tidecast.operators import windows as w
from tidecast.operators.grid import (
    asof_backward,
    densify,
    hour_span,
    hourly_counts,
    zone_hours,
)
from tidecast.operators.quantiles import approx_quantiles, describe, exact_quantiles
from tidecast.plans import analysis
from tidecast.plans.weather import clean_observations, resample_hourly
from tidecast.sources.readers import union_all
from tidecast.sources.storage import materialise
from tidecast.workload import views as v
from tidecast.workload.oracle_views import nearest_hour
from tidecast.workload.q_rows import ntz
from tidecast.workload.registry import query

KEYS = "PULocationID, hourly_timestamp"


def r6(c, name=None):
    name = name or c
    return F.round(c, 6).alias(name)


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


# -- joins --------------------------------------------------------------------
@query("join_grid_left", "SELECT hourly_timestamp, PULocationID, ride_count FROM series")
def join_grid_left(spark, sf):
    p = v.pickups(spark, sf)
    keys = v.zones(spark, sf).select(F.col("LocationID").alias(ZONE))
    grid = zone_hours(keys, *hour_span(p, "pickup_ts"))
    return densify(hourly_counts(p, "pickup_ts"), grid)


@query(
    "join_features_left",
    """SELECT s.hourly_timestamp, s.PULocationID, s.ride_count, f.total_amount
       FROM series s LEFT JOIN (
         SELECT """ + nearest_hour("pickup_ts") + """ AS hourly_timestamp, PULocationID, round(sum(amount), 4) AS total_amount
         FROM pickups GROUP BY ALL) f USING (hourly_timestamp, PULocationID)""",
)
def join_features_left(spark, sf):
    sums = v.pickups(spark, sf).groupBy(hour_bucket("pickup_ts").alias(HOUR), ZONE).agg(
        F.round(F.sum("amount"), 4).alias("total_amount")
    )
    return v.series(spark, sf).join(sums, [HOUR, ZONE], "left")


@query(
    "join_zone_lookup",
    """SELECT event_id, PULocationID, Zone AS zone_name, Borough AS borough
       FROM pickups LEFT JOIN zones ON PULocationID = LocationID""",
)
def join_zone_lookup(spark, sf):
    names = {"Zone": "zone_name", "Borough": "borough"}
    out = j.lookup(v.pickups(spark, sf), v.zones(spark, sf), ZONE, "LocationID", names)
    return out.select("event_id", ZONE, "zone_name", "borough")


@query(
    "join_weather_hour",
    """SELECT hourly_timestamp, PULocationID, temperature, humidity, wind_speed, cloud_cover_numeric,
              amount_of_precipitation FROM featured""",
)
def join_weather_hour(spark, sf):
    from tidecast.plans.features import add_weather

    return add_weather(v.series(spark, sf), v.weather(spark, sf)).drop(COUNT)


@query(
    "join_calendar_parts",
    """SELECT p.event_id, w.temperature, w.humidity FROM pickups p LEFT JOIN weather w
       ON month(p.pickup_ts) = month(w.hourly_timestamp) AND day(p.pickup_ts) = day(w.hourly_timestamp)
          AND hour(p.pickup_ts) = hour(w.hourly_timestamp)""",
)
def join_calendar_parts(spark, sf):
    hourly = v.weather(spark, sf).select(HOUR, "temperature", "humidity")
    return j.on_calendar_parts(
        v.pickups(spark, sf).select("event_id", "pickup_ts"), hourly, "pickup_ts", HOUR
    ).drop("pickup_ts")


@query("join_cross_grid", "SELECT hourly_timestamp, PULocationID FROM grid")
def join_cross_grid(spark, sf):
    keys = v.zones(spark, sf).select(F.col("LocationID").alias(ZONE))
    return zone_hours(keys, *hour_span(v.pickups(spark, sf), "pickup_ts"))


@query(
    "join_asof_backward",
    """SELECT g.hourly_timestamp, g.PULocationID, coalesce(p.event_id, -1) AS event_id, p.amount, p.vendor
       FROM grid g ASOF LEFT JOIN (
         SELECT * FROM pickups
         QUALIFY row_number() OVER (PARTITION BY PULocationID, pickup_ts ORDER BY event_id DESC) = 1) p
       ON g.PULocationID = p.PULocationID AND g.hourly_timestamp >= p.pickup_ts""",
)
def join_asof_backward(spark, sf):
    p = v.pickups(spark, sf)
    keys = v.zones(spark, sf).select(F.col("LocationID").alias(ZONE))
    grid = zone_hours(keys, *hour_span(p, "pickup_ts"))
    return asof_backward(
        grid, p, [ZONE], HOUR, "pickup_ts", ["event_id", "amount", "vendor"], tie_break=["event_id"], left_grain="hour"
    ).na.fill({"event_id": -1})


@query(
    "join_lag_lookup",
    """WITH t AS (SELECT max(hourly_timestamp) + INTERVAL 1 HOUR AS t_next FROM series)
       SELECT PULocationID,
              coalesce(max(CASE WHEN hourly_timestamp = t_next - INTERVAL 1 HOUR THEN ride_count END), 0)::DOUBLE AS lag_1_ride_count,
              coalesce(max(CASE WHEN hourly_timestamp = t_next - INTERVAL 2 HOUR THEN ride_count END), 0)::DOUBLE AS lag_2_ride_count,
              coalesce(max(CASE WHEN hourly_timestamp = t_next - INTERVAL 24 HOUR THEN ride_count END), 0)::DOUBLE AS lag_24_ride_count
       FROM series, t GROUP BY PULocationID""",
)
def join_lag_lookup(spark, sf):
    s = v.stored_series(spark, sf)
    at = plus_hours(s.agg(F.max(HOUR)).scalar(), 1)
    return j.values_at(s, at, {lag_name(k): (COUNT, k) for k in (1, 2, 24)})


@query(
    "join_semi_zone_set",
    """SELECT event_id, PULocationID FROM pickups
       WHERE PULocationID IN (SELECT LocationID FROM zones WHERE Borough = 'ASIA')""",
)
def join_semi_zone_set(spark, sf):
    return j.keys_in(v.pickups(spark, sf), v.home_zones(spark, sf), ZONE, "LocationID").select("event_id", ZONE)


@query(
    "join_anti_missing",
    "SELECT PULocationID, hourly_timestamp FROM grid g WHERE NOT EXISTS (SELECT 1 FROM counts c"
    " WHERE c.PULocationID = g.PULocationID AND c.hourly_timestamp = g.hourly_timestamp)",
)
def join_anti_missing(spark, sf):
    p = v.pickups(spark, sf)
    keys = v.zones(spark, sf).select(F.col("LocationID").alias(ZONE))
    cells = zone_hours(keys, *hour_span(p, "pickup_ts"))
    return j.keys_missing(cells, hourly_counts(p, "pickup_ts").select(ZONE, HOUR), [ZONE, HOUR])


@query(
    "join_pred_actual",
    """SELECT s.PULocationID, count(*) AS n,
              round(avg(abs(coalesce(c.ride_count, 0) - 1)), 6) AS mae
       FROM grid s LEFT JOIN counts c USING (hourly_timestamp, PULocationID) GROUP BY s.PULocationID""",
)
def join_pred_actual(spark, sf):
    p = v.pickups(spark, sf)
    keys = v.zones(spark, sf).select(F.col("LocationID").alias(ZONE))
    predictions = zone_hours(keys, *hour_span(p, "pickup_ts")).withColumn(PREDICTED, F.lit(1))
    actuals = hourly_counts(p, "pickup_ts").withColumnRenamed(COUNT, ACTUAL)
    out = j.predictions_vs_actuals(predictions, actuals)
    return out.groupBy(ZONE).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("absolute_error"), 6).alias("mae")
    )


# -- aggregations -------------------------------------------------------------
@query("agg_hourly_counts", "SELECT * FROM counts")
def agg_hourly_counts(spark, sf):
    return hourly_counts(v.pickups(spark, sf), "pickup_ts")


@query(
    "agg_multi_key_mean_count",
    """SELECT pu_zone, CAST(pickup_ts AS DATE) AS transaction_date, CAST(month(pickup_ts) AS INTEGER) AS transaction_month,
              CAST(day(pickup_ts) AS INTEGER) AS transaction_day, CAST(hour(pickup_ts) AS INTEGER) AS transaction_hour,
              round(avg(trip_distance), 6) AS trip_distance, round(avg(total_amount), 6) AS total_amount,
              count(total_amount) AS count_of_transactions
       FROM trips WHERE total_amount >= 0 AND total_amount < 200 GROUP BY ALL""",
)
def agg_multi_key_mean_count(spark, sf):
    from tidecast.plans.fares import fare_groups

    g = fare_groups(v.trips(spark, sf), "pickup_ts", "pu_zone", "total_amount", ["trip_distance", "total_amount"])
    return rounded(g, "trip_distance", "total_amount")


@query(
    "agg_first_per_key",
    f"""SELECT {nearest_hour('pickup_ts')} AS hourly_timestamp, PULocationID,
               arg_min(amount, (pickup_ts, event_id)) AS amount,
               arg_min(CASE WHEN vendor <> 'view' THEN vendor END, (pickup_ts, event_id)) AS vendor
        FROM pickups GROUP BY ALL""",
)
def agg_first_per_key(spark, sf):
    p = v.pickups(spark, sf).select(
        hour_bucket("pickup_ts").alias(HOUR),
        ZONE,
        "amount",
        F.when(F.col("vendor") != "view", F.col("vendor")).alias("vendor"),
        "pickup_ts",
        "event_id",
    )
    return a.first_per_key(p, [HOUR, ZONE], ["amount", "vendor"], ["pickup_ts", "event_id"])


@query(
    "agg_median_approx",
    """SELECT c AS "column", n, 1 AS rank_within_bound FROM (
         SELECT 'l_quantity' AS c, count(l_quantity) AS n FROM lineitem
         UNION ALL SELECT 'l_extendedprice', count(l_extendedprice) FROM lineitem)""",
)
def agg_median_approx(spark, sf):
    """Approximate medians, each checked against its true rank: at most n/10000 off."""
    columns = ["l_quantity", "l_extendedprice"]
    li = v.table(spark, sf, "lineitem")
    packed = (
        approx_quantiles(li, columns, [0.5])
        .agg(F.map_from_entries(F.collect_list(F.struct("column", "q0"))))
        .scalar()
    )
    medians = {c: F.try_element_at(packed, F.lit(c)) for c in columns}
    counted = li.agg(
        *[F.count(c).alias(f"{c}_n") for c in columns],
        *[F.count_if(F.col(c) < medians[c]).alias(f"{c}_lt") for c in columns],
        *[F.count_if(F.col(c) <= medians[c]).alias(f"{c}_le") for c in columns],
    )
    rows = []
    for c in columns:
        n = F.col(f"{c}_n")
        slack = n / 10_000 + 1
        good = (F.col(f"{c}_lt") <= n / 2 + slack) & (F.col(f"{c}_le") >= n / 2 - slack)
        rows.append(F.struct(F.lit(c).alias("column"), n.alias("n"), good.cast("int").alias("rank_within_bound")))
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


@query(
    "agg_median_exact",
    """SELECT 'l_quantity' AS "column", count(l_quantity) AS n, median(l_quantity) AS median FROM lineitem
       UNION ALL SELECT 'l_extendedprice', count(l_extendedprice), median(l_extendedprice) FROM lineitem""",
)
def agg_median_exact(spark, sf):
    columns = ["l_quantity", "l_extendedprice"]
    q = exact_quantiles(v.table(spark, sf, "lineitem"), columns, [0.5])
    return q.withColumnRenamed("q0", "median")


def _describe_sql(view: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
              round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS min, round(quantile_cont({c}, 0.25)::DOUBLE, 6) AS p25,
              round(quantile_cont({c}, 0.5)::DOUBLE, 6) AS p50, round(quantile_cont({c}, 0.75)::DOUBLE, 6) AS p75,
              max({c})::DOUBLE AS max FROM {view}"""
        for c in columns
    )


@query("agg_describe", _describe_sql("dataset", ["ride_count", "lag_1_ride_count", "rolling_mean_24h", "target"]))
def agg_describe(spark, sf):
    d = describe(v.stored_dataset(spark, sf), [COUNT, lag_name(1), "rolling_mean_24h", TARGET])
    return rounded(d, "mean", "std", "p25", "p50", "p75")


@query("agg_value_counts", "SELECT cloud_cover, count(*) AS n FROM obs GROUP BY cloud_cover")
def agg_value_counts(spark, sf):
    return a.value_counts(v.observations(spark, sf), "cloud_cover")


@query(
    "agg_distinct_keys",
    """SELECT count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_suppkey) AS n_suppliers,
              1 AS approx_close FROM lineitem""",
)
def agg_distinct_keys(spark, sf):
    lines = v.table(spark, sf, "lineitem")
    parts, suppliers = lines.select("l_partkey").distinct(), lines.select("l_suppkey").distinct()
    # the sketch of the distinct keys is the sketch of all rows; beside two distinct counts it would be shuffled with every key
    close = F.abs(F.approx_count_distinct("l_partkey", 0.02) / F.count("l_partkey") - 1) < 0.1
    return parts.agg(
        F.count("l_partkey").alias("n_parts"),
        suppliers.agg(F.count("l_suppkey")).scalar().alias("n_suppliers"),
        close.cast("int").alias("approx_close"),
    )


@query(
    "agg_min_max",
    """SELECT min(hourly_timestamp) AS first_hour, max(hourly_timestamp) AS last_hour, max(ride_count) AS max_count FROM counts""",
)
def agg_min_max(spark, sf):
    return hourly_counts(v.pickups(spark, sf), "pickup_ts").agg(
        F.min(HOUR).alias("first_hour"), F.max(HOUR).alias("last_hour"), F.max(COUNT).alias("max_count")
    )


@query(
    "agg_share",
    """SELECT round(avg(CAST(amount_of_precipitation > 0 AS INTEGER)), 6) AS rain_share FROM obs_clean""",
)
def agg_share(spark, sf):
    o = clean_observations(v.observations(spark, sf))
    return o.agg(F.round(F.avg((F.col("amount_of_precipitation") > 0).cast("int")), 6).alias("rain_share"))


METRICS_SQL = """count(*) AS n, round(avg(abs(actual - predicted)), 6) AS mae,
    round(avg((actual - predicted) ** 2), 6) AS mse, round(sqrt(avg((actual - predicted) ** 2)), 6) AS rmse,
    round(CASE WHEN var_pop(actual) > 0 THEN 1 - avg((actual - predicted) ** 2) / var_pop(actual) END, 6) AS r2"""


@query("agg_regression_metrics", f"SELECT PULocationID, {METRICS_SQL} FROM errors GROUP BY PULocationID")
def agg_regression_metrics(spark, sf):
    m = a.regression_metrics(v.errors(spark, sf), by=[ZONE])
    return rounded(m, "mae", "mse", "rmse", "r2")


def _slices_sql(dims, prefix=""):
    return " UNION ALL ".join(
        f"SELECT {prefix} '{d}' AS dim, CAST({d} AS VARCHAR) AS value, count(*) AS n, "
        f"round(avg(absolute_error), 6) AS mean_error FROM rows_in GROUP BY {prefix} {d}"
        for d in dims
    )


@query(
    "agg_error_by_dim",
    "WITH rows_in AS (SELECT * FROM errors) "
    + _slices_sql(["PULocationID", "hour", "day_of_week", "is_rush_hour", "is_holiday", "is_weekend"]),
)
def agg_error_by_dim(spark, sf):
    return rounded(analysis.slice_report(v.errors(spark, sf)), "mean_error")


TOP10 = """SELECT PULocationID FROM errors GROUP BY PULocationID, zone
           ORDER BY round(avg(absolute_error), 6) DESC, PULocationID, zone LIMIT 10"""


@query(
    "agg_error_by_zone_and_dim",
    f"WITH rows_in AS (SELECT * FROM errors WHERE PULocationID IN ({TOP10})) "
    + _slices_sql(["hour", "day_of_week", "is_rush_hour", "is_weekend"], "PULocationID,"),
)
def agg_error_by_zone_and_dim(spark, sf):
    return rounded(analysis.zone_slice_report(v.stored_errors(spark, sf)), "mean_error")


@query(
    "agg_bias",
    """SELECT PULocationID, zone, count(*) AS n, round(avg(predicted - actual), 6) AS mean_bias,
              median(predicted - actual) AS median_bias FROM errors GROUP BY ALL""",
)
def agg_bias(spark, sf):
    return rounded(a.bias(v.errors(spark, sf), [ZONE, "zone"]), "mean_bias")


@query(
    "agg_hourly_mae",
    """SELECT hourly_timestamp, round(avg(absolute_error), 6) AS mae,
              round((SELECT avg(m) FROM (SELECT avg(absolute_error) AS m FROM errors GROUP BY hourly_timestamp)), 6) AS mean_of_hours
       FROM errors GROUP BY hourly_timestamp""",
)
def agg_hourly_mae(spark, sf):
    hourly = a.hourly_mae(v.stored_errors(spark, sf))
    overall = hourly.agg(F.round(F.avg("mae"), 6)).scalar()
    return rounded(hourly, "mae").withColumn("mean_of_hours", overall)


@query(
    "agg_confusion",
    """SELECT count(*) FILTER (y AND p) AS tp, count(*) FILTER (NOT y AND p) AS fp,
              count(*) FILTER (y AND NOT p) AS fn, count(*) FILTER (NOT y AND NOT p) AS tn,
              round(count(*) FILTER (y = p) / count(*), 6) AS accuracy,
              round(count(*) FILTER (y AND p) / nullif(count(*) FILTER (p), 0), 6) AS "precision",
              round(count(*) FILTER (y AND p) / nullif(count(*) FILTER (y), 0), 6) AS recall
       FROM (SELECT o_totalprice > 150000 AS y, o_orderpriority < '3' AS p FROM orders)""",
)
def agg_confusion(spark, sf):
    o = v.table(spark, sf, "orders").select(
        (F.col("o_totalprice") > 150_000).cast("int").alias("y"),
        (F.col("o_orderpriority") < "3").cast("int").alias("p"),
    )
    return rounded(a.confusion(o, "y", "p"), "accuracy", "precision", "recall")


def _histogram_sql(view, column, bins):
    return f"""WITH e AS (SELECT min({column}) AS lo, max({column}) AS hi FROM {view})
      SELECT CAST(least(floor(({column} - lo) * {bins} / (hi - lo)), {bins - 1}) AS INTEGER) AS bin, count(*) AS n
      FROM {view}, e WHERE {column} IS NOT NULL GROUP BY 1"""


@query("agg_histogram", _histogram_sql("trips", "total_amount", 60))
def agg_histogram(spark, sf):
    return a.histogram(v.trips(spark, sf), "total_amount", 60)


def _density_sql(by: str) -> str:
    keys, using = (f"{by}, ", f"USING ({by})") if by else ("", "ON true")
    grouped = f"GROUP BY {by}" if by else ""
    return f"""WITH s AS (SELECT {keys}min(absolute_error) AS lo, max(absolute_error) AS hi, count(absolute_error) AS n,
                         stddev_samp(absolute_error) * pow(count(absolute_error), -0.2) AS h FROM errors {grouped}),
       g AS (SELECT s.*, CAST(i AS INTEGER) AS point, lo + (hi - lo) * i / 99 AS x FROM s, range(100) t(i))
       SELECT {keys}point, round(x, 6) AS x,
              round(sum(exp(-0.5 * pow((x - absolute_error) / h, 2))) / (max(n) * max(h) * sqrt(2 * pi())), 6) AS density
       FROM g JOIN errors {using} GROUP BY {keys}point, x"""


@query("agg_density", _density_sql(""))
def agg_density(spark, sf):
    return rounded(a.density(v.stored_errors(spark, sf), "absolute_error"), "x", "density")


@query("agg_density_by_zone", _density_sql("PULocationID"))
def agg_density_by_zone(spark, sf):
    return rounded(a.density(v.stored_errors(spark, sf), "absolute_error", by=[ZONE]), "x", "density")


@query(
    "agg_cv_summary",
    """WITH f AS (SELECT PULocationID, avg(absolute_error) AS score FROM errors GROUP BY PULocationID)
       SELECT round(avg(score), 6) AS cv_mae_mean, round(stddev_pop(score), 6) AS cv_mae_std FROM f""",
)
def agg_cv_summary(spark, sf):
    from tidecast.learning.validation import cv_summary

    scores = v.errors(spark, sf).groupBy(ZONE).agg(F.avg("absolute_error").alias("mae"))
    return rounded(cv_summary(scores, "mae"), "cv_mae_mean", "cv_mae_std")


@query(
    "agg_latest_mean",
    """SELECT round(avg(temperature), 6) AS temperature, round(avg(humidity), 6) AS humidity FROM featured
       WHERE hourly_timestamp = (SELECT max(hourly_timestamp) FROM featured)""",
)
def agg_latest_mean(spark, sf):
    m = a.latest_mean(materialise(v.featured_series(spark, sf), "featured"), HOUR, ["temperature", "humidity"])
    return rounded(m, "temperature", "humidity")


@query(
    "agg_row_count",
    """SELECT count(*) AS n, count(*) FILTER (tip_amount < 0) AS n_negative,
              count(*) FILTER (tip_amount = 0) AS n_zero, count(*) FILTER (total_amount > 200) AS n_above FROM trips""",
)
def agg_row_count(spark, sf):
    return v.trips(spark, sf).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("tip_amount") < 0).alias("n_negative"),
        F.count_if(F.col("tip_amount") == 0).alias("n_zero"),
        F.count_if(F.col("total_amount") > 200).alias("n_above"),
    )


@query(
    "agg_count_diff",
    """SELECT (SELECT count(*) FROM grid) - (SELECT count(*) FROM counts) AS filled_rows,
              (SELECT count(*) FROM lagged) - (SELECT count(*) FROM dataset) AS dropped_rows""",
)
def agg_count_diff(spark, sf):
    from tidecast.plans.features import series_dataset

    full = v.stored_series(spark, sf)
    marked = series_dataset(full, on_missing="zero")
    counted = hourly_counts(v.pickups(spark, sf), "pickup_ts").agg(F.count(F.lit(1))).scalar()
    kept = series_dataset(full).agg(F.count(F.lit(1))).scalar()
    return marked.agg(F.count(F.lit(1)).alias("n")).select(
        (F.col("n") - counted).alias("filled_rows"), (F.col("n") - kept).alias("dropped_rows")
    )


# -- windows ------------------------------------------------------------------
LAG_NAMES = ", ".join(f"lag_{k}_ride_count" for k in (1, 2, 3, 6, 12, 24))


@query("win_lags", f"SELECT hourly_timestamp, PULocationID, ride_count, {LAG_NAMES} FROM lagged")
def win_lags(spark, sf):
    return w.add_lags(v.series(spark, sf), [1, 2, 3, 6, 12, 24])


@query(
    "win_weekly_lag",
    f"""SELECT hourly_timestamp, PULocationID, ride_count,
               coalesce(lag(ride_count, 168) OVER (PARTITION BY PULocationID ORDER BY hourly_timestamp), 0)::DOUBLE AS lag_168_ride_count
        FROM series""",
)
def win_weekly_lag(spark, sf):
    return w.add_lags(v.series(spark, sf), [WEEKLY_LAG], default=0)


@query("win_lead_target", "SELECT hourly_timestamp, PULocationID, ride_count, target FROM lagged")
def win_lead_target(spark, sf):
    return w.add_target(v.series(spark, sf))


@query(
    "win_rolling_excl",
    """SELECT hourly_timestamp, PULocationID, ride_count, round(rolling_mean_3h, 6) AS rolling_mean_3h,
              round(rolling_mean_24h, 6) AS rolling_mean_24h FROM lagged""",
)
def win_rolling_excl(spark, sf):
    return rounded(w.add_rolling(v.series(spark, sf), [3, 24]), "rolling_mean_3h", "rolling_mean_24h")


@query(
    "win_rolling_incl",
    """SELECT hourly_timestamp, PULocationID, ride_count,
              round(avg(ride_count) OVER (PARTITION BY PULocationID ORDER BY hourly_timestamp ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS rolling_mean_3h,
              round(avg(ride_count) OVER (PARTITION BY PULocationID ORDER BY hourly_timestamp ROWS BETWEEN 23 PRECEDING AND CURRENT ROW), 6) AS rolling_mean_24h
       FROM series""",
)
def win_rolling_incl(spark, sf):
    out = w.add_rolling(v.series(spark, sf), [3, 24], include_current=True, min_periods=1)
    return rounded(out, "rolling_mean_3h", "rolling_mean_24h")


@query(
    "win_ffill",
    """SELECT hourly_timestamp, PULocationID, last_value(seen IGNORE NULLS) OVER (PARTITION BY PULocationID
              ORDER BY hourly_timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen FROM seen_series""",
)
def win_ffill(spark, sf):
    return w.ffill(v.stored_seen(spark, sf), ["seen"], block="month")


@query(
    "win_bfill",
    """SELECT hourly_timestamp, PULocationID, first_value(seen IGNORE NULLS) OVER (PARTITION BY PULocationID
              ORDER BY hourly_timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS seen FROM seen_series""",
)
def win_bfill(spark, sf):
    return w.bfill(v.stored_seen(spark, sf), ["seen"], block="month")


@query(
    "win_fill_chain",
    """SELECT hourly_timestamp, PULocationID, coalesce(
              last_value(seen IGNORE NULLS) OVER (PARTITION BY PULocationID ORDER BY hourly_timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
              first_value(seen IGNORE NULLS) OVER (PARTITION BY PULocationID ORDER BY hourly_timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
              0) AS seen FROM seen_series""",
)
def win_fill_chain(spark, sf):
    return w.fill_chain(v.small_series(spark, sf), {"seen": 0.0}, block="month")


@query("win_ffill_hour_dim", "SELECT * FROM weather")
def win_ffill_hour_dim(spark, sf):
    return v.weather(spark, sf)


@query("win_resample_hourly", "SELECT * FROM weather_raw")
def win_resample_hourly(spark, sf):
    from tidecast.plans.weather import OBSERVED

    obs = v.observations(spark, sf)
    return clean_observations(resample_hourly(obs, "observed_at", OBSERVED, ["observed_at", "event_id"])).drop(
        "cloud_cover"
    )


@query(
    "win_interpolate",
    """WITH n AS (SELECT *, row_number() OVER (PARTITION BY PULocationID ORDER BY hourly_timestamp) AS rn FROM seen_series),
       e AS (SELECT *,
         max(CASE WHEN seen IS NOT NULL THEN rn END) OVER (PARTITION BY PULocationID ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pr,
         min(CASE WHEN seen IS NOT NULL THEN rn END) OVER (PARTITION BY PULocationID ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nr
         FROM n)
       SELECT e.hourly_timestamp, e.PULocationID,
              round(CASE WHEN e.seen IS NOT NULL THEN e.seen WHEN e.nr IS NULL THEN p.seen
                   ELSE p.seen + (q.seen - p.seen) * (e.rn - e.pr) / (e.nr - e.pr) END, 6) AS seen
       FROM e LEFT JOIN n p ON p.PULocationID = e.PULocationID AND p.rn = e.pr
              LEFT JOIN n q ON q.PULocationID = e.PULocationID AND q.rn = e.nr""",
)
def win_interpolate(spark, sf):
    return rounded(w.interpolate(v.small_series(spark, sf), ["seen"], block="month"), "seen")


@query(
    "win_dedup_first",
    """SELECT PULocationID, vendor, pickup_ts, event_id, amount FROM pickups
       QUALIFY row_number() OVER (PARTITION BY PULocationID, vendor ORDER BY pickup_ts, event_id) = 1""",
)
def win_dedup_first(spark, sf):
    out = w.dedup(v.pickups(spark, sf), [ZONE, "vendor"], [F.asc("pickup_ts"), F.asc("event_id")])
    return out.select(ZONE, "vendor", "pickup_ts", "event_id", "amount")


@query(
    "win_dedup_last",
    """SELECT PULocationID, vendor, pickup_ts, event_id, amount FROM pickups
       QUALIFY row_number() OVER (PARTITION BY PULocationID, vendor ORDER BY pickup_ts DESC, event_id DESC) = 1""",
)
def win_dedup_last(spark, sf):
    out = w.dedup(v.pickups(spark, sf), [ZONE, "vendor"], [F.desc("pickup_ts"), F.desc("event_id")])
    return out.select(ZONE, "vendor", "pickup_ts", "event_id", "amount")


@query(
    "win_first_n_per_key",
    """SELECT * FROM series QUALIFY row_number() OVER (PARTITION BY PULocationID ORDER BY hourly_timestamp) <= 168""",
)
def win_first_n_per_key(spark, sf):
    return w.first_n_per_key(v.series(spark, sf), 168)


@query(
    "win_fold_ids",
    """WITH p AS (SELECT hourly_timestamp, PULocationID,
                   row_number() OVER (ORDER BY PULocationID, hourly_timestamp) - 1 AS pos, count(*) OVER () AS tot,
                   dense_rank() OVER (ORDER BY hourly_timestamp) - 1 AS hpos FROM series),
       h AS (SELECT count(DISTINCT hourly_timestamp) AS nh FROM series)
       SELECT hourly_timestamp, PULocationID,
              CAST(CASE WHEN pos < tot - 5 * (tot // 6) THEN 0 ELSE (pos - (tot - 5 * (tot // 6))) // (tot // 6) + 1 END AS INTEGER) AS positional_fold,
              CAST(CASE WHEN hpos < nh - 5 * (nh // 6) THEN 0 ELSE (hpos - (nh - 5 * (nh // 6))) // (nh // 6) + 1 END AS INTEGER) AS chronological_fold
       FROM p, h""",
)
def win_fold_ids(spark, sf):
    s = v.stored_series(spark, sf).drop(COUNT)
    by_time = w.assign_folds(s, 5, "chronological").withColumnRenamed("fold", "chronological_fold")
    return w.assign_folds(by_time, 5, "positional").withColumnRenamed("fold", "positional_fold")


# -- sorts, limits, sets ------------------------------------------------------
@query("srt_key_time", f"SELECT * FROM series ORDER BY {KEYS}")
def srt_key_time(spark, sf):
    return v.series(spark, sf).orderBy(ZONE, HOUR)


@query(
    "top_k_groups",
    """SELECT PULocationID, zone, round(avg(absolute_error), 6) AS absolute_error FROM errors GROUP BY ALL
       ORDER BY absolute_error DESC, PULocationID, zone LIMIT 10""",
)
def top_k_groups(spark, sf):
    return analysis.busiest_zones(v.errors(spark, sf), 10)


@query("lim_head", "SELECT event_id, ts, value FROM events ORDER BY ts, event_id LIMIT 5")
def lim_head(spark, sf):
    e = v.table(spark, sf, "events").select("event_id", "ts", "value")
    return e.orderBy("ts", "event_id").limit(5)


@query("lim_first_keys", "SELECT DISTINCT PULocationID FROM pickups ORDER BY 1 LIMIT 5")
def lim_first_keys(spark, sf):
    return v.pickups(spark, sf).select(ZONE).distinct().orderBy(ZONE).limit(5)


@query(
    "set_union",
    """SELECT event_id, ts, 0 AS extra FROM events WHERE ts < TIMESTAMP '2024-01-12'
       UNION ALL SELECT event_id, ts, 1 FROM events WHERE ts >= TIMESTAMP '2024-01-10'""",
)
def set_union(spark, sf):
    e = v.table(spark, sf, "events").select("event_id", "ts")
    first = e.where(F.col("ts") < ntz("2024-01-12 00:00:00"))
    second = e.where(F.col("ts") >= ntz("2024-01-10 00:00:00")).withColumn("extra", F.lit(1))
    return union_all([first, second]).na.fill({"extra": 0})


@query(
    "set_difference",
    "SELECT CAST(o_orderdate AS DATE) AS day FROM orders EXCEPT SELECT CAST(l_shipdate AS DATE) FROM lineitem",
)
def set_difference(spark, sf):
    ordered = v.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    return ordered.subtract(v.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day")))


@query(
    "set_intersection",
    "SELECT PULocationID FROM pickups INTERSECT SELECT LocationID FROM zones WHERE Borough = 'ASIA'",
)
def set_intersection(spark, sf):
    return v.pickups(spark, sf).select(ZONE).intersect(v.home_zones(spark, sf).select("LocationID"))


@query("set_distinct_subset", "SELECT DISTINCT PULocationID, vendor FROM pickups")
def set_distinct_subset(spark, sf):
    return v.pickups(spark, sf).dropDuplicates([ZONE, "vendor"]).select(ZONE, "vendor")
