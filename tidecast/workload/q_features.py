"""Feature sets, monitoring, streaming and whole pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecast.names import ACTUAL, COUNT, HOUR, PREDICTED, TARGET, WEATHER_COLUMNS, ZONE
from tidecast.operators import aggregates as a
from tidecast.operators import sketches
from tidecast.operators.grid import hourly_counts
from tidecast.operators.quantiles import exact_quantiles
from tidecast.plans import analysis, fares
from tidecast.plans import features as feat
from tidecast.plans.ingest import clean_trips
from tidecast.plans.weather import weather_by_hour
from tidecast.sources import writers
from tidecast.sources.contracts import DATASET
from tidecast.sources.storage import materialise, work_path
from tidecast.sources.versions import SnapshotTable
from tidecast.streaming import jobs
from tidecast.workload import views as v
from tidecast.workload.oracle_views import CALENDAR, holiday, nearest_hour
from tidecast.workload.q_relational import TOP10, rounded
from tidecast.workload.q_rows import BASIS_SQL, FILLED_SQL, STEPS, TRIP_END, TRIP_START, ntz
from tidecast.workload.registry import query


# -- features -----------------------------------------------------------------
@query("feat_temporal", f"SELECT hourly_timestamp, PULocationID, {CALENDAR} FROM counts")
def feat_temporal(spark, sf):
    return feat.add_calendar(hourly_counts(v.pickups(spark, sf), "pickup_ts")).drop(COUNT)


@query(
    "feat_zone",
    """SELECT hourly_timestamp, PULocationID, Zone AS zone_name, Borough AS borough,
              CAST(PULocationID IN (2, 7) AS INTEGER) AS is_downtown
       FROM counts LEFT JOIN zones ON PULocationID = LocationID""",
)
def feat_zone(spark, sf):
    counts = hourly_counts(v.pickups(spark, sf), "pickup_ts").drop(COUNT)
    names = {"Zone": "zone_name", "Borough": "borough"}
    return feat.add_zone_features(counts, v.zones(spark, sf), v.DOWNTOWN, columns=names)


@query(
    "feat_weather",
    """SELECT hourly_timestamp, coalesce(temperature, 0) AS temperature, coalesce(humidity, 0) AS humidity,
              coalesce(wind_speed, 0) AS wind_speed, coalesce(cloud_cover_numeric, 0) AS cloud_cover_numeric,
              amount_of_precipitation FROM weather""",
)
def feat_weather(spark, sf):
    obs = v.observations(spark, sf)
    return weather_by_hour(obs, "observed_at", ["observed_at", "event_id"], zero_head=True)


INTERACTIONS_SQL = """*, CAST(zone IN (0,3,8,11,17) AND hour_of_day BETWEEN 18 AND 23 AND is_weekend = 1 AS INTEGER) AS has_event,
    CAST(amount_of_precipitation > 0 AS INTEGER) AS is_raining,
    CAST(amount_of_precipitation > 0 AND is_downtown = 1 AS INTEGER) AS is_raining_downtown,
    CAST(hour_of_day BETWEEN 16 AND 19 AND is_weekend = 0 AS INTEGER) AS is_evening_rush,
    is_weekend * hour_of_day AS is_weekend_hour, is_rush_hour * is_downtown AS is_rush_hour_downtown,
    is_downtown * hour_of_day AS is_downtown_hour"""


@query("feat_events_interactions", f"SELECT {INTERACTIONS_SQL} FROM featured")
def feat_events_interactions(spark, sf):
    return feat.add_interactions(v.featured_series(spark, sf), v.BUSY)


DATASET_SQL = """SELECT * REPLACE (round(rolling_mean_3h, 6) AS rolling_mean_3h,
                 round(rolling_mean_24h, 6) AS rolling_mean_24h) FROM dataset"""


@query("feat_series_dataset", DATASET_SQL)
def feat_series_dataset(spark, sf):
    return rounded(v.dataset(spark, sf), "rolling_mean_3h", "rolling_mean_24h")


STORE_START, STORE_END = "2024-01-20 00:00:00", "2024-01-27 00:00:00"
STORE_CTES = f"""WITH in_range AS (
    SELECT {nearest_hour('pickup_ts')} AS hourly_timestamp, PULocationID FROM pickups
    WHERE pickup_ts >= TIMESTAMP '{STORE_START}' AND pickup_ts <= TIMESTAMP '{STORE_END}'),
  range_counts AS (SELECT hourly_timestamp, PULocationID, count(*) AS n FROM in_range GROUP BY ALL),
  range_series AS (
    SELECT g.hourly_timestamp, g.PULocationID, coalesce(n, 0) AS ride_count
    FROM (SELECT unnest(generate_series(TIMESTAMP '{STORE_START}', TIMESTAMP '{STORE_END}', INTERVAL 1 HOUR)) AS hourly_timestamp,
                 LocationID AS PULocationID FROM zones) g
    LEFT JOIN range_counts USING (hourly_timestamp, PULocationID)),
  store AS (
    SELECT s.*, {CALENDAR}, coalesce(w.temperature, 0) AS temperature, coalesce(w.humidity, 0) AS humidity,
      coalesce(w.wind_speed, 0) AS wind_speed, coalesce(w.cloud_cover_numeric, 0) AS cloud_cover_numeric,
      coalesce(w.amount_of_precipitation, 0) AS amount_of_precipitation,
      z.Zone AS zone_name, CAST(PULocationID IN (2, 7) AS INTEGER) AS is_downtown,
      PULocationID AS zone, PULocationID AS "LocationID",
      coalesce(lag(ride_count, 1) OVER x, 0)::DOUBLE AS lag_1_ride_count,
      coalesce(lag(ride_count, 2) OVER x, 0)::DOUBLE AS lag_2_ride_count,
      coalesce(lag(ride_count, 24) OVER x, 0)::DOUBLE AS lag_24_ride_count,
      round(avg(ride_count) OVER (PARTITION BY PULocationID ORDER BY hourly_timestamp ROWS 2 PRECEDING), 6) AS rolling_mean_3h,
      round(avg(ride_count) OVER (PARTITION BY PULocationID ORDER BY hourly_timestamp ROWS 23 PRECEDING), 6) AS rolling_mean_24h
    FROM range_series s LEFT JOIN weather w USING (hourly_timestamp) JOIN zones z ON z.LocationID = s.PULocationID
    WINDOW x AS (PARTITION BY PULocationID ORDER BY hourly_timestamp))"""


def store(spark, sf):
    return rounded(
        feat.feature_store(
            v.pickups(spark, sf),
            "pickup_ts",
            v.zones(spark, sf),
            v.weather(spark, sf, zero_head=True),
            ntz(STORE_START),
            ntz(STORE_END),
            v.DOWNTOWN,
        ),
        "rolling_mean_3h",
        "rolling_mean_24h",
    )


@query("feat_store_build", f"{STORE_CTES} SELECT * FROM store")
def feat_store_build(spark, sf):
    return store(spark, sf)


PARITY_SQL = f"""{STORE_CTES},
  keys AS (SELECT TIMESTAMP '{STORE_END}' + INTERVAL 1 HOUR AS hourly_timestamp, LocationID AS PULocationID FROM zones),
  wx AS (SELECT avg(temperature) AS temperature, avg(humidity) AS humidity, avg(wind_speed) AS wind_speed,
                avg(cloud_cover_numeric) AS cloud_cover_numeric, avg(amount_of_precipitation) AS amount_of_precipitation
         FROM store WHERE hourly_timestamp = TIMESTAMP '{STORE_END}'),
  at_hour AS (SELECT PULocationID,
    max(CASE WHEN hourly_timestamp = TIMESTAMP '{STORE_END}' THEN ride_count END)::DOUBLE AS lag_1_ride_count,
    max(CASE WHEN hourly_timestamp = TIMESTAMP '{STORE_END}' - INTERVAL 1 HOUR THEN ride_count END)::DOUBLE AS lag_2_ride_count,
    max(CASE WHEN hourly_timestamp = TIMESTAMP '{STORE_END}' - INTERVAL 23 HOUR THEN ride_count END)::DOUBLE AS lag_24_ride_count,
    max(CASE WHEN hourly_timestamp = TIMESTAMP '{STORE_END}' THEN rolling_mean_3h END) AS rolling_mean_3h,
    max(CASE WHEN hourly_timestamp = TIMESTAMP '{STORE_END}' THEN rolling_mean_24h END) AS rolling_mean_24h
    FROM store GROUP BY PULocationID)
  SELECT k.hourly_timestamp, k.PULocationID, {CALENDAR},
         round(temperature, 6) AS temperature, round(humidity, 6) AS humidity, round(wind_speed, 6) AS wind_speed,
         round(cloud_cover_numeric, 6) AS cloud_cover_numeric, round(amount_of_precipitation, 6) AS amount_of_precipitation,
         CAST(k.PULocationID IN (2, 7) AS INTEGER) AS is_downtown,
         lag_1_ride_count, lag_2_ride_count, lag_24_ride_count, rolling_mean_3h, rolling_mean_24h
  FROM keys k, wx LEFT JOIN at_hour h ON h.PULocationID = k.PULocationID"""


@query("feat_next_hour", PARITY_SQL.replace("FROM keys k, wx LEFT JOIN", "FROM (SELECT * FROM keys, wx) k LEFT JOIN"))
def feat_next_hour(spark, sf):
    rows = feat.next_hour_rows(materialise(store(spark, sf), "store"), v.zones(spark, sf), None, v.DOWNTOWN, mode="parity")
    return rounded(rows, *WEATHER_COLUMNS)


@query(
    "feat_next_hour_aligned",
    f"{STORE_CTES} SELECT * FROM store WHERE hourly_timestamp = (SELECT max(hourly_timestamp) FROM store)",
)
def feat_next_hour_aligned(spark, sf):
    return feat.next_hour_rows(materialise(store(spark, sf), "store"), v.zones(spark, sf), downtown=v.DOWNTOWN)


# -- monitoring ---------------------------------------------------------------
def _offline(e):
    """Offline scores of the persistence model: MAE up to two earlier cut-off days."""
    return e.agg(
        F.round(F.avg(F.when(F.col(HOUR) < ntz("2024-01-20 00:00:00"), F.col("absolute_error"))), 6).alias("offline_cv_mae"),
        F.round(F.avg(F.when(F.col(HOUR) < ntz("2024-01-25 00:00:00"), F.col("absolute_error"))), 6).alias("offline_test_mae"),
    )


OFFLINE_SQL = """SELECT round(avg(absolute_error) FILTER (hourly_timestamp < TIMESTAMP '2024-01-20'), 6) AS offline_cv_mae,
                        round(avg(absolute_error) FILTER (hourly_timestamp < TIMESTAMP '2024-01-25'), 6) AS offline_test_mae
                 FROM errors"""


@query(
    "mon_online_vs_offline",
    f"""WITH off AS ({OFFLINE_SQL})
        SELECT hourly_timestamp, round(avg(absolute_error), 6) AS mae, offline_cv_mae, offline_test_mae
        FROM errors, off GROUP BY ALL""",
)
def mon_online_vs_offline(spark, sf):
    e = v.stored_errors(spark, sf)
    return rounded(analysis.online_vs_offline(e, _offline(e)), "mae")


@query(
    "mon_drift_flag",
    f"""WITH off AS ({OFFLINE_SQL}),
        onl AS (SELECT avg(m) AS online_mae FROM (SELECT avg(absolute_error) AS m FROM errors GROUP BY hourly_timestamp))
        SELECT round(online_mae, 6) AS online_mae, round(offline_test_mae * 1.2, 6) AS drift_limit,
               CAST(online_mae > offline_test_mae * 1.2 AS INTEGER) AS is_drifting FROM onl, off""",
)
def mon_drift_flag(spark, sf):
    e = v.stored_errors(spark, sf)
    offline = _offline(e).select("offline_test_mae").scalar()
    return rounded(analysis.drift_report(e, offline), "online_mae", "drift_limit")


@query(
    "mon_pred_scatter",
    """SELECT actual, predicted, hourly_timestamp, PULocationID FROM errors
       WHERE PULocationID IN (SELECT LocationID FROM zones WHERE Borough = 'ASIA')""",
)
def mon_pred_scatter(spark, sf):
    return analysis.scatter(v.errors(spark, sf), v.home_zones(spark, sf), "LocationID")


@query(
    "mon_zone_demand_map",
    """SELECT hourly_timestamp, PULocationID, latitude, longitude, predicted_ride_count,
              round(predicted_ride_count / 20, 6) AS radius
       FROM (SELECT hourly_timestamp, PULocationID, CAST(predicted AS INTEGER) AS predicted_ride_count FROM errors)
       JOIN (SELECT LocationID, round(40.7 + LocationID / 100, 4)::DOUBLE AS latitude, round(-74 + LocationID / 100, 4)::DOUBLE AS longitude
             FROM zones WHERE Borough <> 'EUROPE') ON PULocationID = LocationID""",
)
def mon_zone_demand_map(spark, sf):
    shift = F.col("LocationID") / 100
    coordinates = v.zones(spark, sf).where("Borough <> 'EUROPE'").select(
        F.col("LocationID").alias(ZONE),
        F.round(F.lit(40.7) + shift, 4).alias("latitude"),
        F.round(F.lit(-74) + shift, 4).alias("longitude"),
    )
    predictions = v.errors(spark, sf).select(
        HOUR, ZONE, F.col(PREDICTED).cast("int").alias("predicted_ride_count")
    )
    return rounded(analysis.demand_map(predictions, coordinates), "radius")


@query(
    "mon_actual_vs_pred_series",
    f"""SELECT PULocationID, hourly_timestamp, actual, predicted FROM errors WHERE PULocationID IN ({TOP10})
        QUALIFY row_number() OVER (PARTITION BY PULocationID ORDER BY hourly_timestamp) <= 168""",
)
def mon_actual_vs_pred_series(spark, sf):
    return analysis.zone_series(v.stored_errors(spark, sf))


@query(
    "mon_feature_shift",
    """WITH d AS (SELECT amount AS v, pickup_ts >= TIMESTAMP '2024-01-16' AS cur FROM pickups),
       e AS (SELECT min(v) AS lo, max(v) AS hi FROM d WHERE NOT cur),
       t AS (SELECT count(*) FILTER (NOT cur) AS b, count(*) FILTER (cur) AS c FROM d),
       h AS (SELECT CAST(greatest(0, least(floor((v - lo) * 10 / (hi - lo)), 9)) AS INTEGER) AS bin,
                    count(*) FILTER (NOT cur) AS base_n, count(*) FILTER (cur) AS current_n FROM d, e GROUP BY 1)
       SELECT bin, base_n, current_n,
              round((greatest(current_n / c, 1e-6) - greatest(base_n / b, 1e-6))
                    * ln(greatest(current_n / c, 1e-6) / greatest(base_n / b, 1e-6)), 6)::DOUBLE AS psi FROM h, t""",
)
def mon_feature_shift(spark, sf):
    current = F.col("pickup_ts") >= ntz("2024-01-16 00:00:00")
    return rounded(a.population_shift(v.pickups(spark, sf), "amount", current), "psi")


def _stored_sketches(spark, sf):
    """A row per day and column, stored as monitoring would keep it."""
    e = v.table(spark, sf, "events")
    return materialise(sketches.period_sketches(e, F.to_date("ts"), ["value"], ["user_id"]), "sketches")


@query(
    "mon_stored_sketches",
    """SELECT 'value' AS "column", count(DISTINCT ts::DATE) AS periods, count(value) AS n, min(value) AS lo, max(value) AS hi, 1 AS in_bounds FROM events
       UNION ALL SELECT 'user_id', count(DISTINCT ts::DATE), count(user_id), NULL, NULL, 1 FROM events""",
)
def mon_stored_sketches(spark, sf):
    """Counts, extremes, quantiles and distinct users of all days from the stored sketches, held against exact ones."""
    found = sketches.estimates(_stored_sketches(spark, sf), [0.1, 0.5, 0.9])
    q = {c: F.max(F.when(F.col("column") == "value", F.col(c))) for c in ("q0", "q1", "q2")}
    one = found.agg(*[x.alias(c) for c, x in q.items()], F.max("n_distinct").alias("d"))
    packed = one.select(F.struct(*one.columns)).scalar()
    e = v.table(spark, sf, "events")
    bounds = [F.abs(F.count_if(F.col("value") <= packed[c]) / F.count("value") - p) < 0.03 for c, p in (("q0", 0.1), ("q1", 0.5), ("q2", 0.9))]
    close = F.abs(packed["d"] / F.count_distinct("user_id") - 1) < 0.06
    held = e.agg(F.struct((bounds[0] & bounds[1] & bounds[2]).cast("int").alias("value"), close.cast("int").alias("user_id"))).scalar()
    in_bounds = F.when(F.col("column") == "value", held["value"]).otherwise(held["user_id"])
    return found.select("column", "periods", "n", "lo", "hi", in_bounds.alias("in_bounds"))


@query("mon_stored_shift", "SELECT unnest(range(10))::INTEGER AS bin, 1 AS base_is_even, 1 AS current_in_bounds")
def mon_stored_shift(spark, sf):
    """Shift of a month's second half against its first from the stored sketches; shares held against exact ones."""
    shift = sketches.stored_shift(_stored_sketches(spark, sf), "value", F.col("period") >= F.lit("2024-01-16").cast("date"))
    e = v.table(spark, sf, "events").where("value is not null")
    late = F.col("ts") >= ntz("2024-01-16 00:00:00")
    # exact shares between the exact deciles of the first half; the sketch may be off by its rank error on either side
    deciles = [i / 10 for i in range(1, 10)]
    cuts = exact_quantiles(e.where(~late), ["value"], deciles).select(F.array(*[f"q{i}" for i in range(9)])).scalar()
    place = sum(((F.col("value") > cuts[i]).cast("int") for i in range(9)), F.lit(0))
    exact = e.where(late).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    total = e.agg(F.count_if(late)).scalar()
    return shift.join(exact, "bin", "left").select(
        "bin", (F.abs(F.col("base_share") - 0.1) < 0.04).cast("int").alias("base_is_even"),
        (F.abs(F.col("current_share") - F.coalesce("n", F.lit(0)) / total) < 0.06).cast("int").alias("current_in_bounds"),
    )


# -- streaming ----------------------------------------------------------------
def _event_stream(spark, sf):
    """The events table as a stream of newly arriving files.

    The pattern lets the table be one file as well as a folder of files.
    """
    schema = v.table(spark, sf, "events").schema
    return jobs.read_new_files(spark, f"{sf}/events.parque[t]", schema)


def _pickup_stream(spark, sf):
    e = _event_stream(spark, sf)
    return e.select(
        "event_id",
        F.col("ts").alias("pickup_ts"),
        (F.col("user_id") % 25).cast("int").alias(ZONE),
        F.col("value").alias("amount"),
    )


@query("st_ingest_clean", "SELECT event_id, ts, value FROM events WHERE value BETWEEN 1 AND 300 AND event_type <> 'error'")
def st_ingest_clean(spark, sf):
    base = work_path(spark, "st-clean")
    rules = [("value", F.col("value").between(1, 300)), ("type", F.col("event_type") != "error")]
    cleaned = jobs.clean_stream(_event_stream(spark, sf), rules).select("event_id", "ts", "value")
    jobs.run_available(cleaned, f"{base}/checkpoint", "append", jobs.changelog_sink(f"{base}/table"))
    return spark.read.parquet(f"{base}/table").drop("batch")


@query("st_hourly_counts", "SELECT hourly_timestamp, PULocationID, ride_count FROM counts")
def st_hourly_counts(spark, sf):
    base = work_path(spark, "st-counts")
    sink = jobs.partial_sink(f"{base}/log", [HOUR, ZONE], {COUNT: F.lit(1)})
    jobs.run_available(jobs.hour_cells(_pickup_stream(spark, sf), "pickup_ts"), f"{base}/checkpoint", "append", sink)
    return jobs.totals(spark, f"{base}/log", [HOUR, ZONE], [COUNT])


@query("st_feature_upsert", "SELECT hourly_timestamp, PULocationID, ride_count FROM counts")
def st_feature_upsert(spark, sf):
    base = work_path(spark, "st-store")
    sink = jobs.upsert_totals_sink(f"{base}/store", f"{base}/log", [HOUR, ZONE], {COUNT: F.lit(1)}, "day")
    jobs.run_available(jobs.hour_cells(_pickup_stream(spark, sf), "pickup_ts"), f"{base}/checkpoint", "append", sink)
    return SnapshotTable(spark, f"{base}/store").read().drop("day")


@query("st_dedup", "SELECT event_id, pickup_ts, PULocationID, amount FROM pickups")
def st_dedup(spark, sf):
    base = work_path(spark, "st-dedup")
    twice = _pickup_stream(spark, sf).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    jobs.run_available(twice, f"{base}/checkpoint", "append", jobs.once_sink(f"{base}/table", ["event_id"], "pickup_ts"))
    return jobs.stored_rows(spark, f"{base}/table").drop("day")


@query(
    "st_online_error",
    "SELECT hourly_timestamp, round(avg(abs(ride_count - 1)), 6) AS mae, count(*) AS n FROM series GROUP BY hourly_timestamp",
)
def st_online_error(spark, sf):
    base = work_path(spark, "st-errors")
    v.series(spark, sf).withColumnRenamed(COUNT, ACTUAL).write.parquet(f"{base}/actuals")
    predictions = spark.read.parquet(f"{base}/actuals").select(HOUR, ZONE, F.lit(1).alias(PREDICTED))
    schema = spark.read.parquet(f"{base}/actuals").schema
    actuals = jobs.read_new_files(spark, f"{base}/actuals", schema)
    sink = jobs.partial_sink(f"{base}/log", [HOUR], {"error": F.col("error"), "n": F.lit(1)})
    jobs.run_available(jobs.absolute_errors(actuals, predictions), f"{base}/checkpoint", "append", sink)
    return rounded(jobs.hourly_errors(spark, f"{base}/log"), "mae")


# -- pipelines ----------------------------------------------------------------
@query(
    "pl_ingest",
    f"WITH basis AS ({BASIS_SQL}), filled AS ({FILLED_SQL} basis) "
    "SELECT strftime(pickup_ts, '%Y-%m') AS period, count(*) AS n, round(sum(total_amount), 4) AS total_amount "
    "FROM filled WHERE " + " AND ".join(s for _, s in STEPS[4:]) + " GROUP BY 1",
)
def pl_ingest(spark, sf):
    path = work_path(spark, "ingest")
    cleaned = clean_trips(
        v.trips(spark, sf), v.home_zones(spark, sf), "LocationID", ntz(TRIP_START), ntz(TRIP_END), v.TRIP_ROLES
    ).withColumn("period", F.date_format("pickup_ts", "yyyy-MM"))
    writers.write_partitioned(cleaned, path, ["period"])
    return spark.read.schema(cleaned.schema).parquet(path).groupBy("period").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("total_amount"), 4).alias("total_amount")
    )


@query(
    "pl_features",
    f"""WITH base AS (SELECT c.*, {CALENDAR}, CAST(PULocationID IN (2, 7) AS INTEGER) AS is_downtown, PULocationID AS zone,
              w.temperature, w.humidity, w.wind_speed, w.cloud_cover_numeric,
              coalesce(w.amount_of_precipitation, 0) AS amount_of_precipitation
            FROM counts c LEFT JOIN weather w USING (hourly_timestamp))
        SELECT {INTERACTIONS_SQL} FROM base""",
)
def pl_features(spark, sf):
    counts = hourly_counts(v.pickups(spark, sf), "pickup_ts")
    return feat.add_interactions(feat.featured(counts, v.weather(spark, sf), None, v.DOWNTOWN), v.BUSY)


@query(
    "pl_dataset",
    """SELECT CASE WHEN hourly_timestamp <= TIMESTAMP '2024-01-22 23:00:00' THEN 'train' ELSE 'test' END AS side,
              count(*) AS n, CAST(sum(ride_count) AS BIGINT) AS rides, sum(target) AS target_sum,
              min(hourly_timestamp) AS first_hour, max(hourly_timestamp) AS last_hour
       FROM dataset GROUP BY 1""",
)
def pl_dataset(spark, sf):
    path = work_path(spark, "dataset")
    data = v.stored_dataset(spark, sf)
    sides = feat.split_by_time(data, ntz("2024-01-22 23:00:00"))
    out = None
    for name, side in zip(("train", "test"), sides, strict=True):
        writers.write_contract(side, DATASET, f"{path}/{name}")
        back = spark.read.parquet(f"{path}/{name}").withColumn("side", F.lit(name))
        out = back if out is None else out.unionByName(back)
    return out.groupBy("side").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(COUNT).alias("rides"),
        F.sum(TARGET).alias("target_sum"),
        F.min(HOUR).alias("first_hour"),
        F.max(HOUR).alias("last_hour"),
    )


@query(
    "pl_analyse",
    f"""SELECT PULocationID, count(*) AS n, round(avg(absolute_error), 6) AS mean_error,
               round(avg(predicted - actual), 6) AS mean_bias, median(predicted - actual) AS median_bias
        FROM errors WHERE PULocationID IN ({TOP10}) GROUP BY PULocationID""",
)
def pl_analyse(spark, sf):
    e = v.stored_errors(spark, sf)
    top = analysis.busiest_zones(e).withColumnRenamed("absolute_error", "mean_error").drop("zone")
    return rounded(top.join(a.bias(e, [ZONE]), ZONE), "mean_bias")


@query(
    "pl_monitor",
    f"""WITH off AS ({OFFLINE_SQL}), hourly AS (SELECT hourly_timestamp, avg(absolute_error) AS m FROM errors GROUP BY 1),
        onl AS (SELECT avg(m) AS o FROM hourly)
        SELECT hourly_timestamp, round(m, 6) AS mae, offline_test_mae, CAST(o > 1.2 * offline_test_mae AS INTEGER) AS is_drifting
        FROM hourly, onl, off""",
)
def pl_monitor(spark, sf):
    e = v.stored_errors(spark, sf)
    offline = _offline(e).select("offline_test_mae")
    flag = analysis.drift_report(e, offline.scalar()).select("is_drifting").scalar()
    return rounded(analysis.online_vs_offline(e, offline), "mae").withColumn("is_drifting", flag)


def _interpolate_sql(column: str) -> str:
    frame = "OVER (ORDER BY rn ROWS BETWEEN"
    before = f"max(CASE WHEN {column} IS NOT NULL THEN rn END) {frame} UNBOUNDED PRECEDING AND CURRENT ROW)"
    after = f"min(CASE WHEN {column} IS NOT NULL THEN rn END) {frame} CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"""edges_{column} AS (SELECT rn, {column} AS v, {before} AS pr, {after} AS nr FROM numbered),
      fill_{column} AS (SELECT e.rn, CASE WHEN e.v IS NOT NULL THEN e.v WHEN e.nr IS NULL THEN p.{column}
          WHEN e.pr IS NULL THEN q.{column}
          ELSE p.{column} + (q.{column} - p.{column}) * (e.rn - e.pr) / (e.nr - e.pr) END AS {column}
        FROM edges_{column} e LEFT JOIN numbered p ON p.rn = e.pr LEFT JOIN numbered q ON q.rn = e.nr)"""


FARE_WEATHER = WEATHER_COLUMNS
FARE_SQL = f"""WITH parsed AS (
    SELECT date_trunc('hour', observed_at)::TIMESTAMP AS h, temperature, humidity, wind_speed,
           CASE cloud_cover WHEN 'no clouds' THEN 0.0::DOUBLE WHEN '20–30%.' THEN 0.3 WHEN '50%.' THEN 0.5
                WHEN '70 – 80%.' THEN 0.7 WHEN '100%.' THEN 1 END AS cloud_cover_numeric,
           CASE WHEN amount_of_precipitation = 'Trace of precipitation' THEN 0.1::DOUBLE
                ELSE TRY_CAST(amount_of_precipitation AS DOUBLE) END AS amount_of_precipitation
    FROM obs QUALIFY row_number() OVER (PARTITION BY h ORDER BY observed_at DESC, event_id DESC) = 1),
  numbered AS (SELECT *, row_number() OVER (ORDER BY h) AS rn FROM parsed),
  {", ".join(_interpolate_sql(c) for c in FARE_WEATHER)},
  wx AS (SELECT month(h) AS m, day(h) AS d, hour(h) AS hh, {", ".join(f"fill_{c}.{c}" for c in FARE_WEATHER)}
         FROM numbered {" ".join(f"JOIN fill_{c} USING (rn)" for c in FARE_WEATHER)}),
  g AS (SELECT pu_zone, CAST(pickup_ts AS DATE) AS transaction_date, CAST(month(pickup_ts) AS INTEGER) AS transaction_month,
               CAST(day(pickup_ts) AS INTEGER) AS transaction_day, CAST(hour(pickup_ts) AS INTEGER) AS transaction_hour,
               round(avg(trip_distance), 6) AS trip_distance, round(avg(total_amount), 6) AS total_amount,
               count(total_amount) AS count_of_transactions
        FROM trips WHERE total_amount >= 0 AND total_amount < 200 GROUP BY ALL)
  SELECT g.*, CAST(isodow(transaction_date) - 1 AS INTEGER) AS transaction_week_day,
         CAST(isodow(transaction_date) > 5 AS INTEGER) AS weekend,
         CAST({holiday('transaction_date')} AS INTEGER) AS is_holiday, Borough AS "Borough",
         {", ".join(f"round({c}, 6) AS {c}" for c in FARE_WEATHER)}
  FROM g LEFT JOIN zones ON pu_zone = LocationID
  LEFT JOIN wx ON transaction_month = m AND transaction_day = d AND transaction_hour = hh"""


@query("pl_fare_features", FARE_SQL)
def pl_fare_features(spark, sf):
    g = fares.fare_groups(v.trips(spark, sf), "pickup_ts", "pu_zone", "total_amount", ["trip_distance", "total_amount"])
    enriched = fares.enrich(rounded(g, "trip_distance", "total_amount"), v.zones(spark, sf), "pu_zone")
    hourly = fares.interpolated_weather(v.observations(spark, sf), "observed_at", ["observed_at", "event_id"])
    return rounded(fares.add_weather_by_parts(enriched, hourly), *FARE_WEATHER)
