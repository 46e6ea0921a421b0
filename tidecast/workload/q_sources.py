"""Sources and sinks. Sink queries write to the shared work folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.functions.scalars import weather_from_json
from tidecast.names import COUNT, HOUR, ZONE
from tidecast.operators.grid import hour_span, hourly_counts, zone_hours
from tidecast.sources import readers, writers
from tidecast.sources.contracts import FEATURED, PREDICTIONS, RUN_LOG
from tidecast.sources.storage import work_path
from tidecast.sources.versions import SnapshotTable
from tidecast.workload import views as v
from tidecast.workload.registry import query


@query(
    "src_parquet_scan",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate FROM lineitem",
)
def src_parquet_scan(spark, sf):
    return readers.read_trips(spark, f"{sf}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"
    )


@query("src_multi_file_union", "SELECT event_id, ts, value FROM events")
def src_multi_file_union(spark, sf):
    base = work_path(spark, "periods")
    e = v.table(spark, sf, "events").select("event_id", "ts", "value")
    third = F.least(F.floor((F.day("ts") - 1) / 10), F.lit(2)).cast("int")
    e.withColumn("period", third).write.partitionBy("period").parquet(base)
    paths = [f"{base}/period={i}" for i in range(3)]
    return readers.read_periods(spark, paths, schema=e.schema)


@query("src_pruned_scan", "SELECT o_orderkey, o_orderdate FROM orders")
def src_pruned_scan(spark, sf):
    return readers.read_columns(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_orderdate"])


@query(
    "src_csv_dimension",
    """SELECT LocationID, Borough, Zone,
              CASE WHEN Borough <> 'MIDDLE EAST' THEN 'zone of ' || Borough END AS service_zone
       FROM zones""",
)
def src_csv_dimension(spark, sf):
    path = work_path(spark, "zones-csv")
    label = F.when(F.col("Borough") != "MIDDLE EAST", F.concat(F.lit("zone of "), F.col("Borough")))
    out = v.zones(spark, sf).select("LocationID", "Borough", "Zone", label.alias("service_zone"))
    writers.write_csv(out, path)
    return readers.read_zones(spark, path)


@query(
    "src_csv_timestamped",
    """SELECT date_trunc('minute', observed_at) AS observed_at, temperature, humidity, wind_speed,
              cloud_cover, amount_of_precipitation FROM obs""",
)
def src_csv_timestamped(spark, sf):
    path = work_path(spark, "observations-csv")
    o = v.observations(spark, sf)
    o.select(
        F.date_format("observed_at", "dd.MM.yyyy HH:mm").alias("date and time"),
        "temperature",
        "humidity",
        F.col("wind_speed").alias("wind speed"),
        F.col("cloud_cover").alias("cloud cover"),
        F.col("amount_of_precipitation").alias("amount of precipitation"),
    ).write.option("header", True).csv(path)
    return readers.read_observations(spark, path)


@query(
    "src_csv_rejects",
    """SELECT CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0 THEN 'malformed' WHEN value > 400 THEN 'value' ELSE 'kept' END AS status,
              count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1""",
)
def src_csv_rejects(spark, sf):
    """Lines with a word for a number, a field too many or too few go to a quarantine table beside the kept rows."""
    base = work_path(spark, "rejects")
    e = v.table(spark, sf, "events")
    number = F.when(F.col("event_id") % 7 == 0, F.lit("oops")).otherwise(F.col("value").cast("string"))
    fields = F.concat_ws(",", F.col("event_id").cast("string"), number, F.when(F.col("event_id") % 13 != 0, F.col("event_type")))
    line = F.when((F.col("event_id") % 11 == 0) & (F.col("event_id") % 13 != 0), F.concat(fields, F.lit(",more"))).otherwise(fields)
    e.select(line.alias("value")).write.text(f"{base}/lines")
    schema = T._parse_datatype_string("event_id bigint, value double, event_type string")
    rules = [("value", F.col("value") <= 400)]
    kept, rejected = readers.read_csv_checked(spark, f"{base}/lines", schema, rules=rules, header=False)
    rejected.write.parquet(f"{base}/quarantine")
    held = spark.read.parquet(f"{base}/quarantine").select(F.col("reason").alias("status"), F.split("line", ",")[0].cast("bigint").alias("event_id"))
    both = kept.select(F.lit("kept").alias("status"), "event_id").unionByName(held)
    return both.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))


def _metadata(spark, sf):
    """One model document per event type, with scores taken from the events."""
    measured = v.pickups(spark, sf).groupBy("vendor").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("amount").alias("lo"),
        F.max("amount").alias("hi"),
        F.count_if(F.col("amount") > 100).alias("big"),
    )
    none = F.lit(None).cast("double")
    return measured.select(
        F.concat(F.lit("model_"), F.col("vendor")).alias("model_name"),
        F.lit("persistence").alias("model_type"),
        F.create_map(F.lit("column"), F.lit("lag_1_ride_count"), F.lit("kind"), F.col("vendor")).alias("parameters"),
        F.array(F.lit("lag_1_ride_count"), F.lit("hour_of_day")).alias("feature_columns"),
        F.lit("target").alias("target_column"),
        F.lit("2024-01-31T00:00:00").alias("training_timestamp"),
        F.struct(
            F.col("lo").alias("train_mae"),
            none.alias("train_mse"),
            none.alias("train_rmse"),
            F.col("hi").alias("test_mae"),
            none.alias("test_mse"),
            none.alias("test_rmse"),
        ).alias("metrics"),
        F.struct(
            F.lit(5).alias("cv_folds"), (F.col("big") / 4).alias("cv_mae_mean"), none.alias("cv_mae_std")
        ).alias("cross_validation"),
        F.col("n").alias("training_data_size"),
        F.lit(2).alias("feature_count"),
    )


@query(
    "src_json_metadata",
    """SELECT 'model_' || vendor AS model_name, count(*) AS training_data_size,
              min(amount) AS train_mae, max(amount) AS test_mae,
              (count(*) FILTER (amount > 100)) / 4 AS cv_mae_mean, 'lag_1_ride_count' AS first_feature
       FROM pickups GROUP BY vendor""",
)
def src_json_metadata(spark, sf):
    path = work_path(spark, "metadata")
    writers.write_model_metadata(_metadata(spark, sf), path)
    return readers.read_model_metadata(spark, path).select(
        "model_name",
        "training_data_size",
        F.col("metrics.train_mae").alias("train_mae"),
        F.col("metrics.test_mae").alias("test_mae"),
        F.col("cross_validation.cv_mae_mean").alias("cv_mae_mean"),
        F.col("feature_columns")[0].alias("first_feature"),
    )


@query(
    "src_json_payload",
    """SELECT event_id, value AS temperature, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity,
              CAST(2.5 AS DOUBLE) AS wind_speed, CAST(40 AS DOUBLE) AS cloud_cover_numeric,
              CASE WHEN event_type = 'error' THEN CAST(1.5 AS DOUBLE) ELSE 0 END AS amount_of_precipitation
       FROM events""",
)
def src_json_payload(spark, sf):
    e = v.table(spark, sf, "events")
    rain = F.when(F.col("event_type") == "error", F.lit(', "rain": {"1h": 1.5}')).otherwise(F.lit(""))
    payload = F.concat(
        F.lit('{"current": {"temp": '),
        F.col("value").cast("string"),
        F.lit(', "humidity": '),
        F.get_json_object("props", "$.k"),
        F.lit(', "wind_speed": 2.5, "clouds": 40'),
        rain,
        F.lit("}}"),
    )
    return e.select("event_id", payload.alias("payload")).select(
        "event_id", *[c.alias(n) for n, c in weather_from_json("payload").items()]
    )


@query(
    "src_latest_version",
    """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def src_latest_version(spark, sf):
    o = v.table(spark, sf, "orders")
    return readers.latest(
        o, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderdate", "o_totalprice"]
    )


@query(
    "src_name_parse",
    """SELECT c_custkey, nullif(regexp_extract(c_name, '(\\d+)', 1), '') AS token FROM customer""",
)
def src_name_parse(spark, sf):
    return v.table(spark, sf, "customer").select(
        "c_custkey", readers.period_from_name("c_name", r"(\d+)").alias("token")
    )


@query(
    "src_missing_policy",
    """SELECT g.hourly_timestamp, g.PULocationID FROM grid g
       ANTI JOIN counts c ON g.hourly_timestamp = c.hourly_timestamp AND g.PULocationID = c.PULocationID""",
)
def src_missing_policy(spark, sf):
    p = v.pickups(spark, sf)
    keys = v.zones(spark, sf).select(F.col("LocationID").alias(ZONE))
    wanted = zone_hours(keys, *hour_span(p, "pickup_ts"))
    return readers.plan_backfill(wanted, hourly_counts(p, "pickup_ts"), [HOUR, ZONE])


# -- sinks --------------------------------------------------------------------
def _ints(df, names=("is_weekend", "is_holiday", "is_rush_hour", "is_downtown")):
    return df.withColumns({n: F.col(n).cast("int") for n in names if n in df.columns})


@query(
    "snk_parquet_schema",
    "SELECT * REPLACE (CAST(ride_count AS INTEGER) AS ride_count) FROM featured",
)
def snk_parquet_schema(spark, sf):
    path = work_path(spark, "featured")
    writers.write_contract(v.featured_series(spark, sf), FEATURED, path)
    return _ints(readers.read_trips(spark, path))


@query("snk_csv", "SELECT hourly_timestamp, PULocationID, CAST(ride_count AS INTEGER) AS predicted_ride_count FROM series")
def snk_csv(spark, sf):
    path = work_path(spark, "predictions-csv")
    writers.write_csv(v.series(spark, sf).withColumnRenamed(COUNT, "predicted_ride_count"), path)
    return readers.read_csv(spark, path, T.StructType([PREDICTIONS[HOUR], PREDICTIONS[ZONE], PREDICTIONS["predicted_ride_count"]]))


UPSERT_SQL = """SELECT hourly_timestamp, PULocationID,
              CASE WHEN hourly_timestamp >= TIMESTAMP '2024-01-15' THEN ride_count + 1000 ELSE ride_count END AS ride_count,
              CAST(hourly_timestamp AS DATE) AS day
       FROM counts"""


def _older_and_newer(spark, sf):
    counts = hourly_counts(v.pickups(spark, sf), "pickup_ts")
    hour = F.col(HOUR)
    cut, end = F.expr("timestamp_ntz'2024-01-15 00:00:00'"), F.expr("timestamp_ntz'2024-01-20 00:00:00'")
    return counts.where(hour < end), counts.where(hour >= cut).withColumn(COUNT, F.col(COUNT) + 1000)


@query("snk_upsert_keep_last", UPSERT_SQL)
def snk_upsert_keep_last(spark, sf):
    """Two upserts into a table of snapshots."""
    table = SnapshotTable(spark, work_path(spark, "snapshots"))
    for rows in _older_and_newer(spark, sf):
        table.upsert(rows, [HOUR, ZONE], "day", F.to_date(HOUR))
    return table.read()


@query("snk_upsert_in_place", UPSERT_SQL)
def snk_upsert_in_place(spark, sf):
    path = work_path(spark, "store")
    for rows in _older_and_newer(spark, sf):
        writers.upsert(spark, path, rows, [HOUR, ZONE], "day", F.to_date(HOUR))
    return spark.read.parquet(path)


@query("snk_partitioned_by_key", "SELECT hourly_timestamp, PULocationID, ride_count FROM series")
def snk_partitioned_by_key(spark, sf):
    path = work_path(spark, "by-zone")
    writers.write_partitioned(v.series(spark, sf), path, [ZONE])
    return spark.read.parquet(path)


@query(
    "snk_row_target_partitions",
    """SELECT count(*) AS n_rows, CAST(sum(l_partkey) AS BIGINT) AS sum_partkey, 1 AS within_target FROM lineitem""",
)
def snk_row_target_partitions(spark, sf):
    path = work_path(spark, "sized")
    target = 10_000
    writers.write_sized(v.table(spark, sf, "lineitem"), path, target)
    per_file = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_partkey").alias("s")
    )
    return per_file.agg(
        F.sum("n").alias("n_rows"),
        F.sum("s").alias("sum_partkey"),
        (F.max("n") <= target).cast("int").alias("within_target"),
    )


@query(
    "snk_json_metadata",
    """SELECT 'model_' || vendor AS model_name, 'persistence' AS model_type, vendor AS kind,
              2 AS feature_count, count(*) AS training_data_size, 'target' AS target_column
       FROM pickups GROUP BY vendor""",
)
def snk_json_metadata(spark, sf):
    path = work_path(spark, "metadata-out")
    writers.write_model_metadata(_metadata(spark, sf), path)
    return readers.read_model_metadata(spark, path).select(
        "model_name",
        "model_type",
        F.try_element_at("parameters", F.lit("kind")).alias("kind"),
        "feature_count",
        "training_data_size",
        "target_column",
    )


@query(
    "snk_run_log",
    """SELECT 'run_' || vendor AS run_id, 'search' AS parent_run_id, 'param' AS kind, 'vendor' AS key,
              vendor AS value, CAST(1 AS BIGINT) AS logged_at FROM pickups GROUP BY vendor
       UNION ALL
       SELECT 'run_' || vendor, 'search', 'metric', 'rows', CAST(count(*) AS VARCHAR), CAST(2 AS BIGINT)
       FROM pickups GROUP BY vendor""",
)
def snk_run_log(spark, sf):
    path = work_path(spark, "run-log")
    runs = v.pickups(spark, sf).groupBy("vendor").agg(F.count(F.lit(1)).alias("n"))

    def entries(kind, key, value, at):
        return runs.select(
            F.concat(F.lit("run_"), F.col("vendor")).alias("run_id"),
            F.lit("search").alias("parent_run_id"),
            F.lit(kind).alias("kind"),
            F.lit(key).alias("key"),
            F.col(value).cast("string").alias("value"),
            F.lit(at).cast("long").alias("logged_at"),
        )

    writers.log_run(entries("param", "vendor", "vendor", 1), path)
    writers.log_run(entries("metric", "rows", "n", 2), path)
    return spark.read.schema(RUN_LOG).parquet(path)
