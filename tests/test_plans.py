"""The stages end to end on a small raw trip table with the published columns."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidecast.names import COUNT, HOUR, TARGET, ZONE
from tidecast.plans import features, ingest, weather
from tidecast.sources import contracts, writers

START, HOURS = dt.datetime(2019, 1, 1), 24 * 4
ZONES = [4, 12, 113, 230]


def ntz(moment):
    return F.lit(moment).cast("timestamp_ntz")


@pytest.fixture(scope="module")
def home(spark):
    rows = [(z, "Manhattan", f"name {z}", "Yellow") for z in ZONES]
    return spark.createDataFrame(rows, contracts.ZONE_LOOKUP)


@pytest.fixture(scope="module")
def trips(spark):
    rng = random.Random(9)
    rows = []
    for i in range(4000):
        t = START + dt.timedelta(seconds=rng.randrange(HOURS * 3600 - 1800))
        rows.append(
            (
                t,
                t + dt.timedelta(minutes=rng.choice([5, 10, -3])),
                rng.choice([1, 2, 2, 4]),
                rng.choice([1, 1, 1, 99]),
                rng.choice([*ZONES, 200, None]),
                rng.choice([*ZONES, 200]),
                rng.choice([1, 2]),
                rng.choice([1.0, 2.0, None, 9.0]),
                rng.choice([1.5, 3.0, None, 400.0]),
                rng.choice([10.0, 20.0, None, -5.0]),
                rng.choice([0.0, 1.0, float("nan")]),
                0.0,
                rng.choice([12.0, 22.0, None]),
                rng.choice([2.5, None]),
                "N",
            )
        )
    return spark.createDataFrame(rows, contracts.RAW_TRIP).persist()


@pytest.fixture(scope="module")
def obs(spark):
    cols = "observed_at timestamp_ntz, temperature double, humidity double, wind_speed double, cloud_cover string, amount_of_precipitation string"
    rows = [(START, 1.0, 80.0, 3.0, "no clouds", "Trace of precipitation"), (START + dt.timedelta(hours=30), None, 70.0, 2.0, "?", None)]
    return spark.createDataFrame(rows, cols)


@pytest.fixture(scope="module")
def clean(trips, home):
    end = ntz(START + dt.timedelta(hours=HOURS))
    return ingest.clean_trips(trips, home, "LocationID", ntz(START), end).persist()


def test_cleaning_equals_a_row_by_row_check(trips, home, clean):
    end = START + dt.timedelta(hours=HOURS)
    rows = trips.collect()
    basis = [
        r
        for r in rows
        if START <= r.tpep_pickup_datetime <= end
        and (r.PULocationID in ZONES or r.DOLocationID in ZONES)
        and r.tpep_dropoff_datetime >= r.tpep_pickup_datetime
        and r.PULocationID is not None
    ]

    def median(name):
        values = sorted(r[name] for r in basis if r[name] is not None)
        n = len(values)
        return (values[(n - 1) // 2] + values[n // 2]) / 2

    med = {c: median(c) for c in ("passenger_count", "trip_distance", "fare_amount", "total_amount")}

    def value(r, c):
        return med[c] if r[c] is None else r[c]

    kept = [
        r
        for r in basis
        if r.VendorID in (1, 2)
        and r.RatecodeID in range(1, 7)
        and 0 <= value(r, "trip_distance") <= 100
        and 0 <= value(r, "passenger_count") <= 6
        and 0 <= value(r, "fare_amount") <= 1000
        and 0 <= value(r, "total_amount") <= 1000
        and r.tip_amount == r.tip_amount
        and r.tip_amount >= 0
    ]
    assert clean.count() == len(kept) > 0
    assert clean.where("congestion_surcharge is null or fare_amount is null").count() == 0
    total = clean.agg(F.sum("fare_amount")).first()[0]
    assert total == pytest.approx(sum(value(r, "fare_amount") for r in kept))
    funnel = ingest.cleaning_funnel(trips, home, "LocationID", ntz(START), ntz(end)).orderBy("step").collect()
    assert (funnel[0].rows, funnel[-1].rows) == (len(rows), len(kept))
    assert all(a.rows >= b.rows for a, b in zip(funnel, funnel[1:]))


def test_approximate_medians_give_the_same_rows_here(trips, home, clean):
    end = ntz(START + dt.timedelta(hours=HOURS))
    approx = ingest.clean_trips(trips, home, "LocationID", ntz(START), end, exact_medians=False)
    assert approx.count() == clean.count()


def test_dataset_rows_and_contracts(spark, clean, home, obs, tmp_path):
    last = START + dt.timedelta(hours=HOURS - 1)
    hourly = weather.weather_by_hour(obs, "observed_at", ["observed_at"])
    series = features.hourly_series(clean, "tpep_pickup_datetime", home, start=ntz(START), end=ntz(last))
    assert series.count() == len(ZONES) * HOURS
    base = features.featured(series, hourly)
    dataset = features.series_dataset(base)
    # the first 24 hours lack history, the last one a target
    assert dataset.count() == len(ZONES) * (HOURS - 24 - 1)
    writers.write_contract(dataset, contracts.DATASET, str(tmp_path / "d"))
    back = spark.read.parquet(str(tmp_path / "d"))
    assert back.columns == contracts.DATASET.names and dict(back.dtypes)["is_weekend"] == "tinyint"
    assert contracts.conform(features.add_interactions(base), contracts.ENHANCED).count() == series.count()
    row = back.orderBy(ZONE, HOUR).first()
    follow = series.where((F.col(ZONE) == row[ZONE]) & (F.col(HOUR) == row[HOUR] + dt.timedelta(hours=1))).first()
    assert row[TARGET] == follow[COUNT]


def test_weather_carries_the_row_and_fills_columns(obs):
    rows = weather.weather_by_hour(obs, "observed_at", ["observed_at"]).orderBy(HOUR).collect()
    assert len(rows) == 31
    assert (rows[29].temperature, rows[29].cloud_cover_numeric, rows[29].amount_of_precipitation) == (1.0, 0.0, 0.1)
    # the last hour has its own row: unknown temperature is filled, unknown cloud text has a default
    assert (rows[30].temperature, rows[30].humidity, rows[30].cloud_cover_numeric) == (1.0, 70.0, 75.0)
    assert rows[30].amount_of_precipitation == 0.0


def test_feature_store_contract_and_next_hour(clean, home, obs):
    end = START + dt.timedelta(hours=48)
    hourly = weather.weather_by_hour(obs, "observed_at", ["observed_at"], zero_head=True)
    store = features.feature_store(clean, "tpep_pickup_datetime", home, hourly, ntz(START), ntz(end)).persist()
    kept = contracts.conform(store, contracts.FEATURE_STORE)
    assert kept.count() == len(ZONES) * 49
    parity = features.next_hour_rows(store, home, None, mode="parity").collect()
    newest = {r[ZONE]: r for r in store.where(F.col(HOUR) == ntz(end)).collect()}
    assert len(parity) == len(ZONES)
    for r in parity:
        assert r[HOUR] == end + dt.timedelta(hours=1)
        assert r.lag_1_ride_count == newest[r[ZONE]][COUNT]
        assert r.rolling_mean_24h == newest[r[ZONE]].rolling_mean_24h
        assert r.is_downtown == int(r[ZONE] in (113, 230))
    store.unpersist()


def test_observed_zones_only(clean, home, spark):
    more = home.unionByName(spark.createDataFrame([(77, "Manhattan", "quiet", "Yellow")], contracts.ZONE_LOOKUP))
    everything = features.hourly_series(clean, "tpep_pickup_datetime", more)
    observed = features.hourly_series(clean, "tpep_pickup_datetime", more, only_observed=True)
    assert everything.select(ZONE).distinct().count() == 5
    assert observed.select(ZONE).distinct().count() == 4


def test_cleaning_starts_no_job_and_reads_trips_twice(spark, trips, home, tmp_path, plan_of):
    path = str(tmp_path / "trips")
    trips.write.parquet(path)
    stored, end = spark.read.schema(trips.schema).parquet(path), ntz(START + dt.timedelta(hours=HOURS))
    sc = spark.sparkContext
    sc.setJobGroup("build-clean", "build")
    try:
        cleaned = ingest.clean_trips(stored, home, "LocationID", ntz(START), end)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert not sc.statusTracker().getJobIdsForGroup("build-clean")
    assert len(cleaned.collect()) > 0
    assert plan_of(cleaned).split("== Initial Plan ==")[0].count("FileScan parquet") <= 2


def test_columns_without_a_value_go(trips, home, clean):
    end = ntz(START + dt.timedelta(hours=HOURS))
    wider = trips.withColumn("airport_fee", F.lit(None).cast("double"))
    got = ingest.clean_trips(wider, home, "LocationID", ntz(START), end, drop_empty=True)
    assert got.columns == clean.columns
    assert got.exceptAll(clean).count() == 0 and clean.exceptAll(got).count() == 0
