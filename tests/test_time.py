import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidecast.functions import timeutil as t

NTZ = "ts timestamp_ntz"


@pytest.mark.parametrize(
    ("at", "hour"),
    [
        ("2024-01-10 00:29:59", "2024-01-10 00:00:00"),
        ("2024-01-10 00:30:00", "2024-01-10 00:00:00"),
        ("2024-01-10 01:30:00", "2024-01-10 02:00:00"),
        ("2024-01-10 02:30:00", "2024-01-10 02:00:00"),
        ("2024-01-10 02:30:00.000001", "2024-01-10 03:00:00"),
        ("2024-01-31 23:45:00", "2024-02-01 00:00:00"),
        ("2024-01-31 23:30:00", "2024-02-01 00:00:00"),
    ],
)
def test_nearest_hour_ties_go_to_even_hours(spark, ts, at, hour):
    df = spark.createDataFrame([(ts(at),)], NTZ)
    assert df.select(t.hour_bucket("ts")).first()[0] == ts(hour)


def test_nearest_hour_equals_pandas_round(spark):
    step = dt.timedelta(minutes=7, seconds=30)
    stamps = [dt.datetime(2023, 12, 31, 20) + i * step for i in range(2000)]
    got = spark.createDataFrame([(s,) for s in stamps], NTZ).select("ts", t.hour_bucket("ts").alias("h")).toPandas()
    assert (got.h == got.ts.dt.round("h")).all()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_buckets_do_not_depend_on_the_session_zone(spark, ts, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:xx does not exist in New York on this day
        df = spark.createDataFrame([("2024-03-10 02:45:10",)], "s string").select(
            F.col("s").cast("timestamp_ntz").alias("ts")
        )
        row = df.select(
            t.hour_bucket("ts").cast("string"),
            t.hour_bucket("ts", "floor").cast("string"),
            t.epoch_seconds("ts"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == ("2024-03-10 03:00:00", "2024-03-10 02:00:00", 1710038710)


def _holidays(spark, year, **kw):
    days = spark.sql(f"select explode(sequence(date'{year}-01-01', date'{year}-12-31')) as d")
    return sorted(r.d.strftime("%m-%d") for r in days.where(t.is_us_holiday("d", **kw)).collect())


def test_holidays_2019(spark):
    assert _holidays(spark, 2019) == [
        "01-01", "01-21", "02-18", "05-27", "07-04", "09-02", "10-14", "11-11", "11-28", "12-25",
    ]


def test_holidays_equal_the_public_federal_calendar(spark):
    from pandas.tseries.holiday import USFederalHolidayCalendar

    days = spark.sql("select explode(sequence(date'2014-01-01', date'2030-12-31')) as d")
    got = {r.d for r in days.where(t.is_us_holiday("d")).collect()}
    want = {d.date() for d in USFederalHolidayCalendar().holidays("2014-01-01", "2030-12-31")}
    assert got == want


def test_holidays_with_actual_dates(spark):
    # Veterans Day 2018 was a Sunday: observed on the 12th
    both = _holidays(spark, 2018, include_actual=True)
    assert "11-11" in both and "11-12" in both
    assert "11-11" not in _holidays(spark, 2018)


def test_interval_helpers(spark, ts):
    df = spark.createDataFrame([(ts("2024-02-10 05:10:00"),)], NTZ)
    row = df.select(
        t.month_end_hour("ts"), t.plus_hours("ts", -6), t.hours_between(F.col("ts"), t.plus_hours("ts", 49))
    ).first()
    assert tuple(row) == (ts("2024-02-29 23:00:00"), ts("2024-02-09 23:10:00"), 49)


def test_calendar_features(spark, ts):
    df = spark.createDataFrame([(ts("2024-01-15 08:00:00"),), (ts("2024-01-20 08:00:00"),)], NTZ)
    rows = df.select(*[c.alias(n) for n, c in t.calendar_features("ts").items()]).collect()
    assert rows[0].asDict() == {
        "hour_of_day": 8, "day_of_week": 0, "day_of_month": 15, "is_weekend": 0, "is_holiday": 1, "is_rush_hour": 1,
    }
    assert (rows[1].is_weekend, rows[1].is_rush_hour) == (1, 0)


def test_weekday_matches_pandas(spark):
    stamps = pd.date_range("2024-02-25", periods=14, freq="D")
    got = spark.createDataFrame([(s.to_pydatetime(),) for s in stamps], NTZ).select("ts", t.week_day("ts").alias("w"))
    assert all(r.w == r.ts.weekday() for r in got.collect())
