import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.names import HOUR, ZONE
from tidecast.operators import windows as w
from tidecast.operators.joins import on_calendar_parts
from tidecast.operators.grid import asof_backward, dense_hourly_counts, densify, hourly_counts, zone_hours

START = dt.datetime(2024, 1, 1)


def series(spark, values_by_zone, name="ride_count", kind="bigint"):
    rows = [
        (START + dt.timedelta(hours=i), z, x)
        for z, values in values_by_zone.items()
        for i, x in enumerate(values)
    ]
    return spark.createDataFrame(rows, f"{HOUR} timestamp_ntz, {ZONE} int, {name} {kind}")


def column(df, name, zone=1):
    return [r[name] for r in df.where(F.col(ZONE) == zone).orderBy(HOUR).collect()]


def test_rolling_without_current_row(spark):
    df = w.add_rolling(series(spark, {1: range(1, 7), 2: range(7, 13)}), [3])
    assert column(df, "rolling_mean_3h", 1) == [None, None, None, 2, 3, 4]
    assert column(df, "rolling_mean_3h", 2) == [None, None, None, 8, 9, 10]


def test_rolling_with_current_row(spark):
    df = w.add_rolling(
        series(spark, {1: range(1, 7), 2: range(7, 13)}), [3], include_current=True, min_periods=1
    )
    assert column(df, "rolling_mean_3h", 1) == [1, 1.5, 2, 3, 4, 5]
    assert column(df, "rolling_mean_3h", 2) == [7, 7.5, 8, 9, 10, 11]


def test_lags_do_not_cross_keys(spark):
    df = w.add_target(w.add_lags(series(spark, {1: [1, 2, 3], 2: [4, 5, 6]}), [1, 2]))
    assert column(df, "lag_1_ride_count", 2) == [None, 4, 5]
    assert column(df, "lag_2_ride_count", 1) == [None, None, 1]
    assert column(df, "target", 1) == [2, 3, None]


def test_fills(spark):
    df = series(spark, {1: [None, 1.0, None, 3.0, None]}, "x", "double")
    assert column(w.ffill(df, ["x"]), "x") == [None, 1, 1, 3, 3]
    assert column(w.bfill(df, ["x"]), "x") == [1, 1, 3, 3, None]
    assert column(w.fill_chain(df, {"x": 9.0}), "x") == [1, 1, 1, 3, 3]
    empty = series(spark, {1: [None, None]}, "x", "double")
    assert column(w.fill_chain(empty, {"x": 9.0}), "x") == [9, 9]


@pytest.mark.parametrize("block", ["day", "hour", "year"])
def test_blocked_fills_equal_plain_fills(spark, block):
    rng = random.Random(8)
    values = {z: [rng.choice([None, None, None, float(i)]) for i in range(200)] for z in (1, 2)}
    values[3] = [None] * 30
    df = series(spark, values, "x", "double")
    for fill in (w.ffill, w.bfill):
        plain, split = fill(df, ["x"]), fill(df, ["x"], block=block)
        assert plain.exceptAll(split).count() == 0 and split.count() == 430


def test_interpolation(spark):
    df = series(spark, {1: [None, 1.0, None, None, 4.0, None]}, "x", "double")
    assert column(w.interpolate(df, ["x"]), "x") == [None, 1, 2, 3, 4, 4]


def test_dedup_keeps_first_or_last_and_limits_before_the_shuffle(spark, plan_of):
    rows = [(1, "a", 3), (1, "b", 1), (1, "c", 2), (2, "d", 5)]
    df = spark.createDataFrame(rows, "k int, v string, o int")
    assert {r.v for r in w.dedup(df, ["k"], [F.asc("o")]).collect()} == {"b", "d"}
    last = w.dedup(df, ["k"], [F.desc("o")])
    assert {r.v for r in last.collect()} == {"a", "d"}
    assert "WindowGroupLimit" in plan_of(last)


@pytest.mark.parametrize(("sizes", "k"), [([7, 13, 2], 3), ([10], 4), ([5, 5, 5, 5], 5)])
def test_positional_folds_equal_sorted_positions(spark, sizes, k):
    df = series(spark, {z: range(n) for z, n in enumerate(sizes)})
    got = [r.fold for r in w.positional_folds(df, k).orderBy(ZONE, HOUR).collect()]
    n = sum(sizes)
    size = n // (k + 1)
    start = n - k * size
    assert got == [0 if i < start else (i - start) // size + 1 for i in range(n)]


def test_chronological_folds_share_cuts_between_zones(spark):
    df = series(spark, {1: range(20), 2: range(20)})
    folds = w.chronological_folds(df, 4)
    assert column(folds, "fold", 1) == column(folds, "fold", 2)
    assert column(folds, "fold", 1) == [0] * 4 + [1] * 4 + [2] * 4 + [3] * 4 + [4] * 4


def test_one_exchange_for_all_series_columns(spark, plan_of):
    from tidecast.plans.features import series_dataset

    plan = plan_of(series_dataset(series(spark, {1: range(40)})))
    assert plan.count("Exchange hashpartitioning") == 1


def test_dense_counts_equal_counts_joined_to_the_grid(spark):
    rng = random.Random(3)
    rows = [(START + dt.timedelta(seconds=rng.randrange(36_000)), rng.choice([1, 1, 1, 2, 9])) for _ in range(500)]
    events = spark.createDataFrame(rows, f"ts timestamp_ntz, {ZONE} int")
    zones = spark.createDataFrame([(1,), (2,), (3,)], f"{ZONE} int")
    bounds = [F.lit(START).cast("timestamp_ntz"), F.lit(START + dt.timedelta(hours=12)).cast("timestamp_ntz")]
    grid = zone_hours(zones, *bounds)
    assert grid.count() == 39
    joined = densify(hourly_counts(events, "ts"), grid)
    fused = dense_hourly_counts(events, "ts", grid)
    key = lambda df: sorted(map(tuple, df.select(HOUR, ZONE, "ride_count").collect()))
    assert key(joined) == key(fused)
    # zone 9 is not in the dimension
    assert sum(r[2] for r in key(fused)) == sum(1 for _, z in rows if z != 9)


@pytest.mark.parametrize("block", ["day", "hour", "year"])
def test_asof_equals_brute_force(spark, block):
    rng = random.Random(11)
    # key 0 holds most rows; times repeat; values contain NULL
    right = [
        (rng.choice([0, 0, 0, 0, 1, 2]), START + dt.timedelta(minutes=rng.randrange(0, 20_000, 10)), i, None if i % 7 == 0 else float(i))
        for i in range(400)
    ]
    left = [(k, START + dt.timedelta(minutes=m), m) for k in (0, 1, 2, 3) for m in range(0, 22_000, 250)]
    r = spark.createDataFrame(right, "k int, at timestamp_ntz, id int, v double")
    lf = spark.createDataFrame(left, "k int, t timestamp_ntz, m int")
    got = {
        (x.k, x.m): (x.id, x.v)
        for x in asof_backward(lf, r, ["k"], "t", "at", ["id", "v"], ["id"], block).collect()
    }
    assert len(got) == len(left)
    for k, t, m in left:
        older = [(at, i, v) for kk, at, i, v in right if kk == k and at <= t]
        want = max(older, key=lambda x: (x[0], x[1]))[1:] if older else (None, None)
        assert got[(k, m)] == want


def test_asof_without_keys(spark):
    r = spark.createDataFrame([(START, 1.0), (START + dt.timedelta(days=2), None)], "at timestamp_ntz, v double")
    lf = spark.createDataFrame([(START + dt.timedelta(days=d),) for d in range(4)], "t timestamp_ntz")
    out = asof_backward(lf, r, [], "t", "at", ["v"]).orderBy("t").collect()
    assert [x.v for x in out] == [1.0, 1.0, None, None]


def test_rolling_matches_numpy_on_a_long_series(spark):
    rng = np.random.default_rng(5)
    values = [int(x) for x in rng.integers(0, 50, 300)]
    df = w.add_rolling(series(spark, {1: values}), [24])
    got = column(df, "rolling_mean_24h")
    for i in range(24, 300):
        assert got[i] == pytest.approx(np.mean(values[i - 24 : i]))


def test_a_null_key_or_time_matches_nothing(spark):
    left = spark.sql(
        "SELECT * FROM VALUES (1, CAST(NULL AS INT), TIMESTAMP_NTZ'2024-01-01 10:00:00'), (2, 1, NULL),"
        " (3, 1, TIMESTAMP_NTZ'2024-01-02 10:00:00') AS t(id, k, at)"
    )
    right = spark.sql(
        "SELECT * FROM VALUES (CAST(NULL AS INT), TIMESTAMP_NTZ'2024-01-01 09:00:00', 5), (1, CAST(NULL AS TIMESTAMP_NTZ), 7) AS t(k, at, v)"
    )
    for grain in (None, "hour"):
        out = asof_backward(left, right, ["k"], "at", "at", ["v"], left_grain=grain)
        assert {(r.id, r.v) for r in out.collect()} == {(1, None), (2, None), (3, None)}


def test_reducing_to_the_left_grain_changes_nothing(spark):
    left = spark.sql("SELECT id % 3 AS k, TIMESTAMP_NTZ'2024-01-01' + make_interval(0, 0, 0, 0, CAST(id AS INT)) AS at FROM range(72)")
    right = spark.sql(
        "SELECT id % 2 AS k, TIMESTAMP_NTZ'2024-01-01' + make_interval(0, 0, 0, 0, 0, CAST(id * 37 % 4000 AS INT)) AS at, id AS v FROM range(600)"
    )
    plain = asof_backward(left, right, ["k"], "at", "at", ["v"], tie_break=["v"])
    reduced = asof_backward(left, right, ["k"], "at", "at", ["v"], tie_break=["v"], left_grain="hour")
    assert plain.exceptAll(reduced).count() == 0 and reduced.exceptAll(plain).count() == 0 and plain.where("v is not null").count() > 20


def test_blocked_fills_equal_the_plain_ones(spark):
    df = spark.sql(
        f"SELECT CAST(id % 2 AS INT) AS {ZONE}, TIMESTAMP_NTZ'2024-01-01' + make_interval(0, 0, 0, CAST(id AS INT)) AS {HOUR},"
        " CASE WHEN id % 7 = 3 OR id BETWEEN 80 AND 200 THEN NULL WHEN id < 9 THEN NULL ELSE CAST(id * id AS DOUBLE) END AS x FROM range(260)"
    )
    for fill in (
        lambda b: w.bfill(df, ["x"], block=b), lambda b: w.ffill(df, ["x"], block=b),
        lambda b: w.fill_chain(df, {"x": 1.0}, block=b), lambda b: w.interpolate(df, ["x"], block=b),
    ):
        one, other = fill(None), fill("month")
        assert one.columns == df.columns == other.columns
        assert one.exceptAll(other).count() == 0 and other.exceptAll(one).count() == 0


def test_no_frame_ends_at_the_last_row(spark, plan_of):
    df = spark.sql(f"SELECT 1 AS {ZONE}, TIMESTAMP_NTZ'2024-01-01' AS {HOUR}, 1.0D AS x")
    for out in (w.bfill(df, ["x"]), w.fill_chain(df, {"x": 0.0}), w.interpolate(df, ["x"])):
        assert "unboundedfollowing" not in plan_of(out).lower().replace(" ", "")


def test_two_years_of_weather_do_not_multiply_rows(spark):
    fact = spark.sql("SELECT TIMESTAMP_NTZ'2024-05-01 10:30:00' AS t")
    hourly = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ'2022-05-01 10:00:00', 1), (TIMESTAMP_NTZ'2023-05-01 10:00:00', 2) AS t(h, x)")
    assert [r.x for r in on_calendar_parts(fact, hourly, "t", "h").collect()] == [2]
