"""Plan shape and skew: what must hold when the data is large and one key is hot."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidecast.names import HOUR, ZONE
from tidecast.operators import windows as w
from tidecast.operators.grid import hourly_counts
from tidecast.workload import views as v

SF = "/root/testdata/sf0.001"
START = dt.datetime(2024, 1, 1)

CHECKED = [
    "agg_hourly_counts", "dq_clean_trips", "dq_funnel", "feat_series_dataset", "feat_store_build",
    "flt_either_zone", "join_asof_backward", "join_cross_grid", "join_grid_left", "agg_error_by_dim",
    "join_zone_lookup", "win_dedup_last", "agg_histogram",
]


@pytest.mark.parametrize("name", CHECKED)
def test_no_cross_joins(spark, plan_of, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_time_filter_and_columns_reach_the_scan(spark, plan_of):
    plan = plan_of(entry.queries()["flt_time_range"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_counts_shuffle_once_after_a_partial_aggregate(spark, plan_of):
    plan = plan_of(hourly_counts(v.pickups(spark, SF), "pickup_ts"))
    assert plan.count("Exchange") == 1
    assert "partial_count" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan


def test_slices_read_the_errors_once(spark, plan_of):
    e = v.stored_errors(spark, SF)
    from tidecast.plans.analysis import slice_report

    plan = plan_of(slice_report(e))
    assert plan.count("FileScan") == 1 and "Expand" in plan


def _skewed(spark, n=300_000):
    """A third of all rows belong to one zone and a sixth to one hour of it."""
    hot = F.col("id") < n // 3
    return spark.range(n).select(
        F.col("id"),
        F.when(hot, F.lit(1)).otherwise((F.col("id") % 50).cast("int")).alias(ZONE),
        (
            F.lit(START).cast("timestamp_ntz")
            + F.make_dt_interval(F.lit(0), F.lit(0), F.when(F.col("id") < n // 6, 5).otherwise((F.col("id") % 1000).cast("int")))
        ).alias("ts"),
    )


def test_hot_zone_counts_are_whole(spark):
    df = _skewed(spark)
    counted = hourly_counts(df, "ts")
    assert counted.agg(F.sum("ride_count")).first()[0] == 300_000
    direct = df.where(F.col(ZONE) == 1).count()
    assert counted.where(F.col(ZONE) == 1).agg(F.sum("ride_count")).first()[0] == direct


def test_hot_zone_dedup_sends_one_row_per_task(spark):
    df = _skewed(spark)
    got = w.dedup(df, [ZONE], [F.desc("id")])
    assert got.count() == 50
    assert got.where(F.col(ZONE) == 1).first().id == df.where(F.col(ZONE) == 1).agg(F.max("id")).first()[0]


def test_folds_and_windows_are_bounded_by_the_calendar(spark):
    """After counting, every zone has the same number of rows, however hot it was."""
    from tidecast.plans.features import hourly_series

    zones = spark.range(50).select(F.col("id").cast("int").alias("LocationID"))
    sizes = hourly_series(_skewed(spark), "ts", zones).groupBy(ZONE).count()
    assert sizes.select("count").distinct().count() == 1


def test_registry_is_complete():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    assert len(queries) >= 165 and len(oracles) >= 145
    assert HOUR in oracles["agg_hourly_counts"]
