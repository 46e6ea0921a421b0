"""What a query shuffles, and how its plan grows, where a larger table would not fit."""

import itertools
import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidecast.names import HOUR, TARGET, ZONE
from tidecast.operators.quality import drop_all_null
from tidecast.plans import training
from tidecast.sources.contracts import DATASET_FEATURES
from tidecast.workload import q_learning
from tidecast.workload import views as v

SF = "/root/testdata/sf0.001"


def test_distinct_keys_are_counted_without_a_sketch_for_every_key(spark, plan_of):
    plan = plan_of(entry.queries()["agg_distinct_keys"](spark, SF))
    assert "Expand" not in plan
    # the sketch is merged from one row a task; no aggregate by key carries it
    by_key = [line for line in plan.splitlines() if "Aggregate(keys=[l_" in line]
    assert by_key and not any("approx_count_distinct" in line for line in by_key)


def below(plan: str, start: str) -> str:
    """The lines of a plan tree under the first one with ``start``."""
    lines = plan.splitlines()
    first = next(i for i, line in enumerate(lines) if start in line)
    depth = lines[first].index(start)
    under = itertools.takewhile(lambda line: re.match(r"[\s:+-]*", line).end() > depth, lines[first + 1 :])
    return "\n".join(under)


def test_lines_are_not_dealt_by_customer(spark):
    plan = v.trips(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in below(plan, "Join Inner, (o_custkey")


def test_cleaning_reads_lines_from_the_start_on(spark, plan_of):
    plan = plan_of(entry.queries()["dq_clean_trips"](spark, SF))
    assert "GreaterThanOrEqual(l_shipdate,1996-01-01T00:00" in plan


def test_funnel_deals_one_number_instead_of_values(spark):
    plan = entry.queries()["dq_funnel"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    meeting = below(plan, "Join Inner, (l_orderkey")
    assert "__values_passed" in meeting
    dealt = next(line for line in meeting.splitlines() if "Project [" in line)
    assert "l_extendedprice" not in dealt.split("CASE")[0] and "store_and_fwd_flag" not in dealt


def test_empty_columns_are_found_without_the_whole_table(spark):
    """A row beyond the few given ones fails when it is read; null and absent columns take no look at it."""
    df = spark.range(100).select(
        "id", F.when(F.col("id") < 5, F.col("id")).otherwise(F.raise_error(F.lit("read")).cast("long")).alias("x"), F.lit(None).cast("double").alias("e")
    )
    assert drop_all_null(df, few=df.where("id < 5")).columns == ["id", "x"]
    whole = spark.createDataFrame([(1, None, None), (2, 3.0, None)], "a int, b double, c double")
    assert drop_all_null(whole, few=whole.where("a = 1")).columns == ["a", "b"]
    assert drop_all_null(whole, few=whole.select("a")).columns == ["a", "b"]
    assert drop_all_null(whole.where("a > 5")).columns == []


def test_later_hours_add_no_partition_to_the_training_side(spark, monkeypatch):
    hour = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))
    values = [F.lit(1.0).alias(c) for c in [*DATASET_FEATURES, TARGET]]
    rows = spark.range(60_000, numPartitions=8).select("id", hour.alias(HOUR), F.lit(1).alias(ZONE), *values)
    monkeypatch.setattr(v, "dataset", lambda *_: rows)
    train, test = q_learning._vectors(spark, SF)
    assert (train.count(), test.count()) == (22 * 24, 60_000 - 22 * 24)
    assert train.rdd.getNumPartitions() == 1


def test_a_search_trains_on_few_partitions_and_is_logged_at_once(spark, monkeypatch, tmp_path):
    hour = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))
    rows = spark.range(12_000).select(hour.alias(HOUR), F.lit(1).alias("zone"), (F.col("id") % 24).alias("x"), (F.col("id") % 7).alias(TARGET))
    seen, search = [], training.searched

    def watched(estimator, vectors, *rest):
        seen.append(vectors.rdd.getNumPartitions())
        return search(estimator, vectors, *rest)

    monkeypatch.setattr(training, "searched", watched)
    sets = training.Search([{"maxIter": 1, "maxDepth": d} for d in (1, 2, 3)])
    cut = F.lit("2024-12-31").cast("timestamp_ntz")
    training.train(rows, ["x"], cut, str(tmp_path), "m", search=sets, n_folds=2)
    assert seen == [1]
    files = list((tmp_path / "runs").glob("part-*.parquet"))
    assert len({re.sub(r"^part-\d+-|-c\d+.*$", "", f.name) for f in files}) == 1
    assert spark.read.parquet(str(tmp_path / "runs")).select("run_id").distinct().count() == 3
