import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.functions import scalars as S
from tidecast.operators import aggregates as a
from tidecast.operators import quality as q
from tidecast.operators import quantiles


def test_nan_is_dropped_by_one_sided_rules(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (-1.0,)], "tip double")
    assert df.where("tip >= 0").count() == 2  # Spark alone keeps NaN
    assert q.normalise_nan(df).where("tip >= 0").count() == 1


def test_funnel_counts_and_retention(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(12)], "x int, y int")
    rules = [("small", F.col("x") < 9), ("not_zero", F.col("y") != 0), ("none", F.lit(False))]
    rows = {r.rule: (r.step, r.rows, r.retention_pct) for r in q.quality_funnel(df, rules).collect()}
    assert rows == {
        "input": (0, 12, 100.0), "small": (1, 9, 75.0), "not_zero": (2, 6, 50.0), "none": (3, 0, 0.0),
    }


def test_funnel_of_an_empty_table(spark):
    df = spark.createDataFrame([], "x int")
    assert {r.rule: r.rows for r in q.quality_funnel(df, [("r", F.col("x") > 0)]).collect()} == {"input": 0, "r": 0}


def test_null_rule_drops_the_row(spark):
    df = spark.createDataFrame([(None,), (1,)], "x int")
    rules = [("known", F.col("x") > 0)]
    assert q.apply_rules(df, rules).count() == 1
    assert q.violations(df, rules).first().n_violations == 1


def test_expect(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    with pytest.raises(q.ExpectationError):
        q.expect(df, [("x", F.col("x").isNotNull())])
    with pytest.raises(q.ExpectationError):
        q.expect(df.limit(0), [])
    assert q.expect(df, [("any", F.lit(True))]) is df


def test_either_zone_is_an_or_of_memberships(spark):
    trips = spark.createDataFrame([(1, 5), (5, 1), (5, 6), (None, 1), (1, 1), (None, None)], "pu int, do int")
    zones = spark.createDataFrame([(1,), (2,), (1,)], "z int")
    got = sorted((r.pu or 0, r.do) for r in q.either_in(trips, ["pu", "do"], zones, "z").collect())
    assert got == [(0, 1), (1, 1), (1, 5), (5, 1)]


def test_impute_median_uses_the_basis(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (100.0,), (None,)], "x double")
    filled = q.impute_median(df, ["x"], df.where("x < 50"))
    assert sorted(r.x for r in filled.collect()) == [1, 2, 2, 3, 100]
    nothing = spark.createDataFrame([(None,)], "x double")
    assert q.impute_median(nothing, ["x"]).first().x is None


def test_drop_all_null(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, 3)], "a int, b int, c int")
    assert q.drop_all_null(df).columns == ["a", "c"]
    assert q.drop_all_null(df, probe_rows=1).columns == ["a", "c"]
    assert q.drop_all_null(df.where("a > 5")).columns == []


@pytest.mark.parametrize("kind", ["normal", "few_values", "one_value", "heavy_tail", "tiny", "hot_value"])
@pytest.mark.parametrize("steps", [4096, 1])
def test_exact_quantiles_equal_numpy(spark, monkeypatch, kind, steps):
    # few places leave many values in each, many leave ranks in neighbouring ones
    monkeypatch.setattr(quantiles, "STEPS", steps)
    rng = np.random.default_rng(7)
    values = {
        "normal": rng.normal(size=5000),
        "few_values": rng.integers(0, 4, 5000).astype(float),
        "one_value": np.full(100, 3.5),
        "heavy_tail": rng.pareto(0.5, 5000),
        "tiny": np.array([4.0, 1.0]),
        "hot_value": np.where(rng.random(5000) < 0.34, 1.25, rng.normal(size=5000)),
    }[kind]
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    rows = [(float(x), float(-x)) for x in values] + [(None, None)]
    df = spark.createDataFrame(rows, "x double, y double").repartition(5)
    got = {r["column"]: r for r in quantiles.exact_quantiles(df, ["x", "y"], probs).collect()}
    for name, data in (("x", values), ("y", -values)):
        assert got[name].n == len(values)
        for i, p in enumerate(probs):
            assert got[name][f"q{i}"] == pytest.approx(np.quantile(data, p), abs=1e-9)


def test_describe(spark):
    values = [float(x) for x in range(1, 11)]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    r = quantiles.describe(df, ["x"]).first()
    assert (r["count"], r.mean, r.min, r.p25, r.p50, r.p75, r.max) == (10, 5.5, 1, 3.25, 5.5, 7.75, 10)
    assert r["std"] == pytest.approx(np.std(values, ddof=1))


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "x double")
    assert [r[0] for r in df.select(S.round_half_even("x")).collect()] == [0, 2, 2, 0]


def test_clean_numeric_and_recode(spark):
    df = spark.createDataFrame([("Trace",), ("1.5",), ("x",), (None,), ("NaN",)], "s string")
    got = [tuple(r) for r in df.select(S.clean_numeric("s", {"Trace": 0.1}), S.recode("s", {"x": 7}, 9)).collect()]
    assert got == [(0.1, 9), (1.5, 9), (0.0, 7), (0.0, 9), (0.0, 9)]


def test_weather_payload(spark):
    rows = [
        ('{"current": {"temp": 3.5, "humidity": 80, "wind_speed": 1, "clouds": 20, "rain": {"1h": 0.4}}}',),
        ('{"current": {"temp": 3.5, "humidity": 80, "wind_speed": 1, "clouds": 20}}',),
    ]
    df = spark.createDataFrame(rows, "j string")
    got = df.select(*[c.alias(n) for n, c in S.weather_from_json("j").items()]).collect()
    assert [r.amount_of_precipitation for r in got] == [0.4, 0.0]
    assert got[0].temperature == 3.5


def test_regression_metrics(spark):
    rng = np.random.default_rng(1)
    y, p = rng.normal(size=50), rng.normal(size=50)
    df = spark.createDataFrame([(float(i), float(j)) for i, j in zip(y, p)], "actual double, predicted double")
    m = a.regression_metrics(df).first()
    assert m.mae == pytest.approx(np.abs(y - p).mean())
    assert m.rmse == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert m.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_error_slices_keep_null_values_apart_from_other_dimensions(spark):
    df = spark.createDataFrame([(1, None, 2.0), (1, 5, 4.0), (2, 5, 6.0)], "a int, b int, absolute_error double")
    got = {(r.dim, r.value): (r.n, r.mean_error) for r in a.error_slices(df, ["a", "b"]).collect()}
    assert got == {("a", "1"): (2, 3.0), ("a", "2"): (1, 6.0), ("b", None): (1, 2.0), ("b", "5"): (2, 5.0)}


def test_histogram_per_group_and_density(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(10)] + [("b", 1.0)] * 3, "g string, x double")
    got = {(r.g, r.bin): r.n for r in a.histogram(df, "x", 5, by=["g"]).collect()}
    assert got == {**{("a", i): 2 for i in range(5)}, ("b", 0): 3}
    rng = random.Random(2)
    sample = spark.createDataFrame([(rng.gauss(0, 1),) for _ in range(3000)], "x double")
    curve = a.density(sample, "x").orderBy("point").collect()
    area = sum((p.x - q.x) * (p.density + q.density) / 2 for q, p in zip(curve, curve[1:]))
    assert area == pytest.approx(1.0, abs=0.02)


def test_no_shift_without_change(spark):
    rng = random.Random(4)
    rows = [(float(rng.randrange(100)), rng.random() < 0.5) for _ in range(4000)]
    df = spark.createDataFrame(rows, "x double, c boolean")
    assert a.population_shift(df, "x", F.col("c")).agg(F.sum("psi")).first()[0] < 0.05
    moved = df.withColumn("x", F.when(F.col("c"), F.col("x") + 60).otherwise(F.col("x")))
    assert a.population_shift(moved, "x", F.col("c")).agg(F.sum("psi")).first()[0] > 1


def test_hash_split_is_stable_and_near_the_share(spark):
    from tidecast.learning.search import split_random

    df = spark.range(20_000)
    train, test = split_random(df, ["id"])
    assert train.count() + test.count() == 20_000
    assert abs(train.count() / 20_000 - 0.67) < 0.02
    again, _ = split_random(df.repartition(13).orderBy(F.desc("id")), ["id"])
    assert train.exceptAll(again).count() == 0


def test_places_never_fall(spark):
    tiny = 5e-324
    near = [x for k in range(-1074, 1024, 7) for x in (np.nextafter(2.0**k, 0), 2.0**k, np.nextafter(2.0**k, np.inf))]
    values = sorted({float(x) for x in [*near, 0.0, tiny, 1.5, 1e308, float("inf"), *np.random.default_rng(2).lognormal(0, 20, 500)]})
    values = [-x for x in reversed(values)] + values
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double")
    places = [r.p for r in df.select("i", quantiles._place(F.col("x")).alias("p")).orderBy("i").collect()]
    assert places == sorted(places)


def test_exact_quantiles_per_key_with_a_hot_one(spark):
    rng = np.random.default_rng(4)
    rows = [("hot", float(x)) for x in rng.normal(size=4000)] + [(None, 1.0), (None, 4.0), ("a", None), ("b", float("nan")), ("b", 2.0)]
    df = spark.createDataFrame(rows, "key string, x double").repartition(6)
    got = {r.key: r for r in quantiles.exact_quantiles(df, ["x"], [0.5, 0.9], ["key"]).collect()}
    hot = [x for k, x in rows if k == "hot"]
    assert set(got) == {"hot", None, "b"}
    assert got["hot"].n == 4000 and got["hot"].q0 == pytest.approx(np.median(hot)) and got["hot"].q1 == pytest.approx(np.quantile(hot, 0.9))
    assert (got[None].n, got[None].q0, got["b"].n, got["b"].q0) == (2, 2.5, 1, 2.0)


def jobs_of(spark, build):
    """Jobs that building a frame starts."""
    group = f"build-{build.__name__}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        df = build()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return df, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_medians_start_no_job_and_read_their_basis_once(spark, tmp_path, plan_of):
    path = str(tmp_path / "t")
    spark.range(5000).selectExpr("id", "if(id % 7 = 0, null, cast(id % 97 as double)) as x", "cast(id as double) as y").write.parquet(path)

    def build():
        return q.impute_median(spark.read.schema("id long, x double, y double").parquet(path), ["x", "y"])

    df, jobs = jobs_of(spark, build)
    assert jobs == 0
    assert df.agg(F.sum("x")).first()[0] > 0
    plan = df.select("x", "y")
    plan.collect()
    text = plan_of(plan).split("== Initial Plan ==")[0]
    assert text.count("FileScan parquet") <= 2 and "ReusedExchange" in text


def test_bias_of_a_hot_key(spark):
    rows = [(1, float(i), float(i + i % 5)) for i in range(2001)] + [(2, 1.0, 3.0), (None, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "z int, actual double, predicted double")
    got = {r.z: (r.n, r.mean_bias, r.median_bias) for r in a.bias(df, ["z"], "actual", "predicted").collect()}
    errors = [i % 5 for i in range(2001)]
    assert got == {1: (2001, pytest.approx(sum(errors) / 2001), 2.0), 2: (1, 2.0, 2.0), None: (1, -1.0, -1.0)}
