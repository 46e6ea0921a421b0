import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators import aggregates as a
from tidecast.operators import sketches

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(6)
    rows = [(DAY + dt.timedelta(days=int(d)), float(x) + (3.0 if d >= 5 else 0.0), int(u)) for d, x, u in zip(rng.integers(0, 10, 6000), rng.normal(size=6000), rng.integers(0, 900, 6000))]
    rows += [(DAY, None, None), (DAY, float("nan"), 1), (DAY + dt.timedelta(days=20), None, 5)]
    return spark.createDataFrame(rows, "day date, x double, u int").repartition(4).persist()


@pytest.fixture(scope="module")
def stored(spark, table, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sketches") / "s")
    sketches.period_sketches(table, F.col("day"), ["x"], ["u"]).write.parquet(path)
    return spark.read.parquet(path)


def test_stored_periods_merge_to_the_whole(table, stored):
    assert stored.count() == 22
    got = {r.column: r for r in sketches.estimates(stored, [0.1, 0.5]).collect()}
    values = sorted(r.x for r in table.where("x is not null and not isnan(x)").collect())
    x = got["x"]
    assert (x.periods, x.n, x.n_null, x.lo, x.hi, x.n_distinct) == (11, 6000, 3, values[0], values[-1], None)
    for q, p in ((x.q0, 0.1), (x.q1, 0.5)):
        assert abs(np.searchsorted(values, q) / len(values) - p) < 0.03
    u = got["u"]
    users = table.select("u").where("u is not null").distinct().count()
    assert u.n == 6002 and u.n_null == 1 and u.q0 is None and abs(u.n_distinct / users - 1) < 0.06


def test_shift_from_stored_sketches(table, stored):
    cut = F.lit(DAY + dt.timedelta(days=5))
    moved = sketches.stored_shift(stored, "x", F.col("period") >= cut).collect()
    assert [r.bin for r in moved] == list(range(10))
    assert all(abs(r.base_share - 0.1) < 0.04 for r in moved) and sum(r.current_share for r in moved) == pytest.approx(1)
    assert moved[9].current_share > 0.8 and sum(r.psi for r in moved) > 1
    same = sketches.stored_shift(stored.where(F.col("period") < cut), "x", F.dayofmonth("period") % 2 == 0).collect()
    assert sum(r.psi for r in same) < 0.1
    with pytest.raises(LookupError):
        sketches.stored_shift(stored, "nothing", F.lit(False))


def test_density_of_wide_data_equals_all_kernels_with_less_work(spark):
    values = np.concatenate([np.random.default_rng(1).normal(size=300), [80.0, -90.0]])
    df = spark.createDataFrame([(float(x), "a") for x in values] + [(2.0, "b"), (5.0, "b"), (1.0, "c"), (7.0, None), (9.0, None)], "x double, k string")
    rows = [r for r in a.density(df, "x", 50, ["k"]).collect()]
    h = len(values) ** -0.2 * values.std(ddof=1)
    own = {r.point: r for r in rows if r.k == "a"}
    assert len(own) == 50
    for p, r in own.items():
        at = values.min() + (values.max() - values.min()) * p / 49
        want = np.exp(-0.5 * ((at - values) / h) ** 2).sum() / (len(values) * h * np.sqrt(2 * np.pi))
        assert r.x == pytest.approx(at) and r.density == pytest.approx(want, abs=1e-9)
    assert sum(r.k == "b" for r in rows) == 50 and all(r.density is None for r in rows if r.k == "c")
