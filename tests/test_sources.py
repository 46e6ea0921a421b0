import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.learning import models, registry
from tidecast.names import HOUR, ZONE
from tidecast.sources import contracts, readers, storage, writers

START = dt.datetime(2024, 1, 1)
COUNTS = f"{HOUR} timestamp_ntz, {ZONE} int, n int"


def counts(spark, hours, n):
    return spark.createDataFrame([(START + dt.timedelta(hours=h), z, n) for h in hours for z in (1, 2)], COUNTS)


def test_upsert_newest_wins_and_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "store")
    args = ([HOUR, ZONE], "day", F.to_date(HOUR))
    writers.upsert(spark, path, counts(spark, range(0, 72), 1), *args)
    untouched = {f for f in os.listdir(f"{path}/day=2024-01-01") if f.endswith(".parquet")}
    newer = counts(spark, range(60, 80), 2)
    for _ in range(2):
        writers.upsert(spark, path, newer, *args)
        out = spark.read.parquet(path)
        assert out.count() == 160
        assert {(r.n, r["count"]) for r in out.groupBy("n").count().collect()} == {(1, 120), (2, 40)}
    # the first day received no rows, so its files stay as they were
    assert untouched == {f for f in os.listdir(f"{path}/day=2024-01-01") if f.endswith(".parquet")}


def test_upsert_resolves_duplicates_inside_one_batch(spark, tmp_path):
    path = str(tmp_path / "store")
    both = counts(spark, [1], 1).unionByName(counts(spark, [1], 5))
    writers.upsert(spark, path, both, [HOUR, ZONE], "day", F.to_date(HOUR), version="n")
    assert [r.n for r in spark.read.parquet(path).collect()] == [5, 5]


def test_csv_na_is_null_but_unknown_is_text(spark, tmp_path):
    path = str(tmp_path / "zones")
    rows = [(264, "Unknown", "N/A", "N/A"), (1, "EWR", 'Newark, "Airport"', "EWR")]
    spark.createDataFrame(rows, contracts.ZONE_LOOKUP).write.option("header", True).csv(path)
    got = {r.LocationID: r for r in readers.read_zones(spark, path).collect()}
    assert got[264].Zone is None and got[264].Borough == "Unknown"
    assert got[1].Zone == 'Newark, "Airport"'


def test_observations_are_day_first(spark, tmp_path):
    path = tmp_path / "weather.csv"
    path.write_text(
        "date and time,temperature,humidity,wind speed,cloud cover,amount of precipitation\n"
        "11.12.2019 07:00,1.5,80,3,no clouds,Trace of precipitation\n"
    )
    row = readers.read_observations(spark, str(path)).first()
    assert row.observed_at == dt.datetime(2019, 12, 11, 7)
    assert row.wind_speed == 3 and row.amount_of_precipitation == "Trace of precipitation"


def test_missing_periods_raise_or_are_skipped(spark, tmp_path):
    there = str(tmp_path / "a")
    spark.range(3).write.parquet(there)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_periods(spark, [there, str(tmp_path / "b")]).count()
    assert readers.read_periods(spark, [there, str(tmp_path / "b")], missing="skip").count() == 3
    with pytest.raises(FileNotFoundError):
        readers.read_periods(spark, [str(tmp_path / "b")], missing="skip")


def test_union_of_periods_matches_columns_by_name(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "y int, z int")
    rows = readers.union_all([a, b]).orderBy("y").collect()
    assert [tuple(r) for r in rows] == [(1, 2, None), (None, 3, 4)]


def test_newest_file_and_period_token(spark, tmp_path):
    for i, name in enumerate(["m_2024-01.bin", "m_2024-02.bin"]):
        f = tmp_path / name
        f.write_bytes(b"x")
        os.utime(f, (1_700_000_000 - i, 1_700_000_000 - i))
    row = readers.newest_file(spark, str(tmp_path)).select(readers.period_from_name("path")).first()
    assert row[0] == "2024-01"


def test_contract_rejects_missing_columns(spark):
    with pytest.raises(ValueError, match="missing"):
        contracts.conform(spark.range(1), contracts.PREDICTIONS)


def test_metadata_round_trip(spark, tmp_path):
    row = models.metadata_row(
        spark, "m", "GBT", {"depth": 3}, ["a", "b"], "now", {"test_mae": 1.5}, {"cv_folds": 5}, 10
    )
    for i in (1, 2):
        writers.write_model_metadata(row, str(tmp_path / str(i)))
    back = readers.read_model_metadata(spark, str(tmp_path)).collect()
    assert len(back) == 2
    assert back[0].feature_columns == ["a", "b"] and back[0].metrics.test_mae == 1.5
    assert back[0].parameters == {"depth": "3"} and back[0].cross_validation.cv_folds == 5


def test_registry_versions(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    with pytest.raises(LookupError):
        registry.load_latest(spark, root, "m")
    for i, column in enumerate(["a", "b"], 1):
        model = models.pipeline(["a", "b"], models.PersistenceForecaster(inputCol=column)).fit(df)
        assert registry.register(spark, root, "m", model, f"r{i}", i) == i
    model, version = registry.load_latest(spark, root, "m")
    assert version == 2 and model.transform(df).first().prediction == 2.0


def test_work_path_follows_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = storage.work_path(spark, "x")
    assert path.startswith(root.rstrip("/") if root else "/tmp")
    assert storage.work_path(spark, "x") != path


def test_partitioned_and_sized_writes(spark, tmp_path):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 5))
    writers.write_partitioned(df, str(tmp_path / "p"), ["k"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1000
    writers.write_sized(df.coalesce(1), str(tmp_path / "s"), 300)
    files = [f for f in os.listdir(tmp_path / "s") if f.endswith(".parquet")]
    assert len(files) == 4


def test_upsert_opens_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.sql("SELECT id AS k, date_add(DATE'2024-01-01', CAST(id AS INT)) AS at, id AS v FROM range(20)")
    writers.upsert(spark, path, rows, ["k", "at"], "day", F.col("at"))
    # folders that receive no row may be unreadable
    broken = tmp_path / "store" / "day=2024-01-05"
    for f in broken.glob("*.parquet"):
        f.write_bytes(b"not parquet")
    writers.upsert(spark, path, rows.where("k in (1, 7)").withColumn("v", F.lit(100)), ["k", "at"], "day", F.col("at"))
    got = {r.k: r.v for r in spark.read.parquet(path).where("day <> DATE'2024-01-05'").collect()}
    assert got == {k: 100 if k in (1, 7) else k for k in range(20) if k != 4}


def test_broken_csv_lines_are_kept_apart(spark, tmp_path):
    lines = ["k,x,day", "1,2.5,01.02.2024", "2,oops,01.02.2024", "3,1.0,01.02.2024,more", "4,1.0", "5,N/A,01.02.2024", "6,-1,01.02.2024", "7,9,no day", ""]
    (tmp_path / "in.csv").write_text("\n".join(lines))
    schema = T._parse_datatype_string("k int, x double, day string")
    rules = [("positive", F.coalesce(F.col("x") >= 0, F.lit(True))), ("day", F.try_to_timestamp("day", F.lit("dd.MM.yyyy")).isNotNull())]
    good, rejected = readers.read_csv_checked(spark, str(tmp_path / "in.csv"), schema, rules=rules)
    assert sorted((r.k, r.x) for r in good.collect()) == [(1, 2.5), (5, None)]
    assert good.columns == ["k", "x", "day"] and good.select("k").count() == 2
    got = {r.line.split(",")[0]: r.reason for r in rejected.collect()}
    assert got == {"2": "malformed", "3": "malformed", "4": "malformed", "6": "positive", "7": "day"}
    assert rejected.select("reason").count() == 5 and all(r.file.endswith("in.csv") for r in rejected.collect())


def test_observations_without_a_time_are_rejected(spark, tmp_path):
    header = ",".join(f.name for f in contracts.OBSERVATION_FILE)
    width = len(contracts.OBSERVATION_FILE)
    at = [f.name for f in contracts.OBSERVATION_FILE].index("date and time")
    rows = []
    for text in ("31.01.2024 10:30", "2024-01-31", ""):
        cells = [""] * width
        cells[at] = text
        rows.append(",".join(cells))
    (tmp_path / "o.csv").write_text("\n".join([header, *rows]))
    good, rejected = readers.read_observations_checked(spark, str(tmp_path / "o.csv"))
    assert [str(r.observed_at) for r in good.collect()] == ["2024-01-31 10:30:00"]
    assert {r.reason for r in rejected.collect()} == {"time"} and rejected.count() == 2
