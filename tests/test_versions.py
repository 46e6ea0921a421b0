from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tidecast.learning import models, registry
from tidecast.sources import files, versions
from tidecast.sources.versions import SnapshotTable

SCHEMA = "k int, part string, x string, v int"


def rows(spark, values):
    return spark.createDataFrame(values, SCHEMA).coalesce(1)


def put(table, frame, version=None):
    return table.upsert(frame, ["k", "part"], "p", F.col("part"), version)


def content(df):
    return {(r.k, r.part): r.x for r in df.collect()}


@pytest.fixture
def table(spark, tmp_path):
    made = SnapshotTable(spark, str(tmp_path / "t"))
    put(made, rows(spark, [(1, "a", "old", 1), (2, "a", "old", 1), (3, "b/c=1", "old", 1), (4, None, "old", 1)]))
    return made


def test_a_reader_keeps_the_rows_it_opened(spark, table):
    before = table.read()
    first = table.latest()
    version = put(table, rows(spark, [(2, "a", "new", 2), (5, "d", "new", 2), (4, None, "new", 2)]))
    old = {(1, "a"): "old", (2, "a"): "old", (3, "b/c=1"): "old", (4, None): "old"}
    assert content(before) == old
    assert content(table.read()) == old | {(2, "a"): "new", (5, "d"): "new", (4, None): "new"}
    kept = [e for e in version.entries if e["value"] == "b/c=1"]
    assert kept and kept == [e for e in first.entries if e["value"] == "b/c=1"]


def test_repeated_keys_and_versions(spark, table):
    put(table, rows(spark, [(1, "a", "low", 0), (2, "a", "high", 7), (6, "a", "first", 1), (6, "a", "second", 2)]), "v")
    assert content(table.read()) == {(1, "a"): "low", (2, "a"): "high", (6, "a"): "second", (3, "b/c=1"): "old", (4, None): "old"}


def test_no_rows_change_nothing(spark, table):
    before = content(table.read())
    put(table, rows(spark, []))
    assert content(table.read()) == before
    assert SnapshotTable(spark, table.root + "-none").latest().number == 0


@pytest.mark.parametrize("other_part", ["a", "z"])
def test_a_writer_that_loses_starts_over(spark, table, monkeypatch, other_part):
    """Between the merge and the commit of one writer another one commits, to the same partition or another."""
    real, calls = files.publish, []

    def late(session, path, text):
        if not calls:
            calls.append(path)
            put(SnapshotTable(spark, table.root), rows(spark, [(9, other_part, "other", 1)]))
        return real(session, path, text)

    monkeypatch.setattr(versions.files, "publish", late)
    put(table, rows(spark, [(1, "a", "mine", 2)]))
    got = content(table.read())
    assert got[1, "a"] == "mine" and got[2, "a"] == "old" and got[9, other_part] == "other" and len(got) == 5


def test_writers_at_the_same_time_lose_no_row(spark, table):
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: put(SnapshotTable(spark, table.root), rows(spark, [(100 + k, "a", "x", 1), (200 + k, f"q{k}", "x", 1)])), range(6)))
    got = content(table.read())
    assert {100 + k for k in range(6)} | {200 + k for k in range(6)} <= {k for k, _ in got} and len(got) == 16
    assert table.latest().number == 7


def test_old_versions_go(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "short"), keep=2)
    for k in range(5):
        put(table, rows(spark, [(1, "a", str(k), 1), (k, "b", "x", 1)]))
    table.expire()
    assert [int(n[:-5]) for n in files.names(spark, f"{table.root}/manifests")] == [4, 5]
    assert content(table.read())[1, "a"] == "4" and len(content(table.read())) == 6


def test_one_of_many_publishes(spark, tmp_path):
    path = str(tmp_path / "claims" / "1")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: files.publish(spark, path, f"writer {k}") and k, range(16)))
    winners = [k for k in won if k is not False]
    assert len(winners) == 1 and files.read_text(spark, path) == f"writer {winners[0]}"
    assert files.names(spark, str(tmp_path / "claims")) == ["1"]


def test_registered_versions_differ(spark, tmp_path):
    data = spark.createDataFrame([(1.0,)], "lag_1_ride_count double")
    model = models.pipeline(["lag_1_ride_count"], models.PersistenceForecaster()).fit(data)
    with ThreadPoolExecutor(3) as pool:
        got = list(pool.map(lambda k: registry.register(spark, str(tmp_path), "m", model, f"r{k}", k), range(3)))
    assert sorted(got) == [1, 2, 3]
