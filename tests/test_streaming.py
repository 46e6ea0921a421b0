import datetime as dt
import random

from pyspark.sql import functions as F

from tidecast.names import ACTUAL, COUNT, HOUR, PREDICTED, ZONE
from tidecast.operators.grid import hourly_counts
from tidecast.sources.versions import BatchLog, SnapshotTable
from tidecast.streaming import jobs

START = dt.datetime(2024, 1, 1)
SCHEMA = f"id bigint, ts timestamp_ntz, {ZONE} int"


def land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def batches(n_batches, per_batch, seed=1):
    rng = random.Random(seed)
    out, ident = [], 0
    for b in range(n_batches):
        rows = []
        for _ in range(per_batch):
            rows.append((ident, START + dt.timedelta(minutes=b * 120 + rng.randrange(120)), rng.choice([1, 1, 2, 3])))
            ident += 1
        out.append(rows)
    return out


def shuffled(n_files=5, n_rows=400, seed=3):
    """Rows over ten days in random order: most rows of a file are older than rows seen before."""
    rng = random.Random(seed)
    rows = [(i, START + dt.timedelta(minutes=rng.randrange(14_400)), rng.choice([1, 1, 2, 3])) for i in range(n_rows)]
    rng.shuffle(rows)
    return [rows[k::n_files] for k in range(n_files)]


def same(got, want):
    return got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_counts_of_late_rows_and_of_a_replay_equal_the_batch_result(spark, tmp_path):
    src, base = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in shuffled():
        land(spark, src, rows)
    schema = spark.read.parquet(src).schema
    want = hourly_counts(spark.read.parquet(src), "ts").select(HOUR, ZONE, COUNT)
    for attempt in range(2):
        # the second attempt starts without a checkpoint and writes everything again
        stream = jobs.read_new_files(spark, src, schema, files_per_trigger=1)
        sink = jobs.partial_sink(f"{base}/log", [HOUR, ZONE], {COUNT: F.lit(1)})
        jobs.run_available(jobs.hour_cells(stream, "ts"), f"{base}/checkpoint-{attempt}", "append", sink)
        assert same(jobs.totals(spark, f"{base}/log", [HOUR, ZONE], [COUNT]).select(HOUR, ZONE, COUNT), want)


def test_a_second_run_adds_older_events(spark, tmp_path):
    src, base = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in reversed(batches(3, 60)):
        land(spark, src, rows)
        stream = jobs.read_new_files(spark, src, spark.read.parquet(src).schema)
        sink = jobs.partial_sink(f"{base}/log", [HOUR, ZONE], {COUNT: F.lit(1)})
        jobs.run_available(jobs.hour_cells(stream, "ts"), f"{base}/checkpoint", "append", sink)
    want = hourly_counts(spark.read.parquet(src), "ts").select(HOUR, ZONE, COUNT)
    assert same(jobs.totals(spark, f"{base}/log", [HOUR, ZONE], [COUNT]).select(HOUR, ZONE, COUNT), want)


def test_upserted_totals_of_late_rows_and_of_a_replay(spark, tmp_path):
    src, base = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in shuffled(n_files=4, n_rows=200):
        land(spark, src, rows)
    schema = spark.read.parquet(src).schema
    want = hourly_counts(spark.read.parquet(src), "ts").select(HOUR, ZONE, COUNT)
    for attempt in range(2):
        stream = jobs.read_new_files(spark, src, schema, files_per_trigger=1)
        sink = jobs.upsert_totals_sink(f"{base}/store", f"{base}/log", [HOUR, ZONE], {COUNT: F.lit(1)}, "day")
        jobs.run_available(jobs.hour_cells(stream, "ts"), f"{base}/checkpoint-{attempt}", "append", sink)
        assert same(SnapshotTable(spark, f"{base}/store").read().select(HOUR, ZONE, COUNT), want)


def test_replayed_rows_are_dropped_however_late(spark, tmp_path):
    src, base = str(tmp_path / "in"), str(tmp_path / "out")
    files = shuffled(n_files=4, n_rows=120)
    for rows in [*files, files[0], files[1][:5] + files[3][:5]]:
        land(spark, src, rows)
    schema = spark.read.parquet(src).schema
    want = spark.createDataFrame([r for rows in files for r in rows], SCHEMA)
    for attempt in range(2):
        stream = jobs.read_new_files(spark, src, schema, files_per_trigger=1)
        jobs.run_available(stream, f"{base}/checkpoint-{attempt}", "append", jobs.once_sink(f"{base}/table", ["id"], "ts"))
        out = jobs.stored_rows(spark, f"{base}/table").drop("day")
        assert same(out, want) and dict(out.dtypes)["ts"] == "timestamp_ntz"


def test_errors_of_late_rows_equal_the_batch_result(spark, tmp_path):
    src, base = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in shuffled(n_files=4, n_rows=100):
        cells = spark.createDataFrame(rows, SCHEMA).select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias(HOUR), ZONE, F.col("id").alias(ACTUAL))
        cells.dropDuplicates([HOUR, ZONE]).coalesce(1).write.mode("append").parquet(src)
    actuals = spark.read.parquet(src)
    predictions = actuals.select(HOUR, ZONE).distinct().withColumn(PREDICTED, F.lit(7))
    stream = jobs.read_new_files(spark, src, actuals.schema, files_per_trigger=1)
    sink = jobs.partial_sink(f"{base}/log", [HOUR], {"error": F.col("error"), "n": F.lit(1)})
    jobs.run_available(jobs.absolute_errors(stream, predictions), f"{base}/checkpoint", "append", sink)
    want = actuals.groupBy(HOUR).agg(F.avg(F.abs(F.col(ACTUAL) - 7)).alias("mae"), F.count(F.lit(1)).alias("n"))
    assert same(jobs.hourly_errors(spark, f"{base}/log"), want)


def test_cleaning_stream_applies_rules_and_fills(spark, tmp_path):
    src, base = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, 5.0), (2, None), (3, -1.0), (4, float("nan"))], "id int, x double").write.parquet(src)
    stream = jobs.read_new_files(spark, src, spark.read.parquet(src).schema)
    cleaned = jobs.clean_stream(stream, [("x", F.col("x") >= 0)], {"x": 2.5})
    jobs.run_available(cleaned, f"{base}/checkpoint", "append", jobs.changelog_sink(f"{base}/table"))
    assert {(r.id, r.x) for r in spark.read.parquet(f"{base}/table").collect()} == {(1, 5.0), (2, 2.5), (4, 2.5)}


def test_many_batches_stay_few_folders(spark, tmp_path):
    """Sums stay exact, late days included, while the folders that a read opens grow with the logarithm."""
    root, n, fan = str(tmp_path / "log"), 70, 4
    rng, want = random.Random(9), {}
    log = BatchLog(spark, root, lambda rows: rows.groupBy("k", "day").agg(F.sum("n").alias("n")), fan=fan, keep=20)
    for batch in range(n):
        rows = [(rng.randrange(3), START.date() + dt.timedelta(days=rng.randrange(5)), rng.randrange(9)) for _ in range(6)]
        for k, day, x in rows:
            want[k, day] = want.get((k, day), 0) + x
        frame = spark.createDataFrame(rows, "k int, day date, n bigint").groupBy("k", "day").agg(F.sum("n").alias("n")).coalesce(1)
        log.append(frame, batch)
        if batch % 9 == 0:
            log.append(frame, batch)  # a replay
            log.append(frame, batch // 2)  # one that a generation holds already
    entries = log.latest().entries
    assert len(entries) <= (fan - 1) * 4 and sum(e["last"] - e["first"] + 1 for e in entries) == n
    totals = {(r.k, r.day): r.n for r in log.read().groupBy("k", "day").agg(F.sum("n").alias("n")).collect()}
    assert totals == want
    day = START.date()
    some = {(r.k, r.day): r.n for r in log.read([day]).groupBy("k", "day").agg(F.sum("n").alias("n")).collect()}
    assert some == {k: x for k, x in want.items() if k[1] == day}
    log.expire()
    assert len(list((tmp_path / "log" / "manifests").iterdir())) == 20
    assert len(list((tmp_path / "log" / "data").iterdir())) < n
    assert log.read().agg(F.sum("n")).first()[0] == sum(want.values())
