"""Incremental jobs on new files. Each runs under any trigger; ``run_available``
processes what is there and stops.

Counts, errors and replay removal keep no streaming state and no watermark: every micro-batch
adds to a log under its number, and reads sum it up. Late rows count like any other. The log merges
batches into generations, so a read opens a number of folders that grows with the logarithm of
the batches.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidecast.functions.timeutil import hour_bucket
from tidecast.names import ACTUAL, HOUR, PREDICTED, ZONE
from tidecast.operators.quality import Rule, apply_rules, normalise_nan
from tidecast.sources.storage import scratch
from tidecast.sources.versions import BatchLog, SnapshotTable


def read_new_files(
    spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def run_available(df: DataFrame, checkpoint: str, mode: str, sink: Callable[[DataFrame, int], None]) -> StreamingQuery:
    query = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(sink)
        .start()
    )
    query.awaitTermination()
    return query


def clean_stream(stream: DataFrame, rules: Sequence[Rule], fill: dict | None = None) -> DataFrame:
    """Row-wise quality rules; medians for ``fill`` come from a finished batch table."""
    out = normalise_nan(stream)
    return apply_rules(out.na.fill(fill) if fill else out, rules)


def hour_cells(stream: DataFrame, ts: str, zone: str = ZONE, mode: str = "round") -> DataFrame:
    """The (hour, zone) cell of every row: a stateless projection, whatever order rows arrive in."""
    return stream.select(F.col(zone), hour_bucket(ts, mode).alias(HOUR))


def absolute_errors(actuals: DataFrame, predictions: DataFrame, keys: Sequence[str] = (HOUR, ZONE)) -> DataFrame:
    """Error of each measured value of a stream that a prediction table covers."""
    joined = actuals.join(predictions, list(keys), "inner")
    return joined.select(HOUR, F.abs(F.col(ACTUAL) - F.col(PREDICTED)).alias("error"))


def _sum_log(spark: SparkSession, path: str, keys: Sequence[str], names: Sequence[str]) -> BatchLog:
    return BatchLog(spark, path, lambda rows: rows.groupBy(*dict.fromkeys([*keys, "day"])).agg(*[F.sum(n).alias(n) for n in names]))


def partial_sink(path: str, keys: Sequence[str], sums: Mapping[str, Column], day: str = HOUR) -> Callable[[DataFrame, int], None]:
    """Add the sums per key of each micro-batch to the log at ``path``.

    Totals are the sums over the log (:func:`totals`), so rows may come in any order and as late as
    they like: nothing waits for a watermark and nothing is dropped. A replayed batch is in the log
    already and changes nothing. ``day`` is the timestamp whose date readers may ask for. A run that
    starts without the old checkpoint must be given the same files per trigger, or another path.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        partial = batch.groupBy(*keys).agg(*[F.sum(e).alias(name) for name, e in sums.items()])
        _sum_log(batch.sparkSession, path, keys, list(sums)).append(partial.withColumn("day", F.to_date(day)), batch_id)

    return write


def totals(spark: SparkSession, path: str, keys: Sequence[str], names: Sequence[str], days: Sequence | None = None) -> DataFrame:
    """Current sums per key over all batches of :func:`partial_sink`, of some days only if given."""
    parts = _sum_log(spark, path, keys, names).read(days)
    if parts is None:
        raise LookupError(f"no batch has been added to {path}")
    return parts.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])


def hourly_errors(spark: SparkSession, path: str) -> DataFrame:
    """MAE and number of errors per hour from the partial sums of ``error`` and ``n``."""
    return totals(spark, path, [HOUR], ["error", "n"]).select(HOUR, (F.col("error") / F.col("n")).alias("mae"), "n")


def once_sink(path: str, keys: Sequence[str], ts: str) -> Callable[[DataFrame, int], None]:
    """Append rows whose keys are not stored yet; copies of a row carry the same time.

    Only the stored keys of the days in the batch are read. A replayed batch is in the log already and
    changes nothing, and a copy is found however late it comes.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log = BatchLog(spark, path)
        if log.has(batch_id):
            return
        with scratch(batch.dropDuplicates(list(keys)).withColumn("day", F.to_date(ts)), "once") as rows:
            days = [r[0] for r in rows.select("day").distinct().collect()]
            kept = log.read(days)
            log.append(rows if kept is None else rows.join(kept.select(*keys), list(keys), "left_anti"), batch_id)

    return write


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows that :func:`once_sink` has kept, with their ``day``."""
    rows = BatchLog(spark, path).read()
    if rows is None:
        raise LookupError(f"no batch has been added to {path}")
    return rows


def changelog_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Sink for appended results: one folder per micro-batch, overwritten when the batch is replayed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def upsert_totals_sink(
    path: str, log: str, keys: Sequence[str], sums: Mapping[str, Column], partition: str, day: str = HOUR
) -> Callable[[DataFrame, int], None]:
    """Keep partial sums in ``log`` and merge the new totals of the touched keys into the snapshot table at ``path``.

    The log is read for the days of the batch only. Replaying a batch changes nothing.
    """
    note = partial_sink(log, keys, sums, day)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        note(batch, batch_id)
        with scratch(batch.select(*keys).distinct(), "touched") as touched:
            days = [r[0] for r in touched.select(F.to_date(day)).distinct().collect()]
            if days:
                new = totals(spark, log, keys, list(sums), days).join(touched, list(keys), "left_semi")
                SnapshotTable(spark, path).upsert(new, keys, partition, F.to_date(day))

    return write
