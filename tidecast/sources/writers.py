"""Sinks: contract tables, CSV, partitioned outputs, upserts, metadata, run log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators.joins import upsert_frame
from tidecast.operators.windows import dedup
from tidecast.sources.contracts import MODEL_METADATA, RUN_LOG, conform
from tidecast.sources.storage import materialise


def write_contract(
    df: DataFrame, contract: T.StructType, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    out = conform(df, contract)
    for name in partition_by:
        if name not in out.columns:
            raise ValueError(f"partition column {name} is not in the contract")
    writer = out.write.mode(mode).option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("nullValue", "N/A").csv(path)


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str], mode: str = "overwrite") -> None:
    """One folder per key value.

    Rows are not shuffled by key first: a hot key would then be written by one
    task. AQE's rebalance groups small keys together and splits large ones.
    """
    df.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).parquet(path)


def write_sized(df: DataFrame, path: str, rows_per_file: int = 1_000_000, mode: str = "overwrite") -> None:
    """Files of at most ``rows_per_file`` rows, without counting or shuffling first."""
    df.write.mode(mode).option("maxRecordsPerFile", rows_per_file).parquet(path)


def upsert(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    keys: Sequence[str],
    partition: str,
    partition_value: Column,
    version: str | None = None,
) -> None:
    """Merge rows into a partitioned Parquet table, the new rows winning on the keys.

    Only partitions that receive rows are read, merged and replaced: their values are
    listed by the driver and filter the folders before any file is opened. The partition
    must be a function of the keys (for example the date of the hour key). The
    merged rows are first written to the shared work folder, so the table is never
    read while it is being replaced and a lost executor cannot lose rows.
    """
    new = new.withColumn(partition, partition_value)
    if not _exists(spark, path):
        order = [F.desc(version)] if version else []
        rest = [F.col(c).asc_nulls_last() for c in sorted(new.columns) if c not in keys]
        dedup(new, keys, order + rest).write.partitionBy(partition).parquet(path)
        return
    new = materialise(new, "upsert-in")
    table = spark.read.parquet(path)
    values = [r[0] for r in new.select(partition).distinct().collect()]
    column = F.col(partition)
    touched = table.where(column.isin([v for v in values if v is not None]) | (column.isNull() if None in values else F.lit(False)))
    merged = materialise(upsert_frame(touched, new, keys, version), "upsert-out")
    (
        merged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def write_model_metadata(df: DataFrame, path: str) -> None:
    """One JSON document per model."""
    documents = conform(df, MODEL_METADATA).write.mode("overwrite")
    documents.option("maxRecordsPerFile", 1).json(path)


def log_run(df: DataFrame, path: str) -> None:
    """Append params, metrics and artefact rows of runs (nested through ``parent_run_id``)."""
    conform(df, RUN_LOG).write.mode("append").parquet(path)


def run_rows(
    spark: SparkSession,
    run_id: str,
    entries: dict[str, dict[str, object]],
    logged_at: int,
    parent_run_id: str | None = None,
) -> DataFrame:
    """Log rows of one run from ``{kind: {key: value}}`` (kind: param, metric, artefact)."""
    return runs_rows(spark, {run_id: entries}, logged_at, parent_run_id)


def runs_rows(
    spark: SparkSession, runs: Mapping[str, dict[str, dict[str, object]]], logged_at: int, parent_run_id: str | None = None
) -> DataFrame:
    """:func:`run_rows` of several runs, so that a search is logged by one write."""
    rows = [
        (run_id, parent_run_id, kind, key, str(value), logged_at)
        for run_id, entries in runs.items()
        for kind, pairs in entries.items()
        for key, value in pairs.items()
    ]
    return spark.createDataFrame(rows, RUN_LOG)
