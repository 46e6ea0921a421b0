"""Model registry: saved pipelines plus one append-only version table, a folder for each row."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.operators.aggregates import latest_per_key
from tidecast.sources import files
from tidecast.sources.contracts import REGISTRY


def versions(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(REGISTRY).option("recursiveFileLookup", "true").parquet(f"{root}/versions")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REGISTRY)


def latest_versions(table: DataFrame) -> DataFrame:
    """The newest version of each model name."""
    return latest_per_key(table, ["name"], ["version", "creation_timestamp"], ["version", "run_id", "source", "status"])


def register(spark: SparkSession, root: str, name: str, model: PipelineModel, run_id: str, created: int) -> int:
    """Save a fitted pipeline as the next version of ``name`` and return that version.

    A version belongs to the writer who creates its file below ``claims``, which only one can; two writers at
    the same time get different versions.
    """
    newest = versions(spark, root).where(F.col("name") == name).agg(F.max("version")).first()[0]
    version = _claimed(spark, f"{root}/claims/{name}", (newest or 0) + 1, run_id)
    source = f"{root}/models/{name}/{version}"
    model.write().overwrite().save(source)
    row = spark.createDataFrame([(name, version, run_id, source, created, "READY")], REGISTRY)
    # a folder of its own: jobs that append to one folder at the same time remove each other's unfinished files
    row.write.mode("append").parquet(f"{root}/versions/{name}/{version}")
    return version


def _claimed(spark: SparkSession, path: str, first: int, run_id: str) -> int:
    version = first
    while not files.publish(spark, f"{path}/{version}", run_id):
        version += 1
    return version


def load_latest(spark: SparkSession, root: str, name: str) -> tuple[PipelineModel, int]:
    row = latest_versions(versions(spark, root).where(F.col("name") == name)).first()
    if row is None:
        raise LookupError(f"no registered version of {name}")
    return PipelineModel.load(row["source"]), row["version"]
