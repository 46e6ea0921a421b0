"""Shared working folders.

On a cluster the session names a shared folder in ``spark.checkpoint.dir``; every
intermediate table goes below it. Only where the setting is absent on one machine
(tests) a temporary folder is created; a cluster without the setting is refused.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidecast.sources import files

_fallback: list[str] = []


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if not re.fullmatch(r"local(\[[^\[\]]*\])?", master):
        raise RuntimeError(
            f"spark.checkpoint.dir is not set; on {master} it must name a folder that all executors share"
        )
    if not _fallback:
        _fallback.append(tempfile.mkdtemp(prefix="tidecast-"))
    return _fallback[0]


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/tidecast/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: cuts the lineage and survives the loss of executors."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """:func:`materialise` for the length of a block: the folder is removed by the one who made it."""
    spark, path = df.sparkSession, work_path(df.sparkSession, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        files.remove(spark, path)
