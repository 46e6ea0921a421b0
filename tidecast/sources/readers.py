"""Table, CSV, JSON and version readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tidecast.functions.fixed_values import OBSERVATION_FORMAT
from tidecast.functions.timeutil import parse_timestamp
from tidecast.operators.aggregates import latest_per_key
from tidecast.sources.contracts import MODEL_METADATA, OBSERVATION_FILE, ZONE_LOOKUP


#: Column that takes the text of a line that does not fit.
REJECTED = "__rejected"


def read_trips(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Columnar trip files; filters and column selection reach the scan."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path) if isinstance(path, str) else reader.parquet(*path)


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def read_periods(
    spark: SparkSession, paths: Sequence[str], missing: str = "error", schema: T.StructType | None = None
) -> DataFrame:
    """Union of period tables by column name; absent paths raise or are skipped."""
    if missing not in ("error", "skip"):
        raise ValueError("missing must be 'error' or 'skip'")
    frames = []
    for path in paths:
        try:
            frames.append(read_trips(spark, path, schema))
        except AnalysisException as e:
            if missing == "error" or e.getCondition() != "PATH_NOT_FOUND":
                raise
    if not frames:
        raise FileNotFoundError(f"none of the period tables exist: {list(paths)}")
    return union_all(frames)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def read_csv(spark: SparkSession, path: str, schema: T.StructType, null_value: str = "N/A") -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", null_value)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType, null_value: str = "N/A", rules: Sequence[tuple[str, Column]] = (), header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected lines): a line that does not fit the schema or breaks a rule is neither lost nor fatal.

    Rejected lines are ``(file, line, reason)``: ``malformed`` for values of another type and for too many or too
    few fields, else the name of the first rule that does not hold. Every line is in exactly one of the two.
    """
    raw = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())]))
        .option("header", header)
        .option("nullValue", null_value)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED)
        .option("columnPruning", False)  # otherwise a line is checked for the selected columns only
        .csv(path)
    )
    broken = F.when(F.col(REJECTED).isNotNull(), F.lit("malformed"))
    for name, rule in rules:
        broken = broken.when(~F.coalesce(rule, F.lit(False)), F.lit(name))
    fields = [F.col(f"`{f.name}`") for f in schema]
    text = F.coalesce(F.col(REJECTED), F.to_csv(F.struct(*fields)))
    marked = raw.withColumns({"__reason": broken, "__line": text, "__file": F.col("_metadata.file_path")})
    rejected = marked.where("__reason is not null")
    return (
        marked.where("__reason is null").select(*fields),
        rejected.select(F.col("__file").alias("file"), F.col("__line").alias("line"), F.col("__reason").alias("reason")),
    )


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup; the name is not unique, so ``LocationID`` is the only key."""
    return read_csv(spark, path, ZONE_LOOKUP)


def read_observations(
    spark: SparkSession,
    path: str,
    pattern: str = OBSERVATION_FORMAT,
    schema: T.StructType = OBSERVATION_FILE,
    text_ts: str = "date and time",
) -> DataFrame:
    raw = spark.read.schema(schema).option("header", True).csv(path)
    return _observations(raw, pattern, text_ts)


def _observations(raw: DataFrame, pattern: str, text_ts: str) -> DataFrame:
    names = {c: c.replace(" ", "_") for c in raw.columns}
    return raw.withColumn(text_ts, parse_timestamp(F.col(f"`{text_ts}`"), pattern)).withColumnsRenamed(
        {**names, text_ts: "observed_at"}
    )


def read_observations_checked(
    spark: SparkSession,
    path: str,
    pattern: str = OBSERVATION_FORMAT,
    schema: T.StructType = OBSERVATION_FILE,
    text_ts: str = "date and time",
) -> tuple[DataFrame, DataFrame]:
    """(observations, rejected lines): also lines without a readable time are rejected."""
    rules = [("time", F.try_to_timestamp(F.col(f"`{text_ts}`"), F.lit(pattern)).isNotNull())]
    good, rejected = read_csv_checked(spark, path, schema, rules=rules)
    return _observations(good, pattern, text_ts), rejected


def read_model_metadata(spark: SparkSession, path: str, schema: T.StructType = MODEL_METADATA) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(path)
    )


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Newest artefact per key."""
    return latest_per_key(df, keys, order, columns)


def newest_file(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(path, modified)`` of the most recently modified file, from file metadata only."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "modificationTime")
    )
    return files.orderBy(F.desc("modificationTime"), F.desc("path")).limit(1)


def period_from_name(name: Column | str, pattern: str = r"(\d{4}-\d{2})", group: int = 1) -> Column:
    """Period token inside a file or object name; NULL when there is none."""
    name = F.col(name) if isinstance(name, str) else name
    token = F.regexp_extract(name, pattern, group)
    return F.when(token != "", token)


def plan_backfill(wanted: DataFrame, present: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Wanted periods without data."""
    return wanted.join(present.select(keys if isinstance(keys, list) else [keys]).distinct(), keys, "left_anti")
