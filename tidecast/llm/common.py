"""Shared helpers: rows in and out of Arrow batches, ASCII words, document columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidecast.sources.storage import materialise

#: Rows handled at once inside a task; bounds what a batch function keeps in memory.
SLICE_ROWS = 256
#: Bytes of a slice above which it is cut further, so that long texts don't add up.
SLICE_BYTES = 4_000_000

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of at most SLICE_ROWS rows and about SLICE_BYTES bytes."""
    rows = SLICE_ROWS
    if batch.num_rows:
        rows = max(1, min(rows, int(SLICE_BYTES * batch.num_rows / max(1, batch.nbytes))))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def map_slices(df: DataFrame, make: Callable[[], Callable[..., dict]], schema: str) -> DataFrame:
    """Apply ``make()(*columns) -> {column: values}`` to slices of rows.

    ``make`` runs once in a task, so it can build caches and tables; the function it
    returns gets one Python list for each column of ``df`` and returns lists, numpy or
    Arrow arrays for each column of ``schema``.
    """
    struct = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for part in slices(batch):
                out = fn(*(c.to_pylist() for c in part.columns))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow
                )

    return df.mapInArrow(run, struct)


def map_task(df: DataFrame, run: Callable[[Iterator[list]], Iterator[dict]], schema: str) -> DataFrame:
    """Like :func:`map_slices` for functions that keep state over a whole task.

    ``run`` gets an iterator over slices (a list of Python lists each) and yields
    dictionaries of columns whenever it has rows to emit.
    """
    struct = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(struct)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = ([c.to_pylist() for c in part.columns] for batch in batches for part in slices(batch))
        for out in run(parts):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(task, struct)


def ascii_words(text: str | None) -> list[bytes]:
    """UTF-8 words between space, tab, LF, VT, FF and CR, with A-Z lower-cased; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))

def ranked(df: DataFrame, order: list[Column]) -> tuple[DataFrame, int]:
    """``df`` with ``rank`` (from 1, without gaps) in ``order``, and the number of rows.

    Rows are dealt to sorted ranges, numbered inside them and shifted by the sizes of the ranges
    before; the driver sees one count for each range. No task holds more than a range.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # range number in the upper bits, place inside the range in the lower 33
    placed = materialise(placed.withColumn("_place", F.monotonically_increasing_id()), "ranges")
    counts = placed.groupBy(F.shiftright("_place", 33).alias("range")).count().collect()
    sizes = np.zeros(ranges + 1, dtype=np.int64)
    for r in counts:
        sizes[r["range"] + 1] = r["count"]
    before = F.lit(np.cumsum(sizes)[:-1])
    inside = F.col("_place").bitwiseAND((1 << 33) - 1)
    rank = F.element_at(before, F.shiftright("_place", 33).cast("int") + 1) + inside + 1
    return placed.withColumn("rank", rank).drop("_place"), int(sizes.sum())
