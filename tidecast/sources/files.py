"""Small files and folders next to the tables, on whatever file system Spark reads them from."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text`` unless it exists; of several writers exactly one gets True.

    The text is written to a file of its own first, so that no reader sees a part of it. On a local file
    system a hard link is what fails if the name is taken, elsewhere a rename that does not overwrite.
    """
    place, fs = _handle(spark, path)
    parent, draft = place.getParent(), f"{path}.{uuid.uuid4().hex}.draft"
    fs.mkdirs(parent)
    if fs.getUri().getScheme() == "file":
        target, own = (spark._jvm.org.apache.hadoop.fs.Path(p).toUri().getPath() for p in (path, draft))
        with open(own, "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(own, target)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
    out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(draft), False)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(spark._jvm.org.apache.hadoop.fs.Path(draft), place, options)
        return True
    except Exception:
        remove(spark, draft)
        if fs.exists(place):
            return False
        raise


def read_text(spark: SparkSession, path: str) -> str:
    place, fs = _handle(spark, path)
    stream = fs.open(place)
    try:
        return bytes(stream.readNBytes(int(fs.getFileStatus(place).getLen()))).decode()
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    place, fs = _handle(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    place, fs = _handle(spark, path)
    fs.delete(place, True)
