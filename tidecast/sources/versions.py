"""Tables of immutable folders under numbered manifests.

A commit writes new folders and then publishes the next manifest, a list of the folders that make up
the table. Publishing is the only step that others see: readers keep the manifest they opened, and of two
writers of one number exactly one succeeds and the other starts over from the newer manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators.joins import upsert_frame
from tidecast.operators.windows import dedup
from tidecast.sources import files
from tidecast.sources.storage import scratch

PART = "_part"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: Manifests (with the folders they name) that stay readable; older ones are removed by the writers.
KEEP = 100


@dataclass(frozen=True)
class Version:
    """A manifest: its number, the table's schema and its entries (each has a ``path``)."""

    number: int = 0
    schema: str | None = None
    entries: list[dict] = field(default_factory=list)

    def table(self, spark: SparkSession, entries: Sequence[dict] | None = None) -> DataFrame:
        """The rows of the entries (all by default), in one scan."""
        schema = T.StructType.fromJson(json.loads(self.schema))
        paths = [e["path"] for e in (self.entries if entries is None else entries)]
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths)


class Versions:
    """The manifests below ``root``. ``keep`` of them stay, older ones go with the folders only they name."""

    def __init__(self, spark: SparkSession, root: str, keep: int = KEEP) -> None:
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep

    def _numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in files.names(self.spark, f"{self.root}/manifests") if n.endswith(".json"))

    def _load(self, number: int) -> Version:
        stored = json.loads(files.read_text(self.spark, f"{self.root}/manifests/{number:012d}.json"))
        return Version(number, stored["schema"], stored["entries"])

    def latest(self) -> Version:
        numbers = self._numbers()
        return self._load(numbers[-1]) if numbers else Version()

    def publish(self, base: Version, schema: str, entries: list[dict]) -> Version | None:
        """The version after ``base``; None if somebody else has published it."""
        new = Version(base.number + 1, schema, entries)
        text = json.dumps({"schema": schema, "entries": entries})
        if not files.publish(self.spark, f"{self.root}/manifests/{new.number:012d}.json", text):
            return None
        if new.number % self.keep == 0:
            self.expire()
        return new

    def folder(self) -> str:
        return f"{self.root}/data/{uuid.uuid4().hex}"

    def expire(self) -> None:
        """Remove all but the newest ``keep`` manifests and the folders that none of these names."""
        numbers = self._numbers()
        old, new = numbers[: -self.keep], numbers[-self.keep :]
        paths = [{e["path"] for n in part for e in self._load(n).entries} for part in (old, new)]
        for path in sorted(paths[0] - paths[1]):
            files.remove(self.spark, path)
        for n in old:
            files.remove(self.spark, f"{self.root}/manifests/{n:012d}.json")


class SnapshotTable(Versions):
    """A partitioned table with keyed upserts; an entry is a partition value (as text) and its folder.

    A manifest has a line for each partition, so its size goes with their number, not with the rows.
    """

    def read(self, version: Version | None = None) -> DataFrame:
        return (version or self.latest()).table(self.spark)

    def upsert(self, new: DataFrame, keys: Sequence[str], partition: str, partition_value: Column, version: str | None = None) -> Version:
        """Merge rows, the new ones winning on the keys; of new rows with the same keys the largest ``version`` wins.

        Only partitions that receive rows are read and written anew. The partition must be a function of the
        keys. If another writer commits first, the merge is repeated where it changed a touched
        partition; else only the manifest is.
        """
        new = new.withColumn(partition, partition_value)
        with scratch(new.withColumn(PART, F.col(partition).cast("string")), "upsert-in") as rows:
            touched = {r[0] or NO_VALUE for r in rows.select(PART).distinct().collect()}
            seen, entries = None, []  # what the last merge started from, and what it wrote
            while True:
                base = self.latest()
                mine = [e for e in base.entries if e["value"] in touched]
                if seen != mine:
                    for old in entries:
                        files.remove(self.spark, old["path"])
                    seen, entries = mine, self._merged(base, mine, rows.drop(PART), keys, partition, version)
                others = [e for e in base.entries if e["value"] not in touched]
                done = self.publish(base, base.schema or new.schema.json(), others + entries)
                if done is not None:
                    return done

    def _merged(self, base: Version, mine: list[dict], rows: DataFrame, keys: Sequence[str], partition: str, version: str | None) -> list[dict]:
        if mine:
            merged = upsert_frame(base.table(self.spark, mine), rows, keys, version)
        else:
            order = [F.desc(version)] if version else []
            merged = dedup(rows, keys, order + [F.col(c).asc_nulls_last() for c in sorted(rows.columns) if c not in keys])
        path = self.folder()
        merged.withColumn(PART, F.col(partition).cast("string")).write.partitionBy(PART).parquet(path)
        found = [n for n in files.names(self.spark, path) if n.startswith(f"{PART}=")]
        return [{"value": unquote(n[len(PART) + 1 :]), "path": f"{path}/{n}"} for n in found]


class BatchLog(Versions):
    """What numbered batches add, in generations; an entry is a run of batches and its folder.

    As soon as ``fan`` entries of one generation stand at the end, ``merge`` makes one of the next
    generation of them, so n batches are at most ``fan - 1`` folders for each power of ``fan`` in n. A
    batch that is already in the log changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str, merge: Callable[[DataFrame], DataFrame] | None = None, fan: int = 8, keep: int = KEEP) -> None:
        super().__init__(spark, root, keep)
        self.merge, self.fan = merge or (lambda rows: rows), fan

    def has(self, batch_id: int, version: Version | None = None) -> bool:
        return any(e["first"] <= batch_id <= e["last"] for e in (version or self.latest()).entries)

    def append(self, rows: DataFrame, batch_id: int) -> Version:
        """Add the rows of a batch; they are sorted by ``day`` for readers that ask for some days."""
        path, base = self.folder(), self.latest()
        if self.has(batch_id, base):
            return base
        self._write(rows, path)
        while True:
            entries = [*base.entries, {"first": batch_id, "last": batch_id, "generation": 0, "path": path}]
            entries = self._compacted(Version(base.number, base.schema or rows.schema.json(), entries))
            done = self.publish(base, base.schema or rows.schema.json(), entries)
            if done is not None:
                return done
            base = self.latest()
            if self.has(batch_id, base):
                return base

    def _write(self, rows: DataFrame, path: str) -> None:
        rows.sortWithinPartitions("day").write.parquet(path)

    def _compacted(self, version: Version) -> list[dict]:
        """The entries after merging; several generations that fill up at once are merged in one step."""
        groups = [(e["generation"], [e]) for e in version.entries]
        while len(groups) >= self.fan and len({g for g, _ in groups[-self.fan :]}) == 1:
            last = groups[-self.fan :]
            groups = [*groups[: -self.fan], (last[0][0] + 1, [e for _, part in last for e in part])]
        generation, last = groups[-1]
        if len(last) == 1:
            return version.entries
        path, merged = self.folder(), self.merge(version.table(self.spark, last))
        self._write(merged.select(*[f["name"] for f in json.loads(version.schema)["fields"]]), path)
        whole = {"first": min(e["first"] for e in last), "last": max(e["last"] for e in last), "generation": generation, "path": path}
        return [*version.entries[: -len(last)], whole]

    def read(self, days: Sequence | None = None) -> DataFrame | None:
        """All rows, of some days only if given; None if nothing was ever appended."""
        version = self.latest()
        if not version.number:
            return None
        rows = version.table(self.spark)
        return rows if days is None else rows.where(F.col("day").isin(list(days)))
