"""Importance resampling towards a target distribution, over hashed word n-grams.

Two passes over the texts. The first counts the hashed features of the documents and of the target
texts; their log ratio is the gain of a bucket. The second gives every document the mean gain of its
features, adds Gumbel noise that depends on the id only, and the highest scores are drawn: a sample
without replacement in proportion to the importance weights.

Texts are handled in batches: a batch is one byte string with a sentinel after each text, one regular
expression pass finds all words, document offsets are searched for the words' places, and neighbours
of two documents make no bigram. Hashes of bigrams are combined from those of their words by table
look-ups, so no bigram is ever built; buckets are counted by ``bincount``.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import map_slices, map_task, ranked
from tidecast.sources.storage import materialise

BUCKETS = 10_000
SEED = 7
LEAST_WORDS = 20
#: Hundredths of the eligible documents that are drawn.
PERCENT = 25
#: Gains are whole numbers of this part of a unit.
UNIT = 1000
#: Between two texts of a batch; no word holds it.
SENTINEL = b"\x00"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Lengths up to which word hashes are combined by tables; bytes of words that a task remembers.
TABLE_LENGTH, CACHE_BYTES = 48, 32_000_000


def shift_tables(longest: int) -> np.ndarray:
    """``[n, k, byte]``: what appending n zero bytes makes of ``byte`` in place k of a CRC-32."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(0xEDB88320), one >> 1).astype(np.uint32)
    tables = np.empty((longest + 1, 4, 256), dtype=np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(longest):
        tables[n + 1] = (tables[n] >> 8) ^ one[tables[n] & 0xFF]
    return tables


class Features:
    """Hash buckets of all runs of one and two words of a batch of texts."""

    def __init__(self, buckets: int) -> None:
        self.buckets, self.tables = buckets, shift_tables(TABLE_LENGTH)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.words: list[bytes] = []
        self.held = 0
        #: of each known word: its hash, the hash of it and a space, its length
        self.own, self.spaced, self.length = (np.empty(0, dtype=t) for t in (np.uint32, np.uint32, np.int64))

    def _learn(self, found: list[bytes]) -> np.ndarray:
        if self.held > CACHE_BYTES:
            self._forget()
        new = [w for w in dict.fromkeys(found) if w not in self.known]
        if new:
            at = len(self.words)
            self.known.update(zip(new, range(at, at + len(new)), strict=True))
            self.words += new
            self.held += sum(map(len, new)) + 100 * len(new)
            own = np.array([zlib.crc32(w) for w in new], dtype=np.uint32)
            spaced = np.array([zlib.crc32(b" ", int(c)) for c in own], dtype=np.uint32)
            self.own, self.spaced = np.append(self.own, own), np.append(self.spaced, spaced)
            self.length = np.append(self.length, np.array([len(w) for w in new], dtype=np.int64))
        return np.fromiter(map(self.known.__getitem__, found), dtype=np.int64, count=len(found))

    def _pairs(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """CRC-32 of "first second" for word numbers."""
        head, size = self.spaced[first], np.minimum(self.length[second], TABLE_LENGTH)
        out = self.own[second].copy()
        for k in range(4):
            out ^= self.tables[size, k, (head >> np.uint32(8 * k)) & np.uint32(0xFF)]
        for i in np.flatnonzero(self.length[second] > TABLE_LENGTH):
            out[i] = zlib.crc32(self.words[second[i]], int(head[i]))
        return out

    def __call__(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Documents and buckets of all single words, then documents and buckets of all bigrams."""
        parts = [t or b"" for t in texts]
        offsets = np.cumsum([0, *[len(t) + len(SENTINEL) for t in parts]])
        found, starts = [], []
        for m in WORD.finditer(SENTINEL.join(parts).lower()):
            found.append(m.group())
            starts.append(m.start())
        ids = self._learn(found)
        docs = np.searchsorted(offsets, np.array(starts, dtype=np.int64), side="right") - 1
        inside = np.flatnonzero(docs[:-1] == docs[1:])
        singles = (self.own[ids] % np.uint32(self.buckets)).astype(np.int64)
        pairs = (self._pairs(ids[inside], ids[inside + 1]) % np.uint32(self.buckets)).astype(np.int64)
        return docs, singles, docs[inside], pairs


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all ``text`` rows by bucket. A task sends at most a row for each bucket."""

    def run(slices: Iterator[list]) -> Iterator[dict]:
        features, total = Features(buckets), np.zeros(buckets, dtype=np.int64)
        for (part,) in slices:
            _, singles, _, pairs = features(part)
            total += np.bincount(singles, minlength=buckets) + np.bincount(pairs, minlength=buckets)
        used = np.flatnonzero(total)
        yield {"bucket": used, "n": total[used]}

    counted = map_task(texts.select(F.col("text").cast("string").cast("binary")), run, "bucket long, n long")
    rows = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, dtype=np.int64)
    out[rows["bucket"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return out


def bucket_gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log ratio of smoothed feature shares, by bucket."""
    buckets = len(documents)
    all_s, all_t = float(documents.sum()), float(target.sum())
    ratio = [(t + 1.0) * (all_s + buckets) / ((s + 1.0) * (all_t + buckets)) for s, t in zip(documents.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(UNIT * math.log(r)) for r in ratio], dtype=np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise in thousandths that depends on the id only; null ids share one."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-UNIT * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """``doc_id, text_key, n_words, n_features, weight, score`` of every row."""
    buckets = len(gains)

    def make():
        features = Features(buckets)

        def score(ids, texts):
            n = len(ids)
            of_single, singles, of_pair, pairs = features(texts)
            words = np.bincount(of_single, minlength=n)
            count = words + np.bincount(of_pair, minlength=n)
            # sums of whole numbers below 2^53 are exact in doubles
            total = np.bincount(of_single, weights=gains[singles], minlength=n) + np.bincount(of_pair, weights=gains[pairs], minlength=n)
            weight = np.where(count > 0, total.astype(np.int64) // np.maximum(count, 1), 0)
            return {
                "doc_id": ids, "n_words": words, "n_features": count, "weight": weight,
                "score": weight + np.array([noise(i, seed) for i in ids], dtype=np.int64),
                "text_key": [hashlib.sha256(t or b"").digest() for t in texts],
            }

        return score

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    return map_slices(rows, make, "doc_id long, text_key binary, n_words long, n_features long, weight long, score long")


def ranked_scores(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED
) -> DataFrame:
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    rows = materialise(scored(docs, gains, seed), "importance")
    eligible = rows.where(F.col("n_words") >= least_words)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("text_key")]
    placed, n = ranked(eligible, order)
    drawn = percent * n // 100
    placed = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return placed.unionByName(rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))


def importance(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED
) -> DataFrame:
    """One row per document: ``doc_id, n_features, weight, score, rank``; rank is null for those not drawn.

    ``docs`` needs ``doc_id`` and ``text``, ``target`` needs ``text``; other columns are ignored. Null and
    wordless texts have no features and weight 0. Documents of fewer than ``least_words`` words are
    scored, but never drawn. Equal scores go by the smaller id; null ids come last and share one
    noise. Rows that repeat an id are documents of their own. Without target texts every bucket has
    the smoothed share only; an empty table of documents gives no rows. Only the counts of ``buckets``
    buckets reach the driver.
    """
    rows = ranked_scores(docs, target, percent, least_words, buckets, seed)
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED
) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns. Rows that repeat id and text come all, where one is drawn."""
    rows = ranked_scores(docs, target, percent, least_words, buckets, seed).where("rank is not null")
    keys = rows.select(F.xxhash64("doc_id").alias("_drawn_hash"), F.col("doc_id").alias("_drawn_id"), F.col("text_key").alias("_drawn_text"))
    own = docs.select(F.struct(*docs.columns).alias("_row"))
    same = F.expr("_drawn_hash = xxhash64(cast(_row.doc_id as bigint)) and _drawn_id <=> cast(_row.doc_id as bigint)")
    text = F.unhex(F.sha2(F.coalesce(F.col("_row.text").cast("string"), F.lit("")), 256))
    return own.join(keys, same & (F.col("_drawn_text") == text), "left_semi").select("_row.*")
