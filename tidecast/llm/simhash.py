"""Near-duplicates by SimHash fingerprints and a pivot distance table.

A fingerprint has a bit set where over half of the hashes of a text's word shingles have it.
Distinct fingerprints are dealt to groups in which every pair within the allowed distance meets
at least once; in each group a table of Hamming distances to many reference fingerprints
(pivots) is built. By the triangle inequality two fingerprints differ by no less than the
difference of their distances to any pivot, so pairs with a coordinate difference over the
limit are discarded; the survivors are verified bit by bit.

Groups: the 64 bits are cut in BANDS bands. With at most ``distance`` differing bits, at least
BANDS - distance bands are untouched, so a pair meets under the key made of those bands (the
distances to the references that live in these bands only are equal, and they are the key).
A group over GROUP_LIMIT fingerprints is dealt again by the bits outside its key, cut in
FINE_BANDS bands; what then agrees on all but ``distance`` bands of those bits cannot be
larger than 2^15 distinct fingerprints, so no task ever holds an unbounded group.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import ascii_words, map_slices, map_task, text_or_empty
from tidecast.llm.components import components
from tidecast.sources.storage import materialise

SEED = 42
SHINGLE_WORDS = 3
DISTANCE = 3
BITS = 64
BANDS, FINE_BANDS = 5, 8
GROUP_LIMIT = 2_000
PIVOTS, PIVOT_SEED = 24, 7
#: Pairs looked at in one numpy step.
STEP_PAIRS = 2_000_000
#: Hashes counted in one numpy step.
STEP_HASHES = 500_000


def shingle_hashes(text: str | None, size: int = SHINGLE_WORDS) -> list[int]:
    """Seeded 64-bit hashes of a text's word shingles; of all words if there are fewer; none if no word."""
    words = ascii_words(text)
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :])]


class BitCounter:
    """Majority bits of groups of hashes, eight bits at a time."""

    def __init__(self) -> None:
        self.bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)

    def majority(self, hashes: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
        """One fingerprint for each of ``owners``; zero for an owner without hashes."""
        sizes = np.bincount(owner, minlength=owners)
        result = np.zeros(owners, dtype=np.uint64)
        by_byte = hashes.view(np.uint8).reshape(-1, 8)
        for k in range(8):
            seen = np.bincount(owner * 256 + by_byte[:, k], minlength=owners * 256).reshape(owners, 256)
            over = (2 * (seen @ self.bits) > sizes[:, None]).astype(np.uint8)
            byte = np.packbits(over, axis=1, bitorder="little")[:, 0]
            result |= byte.astype(np.uint64) << np.uint64(8 * k)
        return result


def text_key() -> Column:
    return F.xxhash64(text_or_empty())


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_key, bits``: a hash that tells texts of one id apart, and the fingerprint as a signed number."""

    def make():
        counter = BitCounter()

        def digest(ids, keys, texts):
            results = np.zeros(len(ids), dtype=np.uint64)
            pending: list[tuple[int, list[int]]] = []

            def flush() -> None:
                if pending:
                    values = np.fromiter((h for _, hs in pending for h in hs), dtype=np.uint64)
                    owner = np.repeat(np.arange(len(pending)), [len(hs) for _, hs in pending])
                    results[[i for i, _ in pending]] = counter.majority(values, owner, len(pending))
                    pending.clear()

            held = 0
            for i, text in enumerate(texts):
                hashes = shingle_hashes(text, size)
                pending.append((i, hashes))
                held += len(hashes)
                if held >= STEP_HASHES or len(pending) == 64:
                    flush()
                    held = 0
            flush()
            return {"doc_id": ids, "text_key": keys, "bits": results.view(np.int64)}

        return digest

    rows = docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), F.col("text").cast("string"))
    return map_slices(rows, make, "doc_id long, text_key long, bits long")


def band_masks(positions: list[int], bands: int, untouched: int) -> list[int]:
    """Masks of all choices of ``untouched`` out of ``bands`` bands of the bit positions."""
    cut = [positions[len(positions) * k // bands : len(positions) * (k + 1) // bands] for k in range(bands)]
    return [sum(1 << p for k in chosen for p in cut[k]) for chosen in combinations(range(bands), untouched)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def popcount(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values)


class PivotTable:
    """Distances of fingerprints to the reference fingerprints."""

    def __init__(self) -> None:
        self.pivots = np.random.default_rng(PIVOT_SEED).integers(0, 2**64, PIVOTS, dtype=np.uint64)

    def rows(self, values: np.ndarray) -> np.ndarray:
        return np.stack([popcount(values ^ p) for p in self.pivots], axis=1).astype(np.int8)

    def near_pairs(self, values: np.ndarray, distance: int):
        """Positions (i, j), i < j, of all pairs within ``distance``, in steps of bounded size.

        Sorted by the first coordinate, a value's partners stand in a window; the other coordinates
        are compared one after the other on what is left, then the bits themselves.
        """
        table = self.rows(values)
        order = np.argsort(table[:, 0], kind="stable")
        table, first = table[order], table[order, 0].astype(np.int64)
        stop = np.searchsorted(first, first + distance, side="right")
        n, start = len(values), 0
        while start < n:
            width = stop[start : min(n, start + STEP_PAIRS)] - np.arange(start, min(n, start + STEP_PAIRS)) - 1
            rows = max(1, int(np.searchsorted(np.cumsum(width), STEP_PAIRS, side="right")))
            width = width[:rows]
            i = np.repeat(np.arange(start, start + rows), width)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(width) - width, width)
            for c in range(1, table.shape[1]):
                if len(i) == 0:
                    break
                keep = np.abs(table[i, c] - table[j, c]) <= distance
                i, j = i[keep], j[keep]
            i, j = order[i], order[j]
            keep = popcount(values[i] ^ values[j]) <= distance
            yield i[keep], j[keep]
            start += rows


def spanning_links(values: np.ndarray, distance: int, table: PivotTable) -> list[tuple[int, int]]:
    """Links (value, least value of its part) that connect what near pairs connect."""
    parent = list(range(len(values)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for firsts, seconds in table.near_pairs(values, distance):
        for i, j in zip(firsts.tolist(), seconds.tolist()):
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
    signed_values = values.view(np.int64)
    return [(int(signed_values[i]), int(signed_values[r])) for i in range(len(values)) if (r := root(i)) != i]


def links_in_groups(groups: DataFrame, distance: int) -> DataFrame:
    """``a, b`` from rows that hold an array ``members`` of distinct fingerprints."""

    def run(parts):
        table = PivotTable()
        for (members,) in parts:
            found = [link for group in members for link in spanning_links(np.unique(np.array(group, dtype=np.int64).view(np.uint64)), distance, table)]
            yield {"a": [a for a, _ in found], "b": [b for _, b in found]}

    return map_task(groups.select("members"), run, "a long, b long")


def keyed(rows: DataFrame, masks: list[int], number: str) -> DataFrame:
    """A row for each mask: the bits under it are the key."""
    return rows.select(
        "*",
        F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(signed(m)).alias("m")) for k, m in enumerate(masks)])).alias("_mask"),
    ).select(*rows.columns, F.col("_mask.k").alias(number), F.col("bits").bitwiseAND(F.col("_mask.m")).alias(f"{number}_key"))


def fingerprint_links(bits: DataFrame, distance: int = DISTANCE, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Links between distinct fingerprints (column ``bits``) that connect all within ``distance``."""
    masks = band_masks(list(range(BITS)), BANDS, BANDS - distance)
    rows = keyed(bits, masks, "band")
    key = ["band", "band_key"]
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = materialise(rows.join(sizes, key), "fingerprint-groups")
    members = F.collect_list("bits").alias("members")
    links = links_in_groups(shared.where(F.col("size") <= group_limit).groupBy(*key).agg(members), distance)
    large = shared.where(F.col("size") > group_limit).drop("size")
    if large.isEmpty():
        return links
    for band, mask in enumerate(masks):
        rest = [p for p in range(BITS) if not mask >> p & 1]
        fine = keyed(large.where(F.col("band") == band), band_masks(rest, FINE_BANDS, FINE_BANDS - distance), "fine")
        again = fine.groupBy(*key, "fine", "fine_key").agg(members).where(F.size("members") > 1)
        links = links.unionByName(links_in_groups(again, distance))
    return links


def rooted(docs: DataFrame, size: int, distance: int, group_limit: int) -> DataFrame:
    """``doc_id, text_key, bits, root``: rows of one component share the root."""
    marked = materialise(fingerprints(docs, size), "fingerprints")
    roots = components(fingerprint_links(marked.select("bits").distinct(), distance, group_limit))
    rows = marked.join(roots.withColumnRenamed("node", "bits"), "bits", "left")
    return materialise(rows.withColumn("root", F.coalesce("root", "bits")), "rooted")


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, distance: int = DISTANCE, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Null, empty and blank texts have
    the fingerprint zero and link like any other. ``component_id`` is the smallest ``doc_id`` in the
    component; a null ``doc_id`` is never the smallest unless all are null, then it is null.
    Copies are one fingerprint and never make pairs. Repeated rows give repeated rows; an empty
    table an empty result.
    """
    rows = rooted(docs, size, distance, group_limit)
    # written first: both sides of the look-up are then plain exchanges, and a hot component's partition is split
    least = materialise(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")), "component-ids")
    return rows.join(least, "root").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, distance: int = DISTANCE, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """One row of each component of ``docs``, with all its columns: that of the smallest id.

    A null id stays only if its component has no other; of rows that repeat an id in a component one stays.
    """
    first = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), F.col("text_key").alias("key"))
    kept = rooted(docs, size, distance, group_limit).groupBy("root").agg(F.min(first).alias("first"))
    kept = kept.select(F.col("first.id").alias("_kept_id"), F.col("first.key").alias("_kept_key"))
    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))
    joined = docs.withColumns({"_kept_id": ids, "_kept_key": text_key()}).join(kept, ["_kept_id", "_kept_key"], "left_semi")
    return joined.dropDuplicates(["_kept_id", "_kept_key"]).select(*docs.columns)
