"""Shards of equal bytes, tokens and rows by vector bin packing.

Equal texts are a group, and a group is a vector of bytes, tokens and rows. Groups are placed in order
of their largest share, each into the shard where the dot product of its vector with the shard's
residual capacity is highest, so that all three are balanced jointly. A group stays whole unless it is
larger than a shard in one of the three; then its rows are salted and every salt is placed by itself.

No task sees all groups: they are dealt to blocks of bounded size, a block packs its groups into
bundles by the same rule, and the bundles of all blocks are the groups of the next level, until they
fit into one block, which is packed into the shards. The shard of a row is found by following its
group through the levels.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import ranked, text_or_empty
from tidecast.llm.mixing import words_in
from tidecast.sources.storage import materialise

SHARDS = 16
#: Groups that one task packs, and bundles that it makes of them when there are more.
BLOCK_ITEMS, BUNDLES = 20_000, 512
#: Parts of a group: rows are salted over so many keys, which stay together unless the group is oversize.
SALTS = 64
DIMENSIONS = ["bytes", "tokens", "rows"]


def place(vectors: np.ndarray, bins: int) -> np.ndarray:
    """Bin of each vector: largest share first, to the highest dot product with the residual capacities.

    Shares and capacities are of all vectors together, each dimension counting alike; a bin that is
    over its capacity has a negative residual. Equal products go to the bin with the lower number.
    """
    total = vectors.sum(axis=0)
    share = vectors / np.where(total > 0, total, 1.0)
    residual = np.full((bins, vectors.shape[1]), 1.0 / bins)
    out = np.empty(len(vectors), dtype=np.int64)
    for i in np.argsort(-share.max(axis=1), kind="stable"):
        at = int((residual @ share[i]).argmax())
        out[i] = at
        residual[at] -= share[i]
    return out


def packed(items: DataFrame, blocks: int, bins: int) -> DataFrame:
    """``item, bundle``: the items dealt to blocks by a hash, each block packed into ``bins``."""

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("item", ignore_index=True)
        bundle = frame["_block"].iloc[0] * bins + place(frame[DIMENSIONS].to_numpy(dtype=np.float64), bins)
        return pd.DataFrame({"item": frame["item"], "bundle": bundle})

    dealt = items.withColumn("_block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    return dealt.groupBy("_block").applyInPandas(one, "item long, bundle long")


def shards_of(items: DataFrame, shards: int = SHARDS, block_items: int = BLOCK_ITEMS, bundles: int = BUNDLES) -> DataFrame:
    """``item, shard`` for ``item, bytes, tokens, rows`` with distinct items."""
    levels = []
    while (count := items.count()) > block_items:
        placed = materialise(packed(items, -(-count // block_items), bundles), "bundles")
        levels.append(placed)
        sums = items.join(placed, "item").groupBy("bundle").agg(*[F.sum(d).alias(d) for d in DIMENSIONS])
        items = materialise(sums.withColumnRenamed("bundle", "item"), "bundle-sums")
    out = packed(items, 1, shards).select("item", F.col("bundle").cast("int").alias("shard"))
    out = materialise(out, "shards")
    for placed in reversed(levels):
        above = out.withColumnRenamed("item", "bundle")
        out = materialise(placed.join(above, "bundle").select("item", "shard"), "shards")
    return out


def placed_rows(docs: DataFrame, shards: int, block_items: int, bundles: int) -> DataFrame:
    """``row, doc_id, size, text_crc32, shard`` of every row; ``docs`` has ``row, doc_id, text``."""
    text = F.col("text").cast("string")
    sized = docs.select(
        "row",
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text_or_empty()) + 1).cast("long").alias("size"),
        words_in(text_or_empty()).alias("tokens"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text_or_empty(), 256)).alias("text_key"),
        F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int").alias("salt"),
    )
    rows = materialise(sized, "sized-rows")
    # a group is at most SALTS rows from here on, whatever share of all rows it holds
    parts = rows.groupBy("text_key", "salt").agg(
        F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")
    )
    parts = materialise(parts, "parts")
    total = parts.agg(*[F.sum(d).alias(d) for d in DIMENSIONS]).first()
    groups = parts.groupBy("text_key").agg(*[F.sum(d).alias(d) for d in DIMENSIONS])
    oversize = F.lit(False)
    for d in DIMENSIONS:
        oversize = oversize | (F.col(d) * shards > (total[d] or 0))
    groups = materialise(groups.select("*", oversize.alias("oversize"), F.monotonically_increasing_id().alias("item")), "groups")
    # items: whole groups are even numbers, salts of oversize ones (fewer than 3 x shards x SALTS) odd ones
    whole = groups.where("not oversize").select((F.col("item") * 2).alias("item"), *DIMENSIONS)
    split = groups.where("oversize").select("text_key").join(parts, "text_key")
    split = materialise(split.withColumn("item", F.monotonically_increasing_id() * 2 + 1), "split-groups")
    shard = shards_of(materialise(whole.unionByName(split.select("item", *DIMENSIONS)), "items"), shards, block_items, bundles)
    of_whole = parts.select("text_key", "salt").join(
        groups.where("not oversize").select("text_key", (F.col("item") * 2).alias("item")), "text_key"
    )
    members = materialise(of_whole.unionByName(split.select("text_key", "salt", "item")), "members")
    keyed = materialise(members.join(shard, "item").select("text_key", "salt", "shard"), "member-shards")
    return rows.join(keyed, ["text_key", "salt"]).select("row", "doc_id", "size", "text_crc32", "shard")


def shard_rows(docs: DataFrame, shards: int = SHARDS, block_items: int = BLOCK_ITEMS, bundles: int = BUNDLES) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``bytes``: the shards' sizes are near equal, and so are their tokens and rows. ``docs``
    needs ``doc_id`` and ``text``; other columns are ignored. ``size`` is the UTF-8 bytes of the text (null:
    none) plus 1; tokens are words between ASCII white space and one end. Equal texts, null and empty
    ones being equal, stand in one shard unless they are larger than a shard in bytes, tokens or
    rows. Rows that repeat an id are documents of their own, also null ids. ``slot`` counts the
    documents of a shard from 0, by id. ``grown_shard`` is null: it belongs to another law. With fewer
    groups than shards some shards are empty; an empty table gives no rows.
    """
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    placed, _ = ranked(placed_rows(numbered, shards, block_items, bundles), [F.col("shard"), F.col("doc_id").asc_nulls_last(), F.col("row")])
    starts = placed.groupBy("shard").agg(F.min("rank").alias("start"))
    return placed.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("rank") - F.col("start")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The rows of ``docs`` with all their columns and ``shard``, which a column of that name gives way to.

    The table is written once with row numbers, which rows find their shard by.
    """
    own = materialise(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row")), "numbered")
    numbered = own.select("row", F.col("doc.doc_id").alias("doc_id"), F.col("doc.text").alias("text"))
    shard = placed_rows(numbered, shards, BLOCK_ITEMS, BUNDLES).select("row", "shard")
    rest = [F.col(f"doc.`{c}`") for c in docs.columns if c != "shard"]
    return own.join(shard, "row").select(*rest, "shard")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """``docs`` as Parquet below ``path``, a folder for each shard; AQE splits what one task would write."""
    sharded(docs, shards).hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
