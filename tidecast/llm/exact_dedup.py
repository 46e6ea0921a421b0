"""Exact deduplication by deterministic block naming.

Texts are cut into blocks of ``BLOCK`` code points. Distinct blocks are sorted and numbered;
the number is the name of a block. Then adjacent names are paired and the distinct pairs are
numbered in the same way, again and again, until one name is left of each document. Names are
equal exactly if the blocks (pairs) are, so two documents of the same number of blocks have
the same last name exactly if their texts are equal: no hash stands for a text.

Cost: the text is shuffled twice (distinct blocks, and rows looking up their names), all later
levels move integers and halve in length. Distinct values are combined before each shuffle, so a block
that a third of all documents share is one row of the name table. The names of pairs and the sizes of
groups are written before rows look them up: both sides are then plain exchanges, whose hot partitions
adaptive execution splits. The names of blocks are not, as that would store the text a third time:
the rows of one hot block look up its name in one task, one block after the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import text_or_empty
from tidecast.sources.storage import materialise

BLOCK = 4096
#: Stands for a missing id in joins; no id of the tables is negative.
NO_ID = -(2**63)


def names_of(values: DataFrame, columns: list[str]) -> DataFrame:
    """Number the distinct values: sorted inside each partition, numbered without gaps in it.

    The partitions hold disjoint values, so numbers are unique; they depend on the values and
    the number of partitions only, not on the order in which rows arrive.
    """
    return (
        values.select(*columns)
        .groupBy(*columns)
        .agg(F.lit(1).alias("_one"))
        .drop("_one")
        .sortWithinPartitions(*columns)
        .withColumn("name", F.monotonically_increasing_id())
    )


def identities(docs: DataFrame, key: list[str], text: Column, block: int = BLOCK) -> DataFrame:
    """``key, blocks, name``: equal (blocks, name) means equal text. Rows repeating a key and text collapse.

    ``docs`` must hold the ``key`` columns without nulls; null text counts as empty.
    """
    cut = F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    )
    rows = docs.select(*key, cut.alias("_cut")).select(
        *key, F.size("_cut").alias("blocks"), F.posexplode("_cut").alias("pos", "block")
    )
    level = (
        rows.join(names_of(rows, ["block"]), "block")
        .select(*key, "blocks", F.col("blocks").alias("left"), "pos", "name")
    )
    level = materialise(level, "block-names")
    done = level.where("left = 1")
    while not (open_ := level.where("left > 1")).isEmpty():
        half = F.shiftright("pos", 1)
        even = F.col("pos") % 2 == 0
        pairs = open_.groupBy(*key, "blocks", "left", half.alias("pos")).agg(
            F.max(F.when(even, F.col("name"))).alias("first"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("second"),
        )
        names = materialise(names_of(pairs, ["first", "second"]), "names-of-pairs")
        level = pairs.join(names, ["first", "second"]).select(
            *key, "blocks", F.shiftright(F.col("left") + 1, 1).alias("left"), "pos", "name"
        )
        level = materialise(level, "pair-names")
        done = done.unionByName(level.where("left = 1"))
    return done.select(*key, "blocks", "name").distinct()


def exact_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored, whatever their names.
    Null text counts as empty. Of equal texts the largest ``doc_id`` stays. Rows that repeat
    both id and text count as so many documents; one of them is kept. A null ``doc_id`` loses
    against any id; a group of null ids only keeps one of its rows and has a null ``keep_id``.
    An empty table gives an empty result.
    """
    text = text_or_empty()
    source = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"),
        F.unhex(F.sha2(text, 256)).alias("_sha"),
        text.alias("_text"),
    )
    names = materialise(identities(source, ["_id", "_sha"], F.col("_text"), block), "text-names")
    copies = source.groupBy("_id", "_sha").agg(F.count(F.lit(1)).alias("_copies"))
    rows = materialise(names.join(copies, ["_id", "_sha"]), "text-rows")
    groups = rows.groupBy("blocks", "name").agg(
        F.max("_id").alias("_keep"), F.sum("_copies").alias("group_size")
    )
    groups = materialise(groups, "text-groups")
    return (
        rows.join(groups, ["blocks", "name"])
        .select("*", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_copy"))
        .select(
            F.nullif("_id", F.lit(NO_ID)).alias("doc_id"),
            F.nullif("_keep", F.lit(NO_ID)).alias("keep_id"),
            "group_size",
            ((F.col("_id") == F.col("_keep")) & (F.col("_copy") == 1)).alias("kept"),
            F.lower(F.hex("_sha")).alias("text_sha256"),
        )
    )


def drop_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Repeated rows (same id, same text) are reduced to one of them.
    """
    kept = exact_duplicates(docs, block).where("kept").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("_kept_id"), F.col("text_sha256").alias("_kept_sha")
    )
    id_, sha = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.sha2(text_or_empty(), 256)
    joined = docs.withColumns({"_kept_id": id_, "_kept_sha": sha}).join(
        kept, ["_kept_id", "_kept_sha"], "left_semi"
    )
    return joined.dropDuplicates(["_kept_id", "_kept_sha"]).select(*docs.columns)
