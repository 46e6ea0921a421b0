"""From raw documents to packed training sequences: five stages over the pipeline operators.

Each stage is written as Parquet into the shared folder and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidecast.llm import exact_dedup, language, mixing, packing, simhash
from tidecast.llm.common import documents
from tidecast.sources.storage import materialise

#: (letters, cosine): a document of so many letters or more whose cosine with every prototype is lower has no
#: language of those learnt. Cosines of unrelated vectors vary by 1/32 (1024 dimensions); texts of a learnt
#: language reach 0.1 from about 20 letters on, and those of less than 10 letters say too little.
BORDERS = ((10, 1.5 / 32), (20, 2.25 / 32))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; those without letters, or without likeness to any language, go."""
    return language.recognised(docs, BORDERS)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the document with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of sources with a raised weight more often."""
    return mixing.draws(docs).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 4096 tokens."""
    return packing.packed_sequences(docs)


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither the fingerprints nor the packing; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
