"""Training-text pipeline: language ID, near-dedup, decontamination, mixing, shards.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps, which
are written as Parquet in the shared folder and read again as the next stage's
``docs``; the last adds shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mediamart.llm import decontaminate, language_id, mixing, near_dup, sharding
from mediamart.llm.common import table
from mediamart.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the corpus teaches; others go."""
    return language_id.reject_unknown(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near duplicates."""
    return near_dup.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item leaks."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeated towards the square root of their sizes; as many rows on
    average as before."""
    return mixing.poisson_mixture(docs).drop("copy")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A uniform shuffle into 16 shards of equal counts."""
    return sharding.shuffle_into_shards(docs, shards=16)


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing to target weights", mix_sources),
    ("sharding", shard),
]

# Language models, MinHash and the draws have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage{i}")
    return docs
