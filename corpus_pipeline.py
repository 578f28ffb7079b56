"""From documents to balanced shards of a clean, mixed corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkmart.llm.common import table
from sparkmart.llm.decontaminate import decontaminate
from sparkmart.llm.mixing import mix
from sparkmart.llm.near_copies import keep_one_of_near_copies
from sparkmart.llm.outliers import keep_good
from sparkmart.llm.sharding import byte_shards
from sparkmart.session import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source.

    Null and empty texts have no words and go. Repeated rows are judged alike; columns come back as they were.
    """
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group of near copies (five-word Jaccard similarity of 0.8 or more).

    Candidates from balls of SimHash fingerprints and their components, then from bands of minima; each link is verified.
    Repeated rows are copies, also null and empty texts of each other; null ids come last.
    """
    return keep_one_of_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item; null and empty texts overlap none, and an empty benchmark takes nothing."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents left out, kept or repeated as the weights of their sources ask; a null source is one of its own, last."""
    return mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document of the mix (a document taken twice has two places); null ids come first."""
    return byte_shards(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# Robust estimates, 64-bit hashes of shingles and seeds are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on what the one before has written.

    An empty table goes through all stages without rows; very long texts are each held whole by one task.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
