"""A corpus through five stages: each gets what its predecessor kept, as a stored table.

Quality classifier, SimHash near-dedup, benchmark decontamination, mixing, sharding. All but
the last return the columns of ``documents``; the last adds slot and shard. Mixing returns a
document as often as the mix takes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatledger.llm import decontaminate, mixing, quality, sharding, simhash
from chatledger.llm.common import stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, each as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with slot and shard."""
    return sharding.with_shard(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", near_deduplicated),
    ("benchmark decontamination", decontaminated),
    ("mixing to target weights", mixed),
    ("sharding", sharded),
]

#: SQL expresses none of the first four stages; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
