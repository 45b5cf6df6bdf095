"""The corpus pipeline: quality rules, near-duplicates, decontamination, mixing, sharding.

A stage's documents are those that the stage before has written, so a stage begins by removing
the intermediate tables of the stages before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, near_duplicates, quality, sharding
from tidemark.llm.common import recorded_scratch, release_scratch, table
from tidemark.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality.keep_good(docs)


def near_duplicate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (5-word shingles, similarity 0.8)."""
    return near_duplicates.keep_one_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; not at all, once, or up to three times."""
    return mixing.mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard (0 to 7, near-equal bytes) and their slot in it; columns of
    these names give way."""
    return sharding.shard(docs.drop("shard", "slot")).drop("_op4_size", "_op4_crc") \
        .withColumnsRenamed({"_op4_shard": "shard", "_op4_slot": "slot"})


# Intermediate tables of the stage that ran last.
_tables: list[str] = []
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _cleared(stage: Stage) -> Stage:
    """The stage, after the tables that earlier ones needed are gone."""
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_scratch(spark, _tables)
        with recorded_scratch(_tables):
            return stage(spark, docs, sf_dir)

    run.__doc__ = stage.__doc__
    return run


STAGES = [
    ("quality rules", _cleared(quality_rules)),
    ("MinHash near-duplicates", _cleared(near_duplicate_documents)),
    ("benchmark decontamination", _cleared(decontamination)),
    ("mixing to target weights", _cleared(mixture)),
    ("sharding", _cleared(sharded)),
]
# Hashing words into sketches and the subset-sum program have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
    return docs
