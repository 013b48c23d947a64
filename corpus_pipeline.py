"""A corpus pipeline: quality rules, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is written as
Parquet to the shared folder and read again as the next one's documents. All stages but the last return the
columns of the documents; the last adds the virtual slot and the shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eligo.llm import decontaminate, mixing, quality, sharding, simhash
from eligo.llm.common import documents, work_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a base rule or a certified cutoff rejects go."""
    return quality.kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), joint=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays."""
    return simhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, exact or within the edit limit, go."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are dropped, kept or repeated as their source's target asks."""
    return mixing.mixed_documents(docs)


def shard_placement(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document goes to a shard, under a slot map balanced by bytes."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mixing),
    ("sharding", shard_placement),
]

# Fingerprints, embeddings and hashed draws cannot be written in SQL; tests/llm/test_pipeline.py holds the rows
# against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        path = work_path(spark, f"pipeline-{i + 1}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
