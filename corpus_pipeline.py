"""Corpus pipeline: quality rules, near-dedup, decontamination, mixing, sharding.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written
as Parquet to the shared folder and read again as the next one's documents. All
but the last return the columns of ``documents``; the last adds the shard.

Cases (nulls, empty texts and tables, repeated rows, extra columns) are those
of the operators; see their modules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulseboard.llm import decontaminate, quality, sharding, simhash, source_mix
from pulseboard.llm.common import table
from pulseboard.session import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.dedup(docs, shingle=simhash.SHINGLE, radius=simhash.RADIUS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mix.mix(docs)


def shard_assignment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources", source_mixing),
    ("sharding", shard_assignment),
]

#: The forest, the fingerprints and the hashes have no DuckDB form; tests/llm/test_pipeline.py holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs
