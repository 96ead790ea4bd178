"""Corpus pipeline over ``documents``: each stage applies one operator to all its predecessor kept.

Quality classifier (documents it rejects go), near-duplicates (one document of each class stays),
benchmark decontamination (documents with an item go), mixing (documents stay as often as their rate says;
the clean domain keeps its size, low quality and toxicity are cut down), sharding. Stages but the last return
the columns they got. Null and odd rows are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flightlake.llm import decontaminate, mixing, near_dedup, quality, sharding
from flightlake.llm.common import table, written
from flightlake.llm.queries import MIXTURE, SHARDS, domain


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, table(spark, sf_dir, "labels"), domain(), MIXTURE, most=1.0)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_by_size(docs, SHARDS)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_domains),
    ("sharding", assign_shards),
]
#: The stages are not SQL: trained models, randomised search. Tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
