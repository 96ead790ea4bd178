"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate, langid, licenses, mixing, near_dedup, neighbours, periodic, pii, quality, secrets, sharding, sql, tokens, whitening,
)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
TOKEN_LIMIT = 2048
SHARDS = 8
NEAREST = 10
COMPONENTS = 16
#: The key of the surrogates; a deployment passes its own secret.
PII_KEY = b"demonstration key"
#: Domains told by the labelled table, and the weights of the mixture.
MIXTURE = {"clean": 0.97, "low": 0.02, "toxic": 0.01}


def domain() -> Column:
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).drop("node", "text_key")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), domain(), MIXTURE)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), TOKEN_LIMIT)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_size(table(spark, sf_dir, "documents"), SHARDS)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, NEAREST)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whitening.whole_vectors(table(spark, sf_dir, "embeddings"))
    return whitening.whiten(vectors, whitening.fit(vectors, COMPONENTS))


def op12_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.find_runs(periodic.with_repeats(table(spark, sf_dir, "documents"))))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_near_duplicates, op2_mixing, op3_licenses, op4_token_counts, op5_sharding, op6_quality, op7_pii, op8_secrets, op9_benchmark_leaks, op10_nearest,
        op11_whitening, op12_languages, op13_periodic_runs,
    )}


def oracle_sql() -> dict[str, str]:
    return {"op1_near_duplicates": sql.OP1, "op5_sharding": sql.OP5}
