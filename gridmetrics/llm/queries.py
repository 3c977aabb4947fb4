"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (divergence, embedding_dedup, importance, language_id, minhash, mixing, packing, pii, quality_rules, sharding, suffix_dedup,
               token_output, whitening)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


@query("op1_pii")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents", "doc_id", "text")).drop("items")


@query("op2_sharding")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op3_suffix_dedup", suffix_dedup.oracle())
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op4_minhash", minhash.oracle())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), width=2).drop("text_key", "group")


@query("op5_token_output")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_output(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op6_embedding_dedup", embedding_dedup.oracle())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op8_importance")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance_resample(table(spark, sf_dir, "documents", "doc_id", "text"),
                                          table(spark, sf_dir, "labels", "doc_id", "quality"))


@query("op9_quality_rules", quality_rules.oracle())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))


@query("op10_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


@query("op11_divergence", divergence.oracle())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents", "text", "lang", "source"))


@query("op12_language_id")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def _pipeline() -> None:
    import corpus_pipeline

    QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


_pipeline()
