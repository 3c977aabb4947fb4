"""A corpus pipeline: from raw documents to padded training batches.

Quality rules, near-duplicate removal, redaction of personal data, mixing to
source weights, packing. Every stage works on all rows its predecessor kept and
is written as Parquet before the next one reads it. All but the last return the
columns of ``documents``, whatever these are.

A stage's result is to be written before the next stage is called: that call
drops the intermediate tables of the one before.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmetrics.llm.common import Scratch, text_or_empty
from gridmetrics.llm.minhash import near_duplicates
from gridmetrics.llm.mixing import mix_sources
from gridmetrics.llm.packing import pack
from gridmetrics.llm.pii import personal_data, redact
from gridmetrics.llm.quality_rules import quality_rules


#: Words of a shingle in near-duplicate removal.
SHINGLE_WORDS = 5

_HELD: list[Scratch] = []


def stage(f: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """Keep a stage's intermediate tables until the next stage begins."""
    @wraps(f)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _HELD:
            _HELD.pop().clear()
        before = len(Scratch.made)
        out = f(spark, docs, sf_dir)
        _HELD.extend(Scratch.made[before:])
        return out
    return begin


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules(docs, carry=docs.columns).filter("kept").select("row.*")


@stage
def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (shingles of five words):
    the one with the least doc_id, or where several texts of the group have that
    doc_id or none has any, the one of them with the least hash. Of rows equal in
    doc_id and text the one with the least hash of its row stays; texts without words stay."""
    rated = near_duplicates(docs.select("doc_id", "text"), width=SHINGLE_WORDS)
    named = F.col("component_id").isNotNull()
    grouped = rated.filter(F.col("group").isNotNull() & (F.col("kept") | ~named))
    one = grouped.groupBy("group").agg(F.min("doc_id").alias("doc_id"), F.min("text_key").alias("text_key"))
    stays = one.select("doc_id", "text_key").unionByName(
        rated.filter(F.col("group").isNull()).select("doc_id", "text_key")).distinct()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.struct(*docs.columns).alias("row"))
    same = rows["text_key"].eqNullSafe(stays["text_key"]) & rows["doc_id"].eqNullSafe(stays["doc_id"])
    return (rows.join(stays, same, "left_semi").groupBy("doc_id", "text_key")
            .agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*"))


@stage
def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by the name of its kind; n_chars follows."""
    found = personal_data(docs, carry=docs.columns).select("items", "row.*")
    clean = F.when(F.col("text").isNull(), F.col("text")).otherwise(redact(text_or_empty(), F.col("items")))
    out = found.withColumn("text", clean)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("items") > 0, F.length("text")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    mixed = mix_sources(docs, carry=docs.columns).filter("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


@stage
def batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document, with its text."""
    return pack(docs, carry=["text"]).withColumn("text", F.col("row.text")).drop("row")


STAGES = [("quality rules", quality), ("MinHash near-dedup", deduplicate), ("PII", personal),
          ("mixing", mix), ("packing", batches)]

#: Mixing and packing solve convex and dynamic programs: not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, step in STAGES[:-1]:
        docs = scratch.save(step(spark, docs, sf_dir), name.replace(" ", "_"))
        if last is not None:
            scratch.drop(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
