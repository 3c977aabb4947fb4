"""Parquet cache of raw inputs, one entry for each set of run parameters.

An entry is the folder ``<root>/<source>/<kind>/<key>.parquet``, the key being
the first 16 hexadecimal digits of the SHA-256 of the parameters' canonical
JSON text. It counts once Spark's commit marker is in it.

A run whose source and kind are known only from what it writes writes into a
folder of its own attempt first and publishes that by renaming it, so readers
see the old entry or the new one, and what a failed attempt leaves is never
taken for an entry. (On object stores a rename is a copy made by the store's
connector.) Between the two renames of a replacement the old entry lies beside
its place; whoever reads or publishes next puts it back.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.canonical import json_key
from ..session import drop_path, move_path, path_exists

#: Rows of one file of a month-partitioned entry.
FILE_ROWS = 5_000_000
#: Tasks that a month's rows are spread over when an entry is written.
MONTH_SPREAD = 32
#: Below the root: what attempts have written and not yet published.
ATTEMPTS = "_attempts"
REPLACED = ".replaced"


def params_digest(params: Mapping[str, Any]) -> str:
    """Key of the run parameters."""
    return json_key(params)


def raw_path(root: str, source: str, kind: str, params: Mapping[str, Any]) -> str:
    return f"{root.rstrip('/')}/{source}/{kind}/{params_digest(params)}.parquet"


def attempt_path(root: str) -> str:
    """A folder for one attempt, below no entry's pattern."""
    return f"{root.rstrip('/')}/{ATTEMPTS}/{uuid.uuid4().hex}"


def restore(spark: SparkSession, path: str) -> None:
    """Put a replaced entry back whose replacement did not arrive."""
    if path_exists(spark, path + REPLACED):
        if path_exists(spark, f"{path}/_SUCCESS"):
            drop_path(spark, path + REPLACED)
        else:
            move_path(spark, path + REPLACED, path)


def publish(spark: SparkSession, attempt: str, path: str) -> str:
    """Make a complete attempt the entry at ``path``, in place of any older one."""
    if not path_exists(spark, f"{attempt}/_SUCCESS"):
        raise FileNotFoundError(f"{attempt} is not complete")
    restore(spark, path)
    if path_exists(spark, path):
        move_path(spark, path, path + REPLACED)
    move_path(spark, attempt, path)
    drop_path(spark, path + REPLACED)
    return path


def write_raw(df: DataFrame, path: str, partition_by_month: bool = False) -> str:
    """Overwrite a cache entry. With ``partition_by_month`` canonical readings
    are laid out by UTC month (``ts_month=YYYY-MM``), so later time-range
    scans prune whole directories. A month is written by up to
    ``MONTH_SPREAD`` tasks (its rows are dealt by country and hour), into
    files of at most ``FILE_ROWS`` rows."""
    if partition_by_month:
        part = F.pmod(F.xxhash64("country", F.date_trunc("hour", F.col("ts_utc"))), F.lit(MONTH_SPREAD))
        (df.withColumn("ts_month", F.date_format("ts_utc", "yyyy-MM"))
           .repartition(F.col("ts_month"), part)
           .write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS)
           .partitionBy("ts_month").parquet(path))
    else:
        df.write.mode("overwrite").parquet(path)
    return path


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    restore(spark, path)
    df = spark.read.parquet(path)
    return df.drop("ts_month") if "ts_month" in df.columns else df


def latest_cached_path(spark: SparkSession, root: str) -> str | None:
    """The complete entry below ``root`` that was committed last (ties: the
    greatest path). Only the entries' commit markers are listed, never their
    files, however many these are. Unpublished attempts lie elsewhere."""
    sc = spark.sparkContext
    left = sc._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/*/*/*.parquet{REPLACED}")
    for f in left.getFileSystem(sc._jsc.hadoopConfiguration()).globStatus(left) or ():
        restore(spark, f.getPath().toString().removesuffix(REPLACED))
    pattern = sc._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/*/*/*.parquet/_SUCCESS")
    found = pattern.getFileSystem(sc._jsc.hadoopConfiguration()).globStatus(pattern)
    entries = [(f.getModificationTime(), f.getPath().getParent().toString()) for f in found or ()]
    return max(entries)[1] if entries else None


def read_latest_cached(spark: SparkSession, root: str) -> DataFrame:
    path = latest_cached_path(spark, root)
    if path is None:
        raise FileNotFoundError(f"No complete cache entry under {root}")
    return read_raw(spark, path)
