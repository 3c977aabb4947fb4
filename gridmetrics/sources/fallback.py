"""Fallback fill: requested countries that delivered no generation and no
price rows in the run window get baseline rows instead."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.scope import as_ts
from ..schema import EU27, READING_COLS
from .grid import baseline_hourly


#: A country with a row of one of these has delivered.
DELIVERS = ("generation", "price")


def in_window(observed: DataFrame, start: str | Column, end: str | Column) -> DataFrame:
    return observed.where((F.col("ts_utc") >= as_ts(start)) & (F.col("ts_utc") < as_ts(end)))


def live_rows(observed: DataFrame, asked: DataFrame, start: str | Column, end: str | Column) -> DataFrame:
    """Observed rows of the asked countries inside ``[start, end)``."""
    live = in_window(observed, start, end).join(asked, "country", "left_semi")
    return live.select(*READING_COLS, F.lit("live").alias("source_kind"))


def stub_rows(silent: DataFrame, start: str | Column, end: str | Column) -> DataFrame:
    """The hourly baseline of countries over ``[start, end)``."""
    stub = baseline_hourly(silent.select("country", as_ts(start).alias("start"), as_ts(end).alias("end")))
    return stub.select(*READING_COLS, F.lit("stub").alias("source_kind"))


def fallback_fill(observed: DataFrame, requested: DataFrame, start: str | Column, end: str | Column) -> DataFrame:
    """``observed``: canonical readings; ``requested``: one ``country`` column.

    Observed rows of requested countries inside ``[start, end)`` are kept
    (``source_kind = 'live'``); each requested country with no generation and
    no price row there is filled with the hourly baseline (``'stub'``). One
    aggregate over the window says which countries delivered; the country sets
    are joined, never collected, and Spark sizes the joins at run time (a
    skewed country key is split). ``write_filled`` gives the same rows in one
    scan of the feed, where they are written anyway.
    """
    asked = requested.select("country").where(F.col("country").isNotNull()).distinct()
    delivered = (in_window(observed, start, end).where(F.col("metric").isin(*DELIVERS)).groupBy("country")
                 .agg(F.lit(True).alias("delivered")))
    silent = asked.join(delivered, "country", "left").where(F.col("delivered").isNull())
    return live_rows(observed, asked, start, end).unionByName(stub_rows(silent, start, end))


def write_filled(observed: DataFrame, requested: DataFrame, start: str | Column, end: str | Column, path: str) -> tuple[int, int]:
    """Write the rows of ``fallback_fill`` to a new Parquet folder in one scan of
    the feed and return how many are live and stub.

    ``observed`` and ``requested`` are in EU scope. While the live rows are
    written, one flag for each of the 27 countries is gathered along the way;
    then the baseline of those that stayed silent is added to the folder.
    """
    spark = observed.sparkSession
    asked = requested.select("country").where(F.col("country").isNotNull()).distinct()
    names = sorted(name for _, name in EU27)
    seen = Observation("delivered")
    delivers = F.col("metric").isin(*DELIVERS)
    flags = [F.coalesce(F.bool_or(delivers & (F.col("country") == n)), F.lit(False)).alias(f"c{i}") for i, n in enumerate(names)]
    live_rows(observed, asked, start, end).observe(seen, F.count(F.lit(1)).alias("live"), *flags).write.parquet(path)
    silent = [n for i, n in enumerate(names) if not seen.get[f"c{i}"]]
    rows = spark.createDataFrame([(n,) for n in silent], "country string").join(asked, "country", "left_semi")
    added = Observation("baseline")
    stub_rows(rows, start, end).observe(added, F.count(F.lit(1)).alias("stub")).write.mode("append").parquet(path)
    return seen.get["live"], added.get["stub"]


def kind_counts() -> tuple[Column, Column]:
    """What a run's label depends on: numbers of live and stub rows."""
    return (F.count_if(F.col("source_kind") == "live").alias("live"), F.count_if(F.col("source_kind") == "stub").alias("stub"))


def kind_of(live: int, stub: int) -> str:
    """The label by numbers of rows, as ``run_kind`` gives it."""
    return "eu_stub" if not live else "eu_live_with_stub" if stub else "eu_live"


def run_kind(filled: DataFrame) -> DataFrame:
    """One-row label of a run: ``eu_live``, ``eu_live_with_stub`` or ``eu_stub``
    (no live row at all, an empty run included)."""
    agg = filled.agg(*kind_counts())
    return agg.select(F.when(F.col("live") == 0, F.lit("eu_stub"))
                       .when(F.col("stub") > 0, F.lit("eu_live_with_stub"))
                       .otherwise(F.lit("eu_live")).alias("raw_kind"))


def run_source(kind: str) -> str:
    """The source that a run reports: an all-stub run says so."""
    return "entsoe_stub" if kind == "eu_stub" else "entsoe"
