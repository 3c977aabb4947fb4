"""Report sinks: history CSV, latest-KPI and latest-DQ JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import iso_z
from ..operators.reports import dq_latest_items, kpi_latest_items
from ..operators.scope import export_scope
from ..schema import KPI, KPI_COLS, REPORT_COVERAGE_PCT
from ..session import path_exists
from .csvfiles import read_csv, write_csv

def write_kpi_history(kpi: DataFrame, path: str) -> str:
    """History file of the report scope, overwritten each run, in key order."""
    out = export_scope(kpi).select(*[c for c in KPI_COLS if c in kpi.columns])
    return write_csv(out, path, sort_by=["region", "country", "period_start_utc"])


def read_kpi_history(spark: SparkSession, path: str) -> DataFrame:
    """History scan; a missing history reads as an empty KPI table."""
    return read_csv(spark, path, KPI) if path_exists(spark, path) else spark.createDataFrame([], KPI)


def kpi_latest_document(kpi: DataFrame, period: str) -> DataFrame:
    """One-row document. Items are at most one per EU27 country (report
    scope), so collecting them into one array is bounded by construction."""
    items = kpi_latest_items(kpi)
    return items.agg(
        iso_z(F.current_timestamp()).alias("generated_at_utc"),
        F.lit(period).alias("period"),
        F.max("period_start_utc").alias("period_start_utc"),
        F.array_sort(F.collect_list(F.struct(*items.columns))).alias("items"))


def dq_latest_document(dq: DataFrame, period: str, threshold: float = REPORT_COVERAGE_PCT) -> DataFrame:
    items = dq_latest_items(dq, period)
    return items.agg(
        iso_z(F.current_timestamp()).alias("generated_at_utc"),
        F.lit(period).alias("period"),
        iso_z(F.max("ts_utc")).alias("ts_utc"),
        F.struct(F.min("coverage_pct").alias("min_coverage_pct"),
                 F.count_if(F.col("coverage_pct") < threshold).cast("long").alias("countries_below_98pct"),
                 F.coalesce(F.sum("issue_count"), F.lit(0)).cast("long").alias("total_issue_count")
                 ).alias("summary"),
        F.array_sort(F.collect_list(F.struct(
            "region", "country", iso_z("ts_utc").alias("ts_utc"), "coverage_pct", "issue_count"))).alias("items"))


def write_json_document(doc: DataFrame, path: str) -> str:
    """Write a one-row document as JSON (NULL fields kept as ``null``)."""
    doc.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def read_json_document(spark: SparkSession, path: str) -> DataFrame:
    """Read a written report document back (one row; ``items`` as an array of structs)."""
    return spark.read.json(path)
