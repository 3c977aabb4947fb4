"""End-to-end jobs composed from the operators.

``eu_pipeline`` / ``global_pipeline`` return lazy frames; ``run_eu`` writes
every report, materialising the bucketed coverage frame once in the shared
folder so the KPI, DQ and history sinks do not recompute the raw scan (and
an executor loss only re-runs the stage it belongs to).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import resolve_level
from ..operators.bucket import bucket_coverage, bucketed_view, dq_rollup
from ..operators.compare import year_comparison
from ..operators.kpi import compute_kpis_with_quality
from ..operators.scope import eu_scope, normalize_ts
from ..schema import MIN_COVERAGE_PCT, READING_COLS
from ..session import scratch_path
from ..sources.cache import attempt_path, publish, raw_path, read_raw, write_raw
from ..sources.fallback import fallback_fill, kind_counts, kind_of, run_source, write_filled
from ..sources.ingest import monthly_to_long
from ..sources.sinks import (dq_latest_document, kpi_latest_document, write_json_document,
                             write_kpi_history)


@dataclass
class PipelineResult:
    raw: DataFrame
    coverage: DataFrame
    bucketed: DataFrame
    dq: DataFrame
    kpi: DataFrame
    level: str


def _requested_names(requested: DataFrame) -> DataFrame:
    """Requested country codes/names -> EU27 display names."""
    r = requested.select(F.col("country"))
    return eu_scope(r).select("country").distinct()


def eu_raw(readings: DataFrame, requested: DataFrame | None = None,
           start: str | Column | None = None, end: str | Column | None = None) -> DataFrame:
    """Canonical readings in EU scope plus ``source_kind`` (live / stub): with a
    requested country list, silent countries get the baseline for the window."""
    raw = eu_scope(normalize_ts(readings.select(*READING_COLS)))
    if requested is None:
        return raw.withColumn("source_kind", F.lit("live"))
    return fallback_fill(raw, _requested_names(requested), start, end)


def eu_pipeline(readings: DataFrame, level: str | None = None,
                min_coverage_pct: float = MIN_COVERAGE_PCT,
                requested: DataFrame | None = None,
                start: str | Column | None = None, end: str | Column | None = None) -> PipelineResult:
    """Readings -> (fallback) -> buckets + coverage -> KPI with DQ columns."""
    lv = resolve_level("eu", level)
    raw = eu_raw(readings, requested, start, end)
    cov = bucket_coverage(raw, lv, min_coverage_pct, scope=False)
    return PipelineResult(raw, cov, bucketed_view(cov), dq_rollup(cov),
                          compute_kpis_with_quality(cov, lv), lv)


def global_pipeline(monthly: DataFrame, level: str | None = None,
                    min_coverage_pct: float = MIN_COVERAGE_PCT,
                    metric_rules=None, source_rules=None, date_formats=None) -> PipelineResult:
    """Monthly global table -> canonical readings -> EU scope -> buckets -> KPI."""
    lv = resolve_level("global", level)
    raw = monthly_to_long(monthly, metric_rules, source_rules, date_formats)
    cov = bucket_coverage(raw, lv, min_coverage_pct, scope=True)
    return PipelineResult(raw, cov, bucketed_view(cov), dq_rollup(cov),
                          compute_kpis_with_quality(cov, lv), lv)


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back: cuts the
    lineage so later sinks neither recompute it nor depend on executor-local
    state."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _write_reports(spark: SparkSession, landed: DataFrame, level: str, out: str, scope: bool,
                   min_coverage_pct: float) -> dict[str, str]:
    """History CSV and the two latest documents from a landed raw table. The
    coverage frame is materialised once for all three."""
    cov = materialize(spark, bucket_coverage(landed, level, min_coverage_pct, scope=scope), "coverage")
    kpi = compute_kpis_with_quality(cov, level)
    return {
        "kpi_history_csv": write_kpi_history(kpi, f"{out}/reports/kpi_history"),
        "kpi_latest_json": write_json_document(kpi_latest_document(kpi, level), f"{out}/reports/kpi_latest"),
        "dq_latest_json": write_json_document(dq_latest_document(dq_rollup(cov), level),
                                              f"{out}/reports/dq_report_latest"),
    }


def run_eu(spark: SparkSession, readings: DataFrame, out_dir: str, level: str | None = None,
           requested: DataFrame | None = None, start=None, end=None,
           params: dict | None = None, min_coverage_pct: float = MIN_COVERAGE_PCT) -> dict[str, str]:
    """EU run: raw cache, history CSV and the two latest documents.

    The filled readings are written once, into the folder of this attempt, from
    one scan of the feed; what decides on their label is counted on the way. The
    label says under which source and kind the entry is published (an all-stub
    run is one of its own), so a stub entry never takes the place of a live one.
    """
    lv, out = resolve_level("eu", level), out_dir.rstrip("/")
    attempt = attempt_path(f"{out}/raw")
    if requested is None:
        counts = Observation("run_kind")
        write_raw(eu_raw(readings).observe(counts, *kind_counts()), attempt)
        kind = kind_of(counts.get["live"], counts.get["stub"])
    else:
        scoped = eu_scope(normalize_ts(readings.select(*READING_COLS)))
        kind = kind_of(*write_filled(scoped, _requested_names(requested), start, end, attempt))
    source = run_source(kind)
    cache = publish(spark, attempt, raw_path(f"{out}/raw", source, kind, dict(params or {}, mode="eu", agg=lv, kind=kind)))
    reports = _write_reports(spark, read_raw(spark, cache), lv, out, False, min_coverage_pct)
    return {"raw_cache": cache, "raw_source": source, "raw_kind": kind, **reports}


def run_global(spark: SparkSession, monthly: DataFrame, out_dir: str, level: str | None = None,
               params: dict | None = None, min_coverage_pct: float = MIN_COVERAGE_PCT,
               metric_rules=None, source_rules=None, date_formats=None) -> dict[str, str]:
    """Global run over a landed monthly table: same reports, month level by default."""
    lv, out = resolve_level("global", level), out_dir.rstrip("/")
    raw = monthly_to_long(monthly, metric_rules, source_rules, date_formats)
    cache = write_raw(raw, raw_path(f"{out}/raw", "ember", "monthly_kpi", dict(params or {}, mode="global", agg=lv, kind="monthly_kpi")))
    reports = _write_reports(spark, read_raw(spark, cache), lv, out, True, min_coverage_pct)
    return {"raw_cache": cache, "raw_source": "ember", "raw_kind": "monthly_kpi", **reports}


def run_pipeline(spark: SparkSession, mode: str, data: DataFrame, out_dir: str,
                 level: str | None = None, **kw) -> dict[str, str]:
    """Entry point for both modes (``eu``: canonical readings, ``global``: a
    monthly table); the level is resolved per mode (default day / month)."""
    runs = {"eu": run_eu, "global": run_global}
    if mode not in runs:
        raise ValueError(f"Unknown mode: {mode}")
    return runs[mode](spark, data, out_dir, level, **kw)


def compare_years(kpi_history: DataFrame, years: Sequence[int] = (2015, 2024),
                  window_days: int | None = None) -> DataFrame:
    """Year comparison over a KPI history (whole years, or the first
    ``window_days`` of each)."""
    return year_comparison(kpi_history, years, window_days)
