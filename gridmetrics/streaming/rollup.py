"""Incremental bucket roll-up of landed readings (Structured Streaming).

The batch resample (``operators.bucket``) fills interior gaps, which needs
the *next* bucket of a series and so cannot be emitted incrementally. This
module runs the part that can: per (series, bucket) sum / mean / point count
and coverage, finalised once the watermark passes the bucket end (append
mode). Hour and day buckets are fixed windows; the Monday-ending week is a
7-day window shifted to start on Tuesday 00:00 (the epoch was a Thursday).
Months are not fixed-length windows and are rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import check_level, expected_points
from ..operators.scope import eu_scope
from ..schema import METRIC_AGG, MIN_COVERAGE_PCT, READINGS, SERIES_COLS

_WINDOW = {"hour": ("1 hour", None), "day": ("1 day", None), "week": ("7 days", "5 days")}


def read_readings_stream(spark, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream canonical readings parquet files landing under ``path``."""
    r = spark.readStream.schema(READINGS)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def stream_bucket_rollup(readings: DataFrame, level: str, watermark: str = "2 hours",
                         min_coverage_pct: float = MIN_COVERAGE_PCT, scope: bool = True) -> DataFrame:
    """Streaming per-bucket values, point counts and coverage flags."""
    lv = check_level(level)
    if lv not in _WINDOW:
        raise ValueError("month buckets are not fixed-length windows; use the batch resample")
    dur, start = _WINDOW[lv]
    df = eu_scope(readings) if scope else readings
    df = (df.where(F.col("metric").isin(list(METRIC_AGG)))
            .dropna(subset=["ts_utc", *SERIES_COLS])
            .withWatermark("ts_utc", watermark))
    win = F.window("ts_utc", dur, dur, start) if start else F.window("ts_utc", dur)
    mean_metrics = [m for m, a in METRIC_AGG.items() if a == "mean"]
    agg = df.groupBy(win.alias("w"), *SERIES_COLS).agg(
        F.sum("value").alias("_sum"), F.avg("value").alias("_avg"), F.count("value").alias("actual_points"))
    label = (F.col("w.end") - F.expr("INTERVAL 1 DAY")) if lv == "week" else F.col("w.start")
    value = (F.when(F.col("metric").isin(mean_metrics), F.col("_avg"))
              .otherwise(F.coalesce(F.col("_sum"), F.lit(0.0))))
    out = agg.select(label.alias("ts_utc"), *SERIES_COLS, value.alias("value"), "actual_points",
                     F.lit(lv).alias("period"))
    cov = (F.col("actual_points") / expected_points("ts_utc", lv)) * F.lit(100.0)
    return (out.withColumn("coverage_pct", cov)
               .withColumn("quality_flag", F.when(F.col("coverage_pct") < F.lit(float(min_coverage_pct)),
                                                  F.lit("missing_interval")).otherwise(F.lit("ok"))))
