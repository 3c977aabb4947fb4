"""Time-bucket resampling, interior gap filling and data-quality coverage.

Plan shape: partial+final hash aggregate on (series, bucket) -> window
``lead`` per series over the *aggregated* rows (bounded by the calendar, not
by the raw volume) -> ``explode(sequence)`` generator for gaps; at the hour
level short gaps in place and long ones dealt out in chunks, both from the
same exchanges. No joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bucket_start, check_level, expected_points
from ..functions.time import chunked_range, nth_step, steps_between

from ..schema import METRIC_AGG, MIN_COVERAGE_PCT, SERIES_COLS
from ..session import default_parallelism
from .scope import eu_scope, normalize_ts

GAP_CHUNK = 4096   # longest array any single gap row materialises


@dataclass(frozen=True)
class DQConfig:
    min_coverage_pct: float = MIN_COVERAGE_PCT


def bucket_values(readings: DataFrame, level: str) -> DataFrame:
    """One row per (series, bucket): sum for additive metrics (0.0 when all
    values are NULL), mean for price, and the count of non-NULL points.
    Metrics without an aggregate rule and rows with a NULL key are dropped."""
    lv = check_level(level)
    # one IsNotNull per key column (not a single dropna predicate), so each
    # reaches the parquet reader through the scope join
    keys_present = F.lit(True)
    for c in ["ts_utc", *SERIES_COLS]:
        keys_present = keys_present & F.col(c).isNotNull()
    rows = readings.where(F.col("metric").isin(list(METRIC_AGG)) & keys_present)
    mean_metrics = [m for m, a in METRIC_AGG.items() if a == "mean"]
    agg = rows.groupBy(*SERIES_COLS, bucket_start("ts_utc", lv).alias("ts_utc")).agg(
        F.sum("value").alias("_sum"), F.count("value").alias("actual_points"))
    # mean = sum / count (exactly what avg computes), so one sum buffer serves both
    mean = F.col("_sum") / F.nullif(F.col("actual_points").cast("double"), F.lit(0.0))
    value = (F.when(F.col("metric").isin(mean_metrics), mean)
              .otherwise(F.coalesce(F.col("_sum"), F.lit(0.0))))
    return agg.select(*SERIES_COLS, "ts_utc", value.alias("value"), "actual_points")


def fill_interior_gaps(bucketed: DataFrame, level: str) -> DataFrame:
    """Insert the missing buckets between each series' first and last bucket:
    additive metrics get 0.0, price NULL, and 0 points. No leading/trailing fill.

    An hourly gap of more than ``GAP_CHUNK`` buckets (a series with a stray
    far-off timestamp, up to 88 million hours away) is expanded by many tasks. At the
    other levels the calendar itself bounds a gap to 3.7 million buckets, which
    stay in their task."""
    lv = check_level(level)
    mean_metrics = [m for m, a in METRIC_AGG.items() if a == "mean"]
    w = Window.partitionBy(*SERIES_COLS).orderBy("ts_utc")
    nxt = bucketed.withColumn("_next", F.lead("ts_utc").over(w))
    # buckets from this one up to (not including) the next: 1 + the gap length
    n = (F.when(F.col("_next").isNull(), F.lit(1).cast("long"))
          .otherwise(steps_between(F.col("ts_utc"), F.col("_next"), lv)))
    keep = [*SERIES_COLS, "ts_utc", "value", "actual_points"]
    rows = nxt.select(*keep, n.alias("_n"))
    ids, lo, hi = chunked_range(F.col("_n"), GAP_CHUNK)

    def expand(some: DataFrame, deal: bool = False) -> DataFrame:
        chunks = some.select(*keep, "_n", F.explode(ids).alias("_c"))
        if deal:
            chunks = chunks.repartition(default_parallelism(bucketed.sparkSession), *SERIES_COLS, "ts_utc", "_c")
        return (chunks.select(*keep, F.explode(F.sequence(lo(F.col("_c")), hi(F.col("_c")))).alias("_pos"))
                      .withColumn("_b", nth_step(F.col("ts_utc"), F.col("_pos"), lv)))

    if lv == "hour":  # ordinary rows stay in their task; the chunks of a long gap are dealt over the cluster
        g = expand(rows.where(F.col("_n") <= GAP_CHUNK)).unionByName(expand(rows.where(F.col("_n") > GAP_CHUNK), deal=True))
    else:
        g = expand(rows)
    filled = F.col("_pos") > 0
    value = (F.when(~filled, F.col("value"))
              .when(F.col("metric").isin(mean_metrics), F.lit(None).cast("double"))
              .otherwise(F.lit(0.0)))
    return g.select(*SERIES_COLS, F.col("_b").alias("ts_utc"), value.alias("value"),
                    F.when(filled, F.lit(0).cast("long")).otherwise(F.col("actual_points")).alias("actual_points"))


def with_coverage(filled: DataFrame, level: str, min_coverage_pct: float = MIN_COVERAGE_PCT) -> DataFrame:
    lv = check_level(level)
    exp = expected_points("ts_utc", lv)
    cov = (F.col("actual_points") / F.col("expected_points")) * F.lit(100.0)
    return (filled.withColumn("period", F.lit(lv))
                  .withColumn("expected_points", exp)
                  .withColumn("coverage_pct", cov)
                  .withColumn("quality_flag",
                              F.when(F.col("coverage_pct") < F.lit(float(min_coverage_pct)),
                                     F.lit("missing_interval")).otherwise(F.lit("ok"))))


def bucket_coverage(readings: DataFrame, level: str, min_coverage_pct: float = MIN_COVERAGE_PCT,
                    scope: bool = True, fill_gaps: bool = True) -> DataFrame:
    """Full resample of canonical readings: timestamps parsed, EU scope applied
    (when ``scope``), bucketed, interior gaps filled and coverage flagged.

    Columns: series keys, ts_utc (bucket), value, actual_points, period,
    expected_points, coverage_pct, quality_flag.
    """
    lv = check_level(level)
    df = normalize_ts(readings, "ts_utc")
    if scope:
        df = eu_scope(df)
    b = bucket_values(df, lv)
    if fill_gaps:
        b = fill_interior_gaps(b, lv)
    return with_coverage(b, lv, min_coverage_pct)


def bucketed_view(cov: DataFrame) -> DataFrame:
    """Canonical bucketed readings (the original quality flag replaced)."""
    return cov.select("ts_utc", "period", *SERIES_COLS[:2], "metric", "energy_source", "value",
                      "unit", "quality_flag", "source_system")


def dq_rollup(cov: DataFrame) -> DataFrame:
    """Per bucket and country: lowest series coverage and number of flagged series."""
    return (cov.groupBy("ts_utc", "region", "country", "period")
               .agg(F.min("coverage_pct").alias("coverage_pct"),
                    F.count_if(F.col("quality_flag") != F.lit("ok")).cast("long").alias("issue_count")))


def aggregate_timeseries(readings: DataFrame, level: str, dq: DQConfig | None = None,
                         scope: bool = True) -> tuple[DataFrame, DataFrame]:
    """(bucketed readings, dq per bucket) — both lazy, sharing one plan prefix."""
    dq = dq or DQConfig()
    cov = bucket_coverage(readings, level, dq.min_coverage_pct, scope=scope)
    return bucketed_view(cov), dq_rollup(cov)
