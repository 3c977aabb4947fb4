"""Country KPIs from bucketed readings.

The energy mix, price statistics and net import all come from the same
bucketed table and share the key (bucket, region, country), so instead of
three aggregates joined back together they are one conditional hash
aggregate (partial + final, skew tolerant). The data-quality columns come
either from the same pass (``compute_kpis_with_quality``) or from a left join
with an external DQ table (``attach_dq``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import KPI_COLS, KPI_CORE_COLS, MWH_COLS, PRICE_UNIT_PREFERRED

SOURCES = ("renewable", "fossil", "nuclear")
_KEY = ["ts_utc", "region", "country"]


def _is_gen(source: str | None = None) -> Column:
    c = F.col("metric") == F.lit("generation")
    if source is None:
        return c & F.col("energy_source").isin(list(SOURCES))
    return c & (F.col("energy_source") == F.lit(source))


def _is(metric: str) -> Column:
    return F.col("metric") == F.lit(metric)


def kpi_row_filter() -> Column:
    """Rows that make a KPI key: generation of a known source, price, net import.
    (``load`` is bucketed but never becomes a KPI.)"""
    return _is_gen() | _is("price") | _is("net_import")


def _kpi_aggs() -> list[Column]:
    mwh = {s: F.coalesce(F.sum(F.when(_is_gen(s), F.col("value"))), F.lit(0.0)).alias(f"{s}_mwh")
           for s in SOURCES}
    price = F.when(_is("price"), F.col("value"))
    first_unit = F.min_by(F.when(_is("price"), F.col("unit")),
                          F.when(_is("price"), F.struct("energy_source", "unit", "source_system")))
    return [
        *mwh.values(),
        F.avg(price).alias("avg_price"),
        F.stddev_samp(price).alias("price_volatility"),
        first_unit.alias("price_unit"),
        F.coalesce(F.sum(F.when(_is("net_import"), F.col("value"))), F.lit(0.0)).alias("net_import_mwh"),
    ]


def _finish(agg: DataFrame, period: str) -> DataFrame:
    total = F.col("renewable_mwh") + F.col("fossil_mwh") + F.col("nuclear_mwh")
    out = agg.withColumn("total_generation_mwh", total)
    for s in SOURCES:
        out = out.withColumn(f"{s}_share_pct",
                             (F.col(f"{s}_mwh") / F.nullif(F.col("total_generation_mwh"), F.lit(0.0)))
                             * F.lit(100.0))
    return (out.withColumnRenamed("ts_utc", "period_start_utc")
               .withColumn("period", F.lit(period)))


def compute_kpis(bucketed: DataFrame, period: str, dq: DataFrame | None = None) -> DataFrame:
    """KPI rows per (period_start_utc, region, country). With ``dq`` the
    data-quality columns are attached by a left join; without it they are
    NULL."""
    agg = (bucketed.where(kpi_row_filter())
                   .withColumn("ts_utc", F.col("ts_utc").cast("timestamp"))
                   .groupBy(*_KEY).agg(*_kpi_aggs()))
    kpi = _finish(agg, period).select(*KPI_CORE_COLS)
    if dq is None:
        return kpi.select(*KPI_CORE_COLS, F.lit(None).cast("double").alias("dq_coverage_pct"),
                          F.lit(None).cast("long").alias("dq_issue_count"))
    return attach_dq(kpi, dq, period)


def kpi_core(bucketed: DataFrame, period: str) -> DataFrame:
    """KPI columns without the data-quality pair."""
    return compute_kpis(bucketed, period).select(*KPI_CORE_COLS)


def attach_dq(kpi: DataFrame, dq: DataFrame, period: str) -> DataFrame:
    """Left join of the DQ roll-up (this period only; min coverage, summed
    issues per key). Both sides grow with the data, so no broadcast is forced:
    AQE picks broadcast or sort-merge from runtime sizes."""
    d = (dq.where(F.col("period") == F.lit(period))
           .withColumn("ts_utc", F.col("ts_utc").cast("timestamp"))
           .groupBy(F.col("ts_utc").alias("period_start_utc"), "region", "country", "period")
           .agg(F.min("coverage_pct").alias("dq_coverage_pct"),
                F.sum("issue_count").cast("long").alias("dq_issue_count")))
    base = kpi.select(*KPI_CORE_COLS)
    return base.join(d, ["period_start_utc", "region", "country", "period"], "left").select(*KPI_COLS)


def compute_kpis_with_quality(cov: DataFrame, period: str) -> DataFrame:
    """KPIs and their DQ columns in ONE aggregate over the coverage frame
    (output of ``bucket_coverage``): the DQ roll-up runs over every bucketed
    series of the key, the KPI parts over the KPI rows only, and keys without
    any KPI row are dropped. Equal to ``compute_kpis(bucketed, dq=dq_rollup)``
    without the join and without scanning the buckets twice."""
    agg = (cov.groupBy(*_KEY).agg(
        *_kpi_aggs(),
        F.min("coverage_pct").alias("dq_coverage_pct"),
        F.count_if(F.col("quality_flag") != F.lit("ok")).cast("long").alias("dq_issue_count"),
        F.max(kpi_row_filter().cast("int")).alias("_has_kpi"))
        .where(F.col("_has_kpi") == 1))
    return _finish(agg, period).select(*KPI_COLS)


def energy_mix(bucketed: DataFrame) -> DataFrame:
    """Generation per source pivoted to three fixed columns, total and shares."""
    agg = (bucketed.where(_is_gen())
                   .groupBy(*_KEY)
                   .agg(*[F.coalesce(F.sum(F.when(F.col("energy_source") == s, F.col("value"))),
                                     F.lit(0.0)).alias(f"{s}_mwh") for s in SOURCES]))
    out = _finish(agg, "").drop("period")
    return out.select("period_start_utc", "region", "country", "renewable_mwh", "fossil_mwh",
                      "nuclear_mwh", "total_generation_mwh", "renewable_share_pct",
                      "fossil_share_pct", "nuclear_share_pct")


def price_stats(bucketed: DataFrame, preferred_unit: str = PRICE_UNIT_PREFERRED) -> DataFrame:
    """Mean, sample standard deviation and first unit of bucketed prices."""
    p = bucketed.where(_is("price"))
    return (p.groupBy(*_KEY)
             .agg(F.avg("value").alias("avg_price"),
                  F.stddev_samp("value").alias("price_volatility"),
                  F.coalesce(F.min_by("unit", F.struct("energy_source", "unit", "source_system")),
                             F.lit(preferred_unit)).alias("price_unit"))
             .withColumnRenamed("ts_utc", "period_start_utc"))


def net_import(bucketed: DataFrame) -> DataFrame:
    return (bucketed.where(_is("net_import"))
                    .groupBy(*_KEY).agg(F.sum("value").alias("net_import_mwh"))
                    .withColumnRenamed("ts_utc", "period_start_utc"))


def fill_mwh(kpi: DataFrame) -> DataFrame:
    return kpi.fillna(0.0, subset=[c for c in MWH_COLS if c in kpi.columns])
