"""Report-side operators: latest rows, summaries, profiles, chart data.

Everything that "picks the latest" is an aggregate (``max_by`` with a total
order) rather than a sort or an unbounded window, so a country holding a
third of the rows is reduced map-side before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import iso_z
from ..schema import (BUBBLE_MAX, DELTA_DEFAULT_BOUNDS, LATEST_DQ_ITEM_COLS,
                      LATEST_KPI_ITEM_COLS, REPORT_COVERAGE_PCT)
from .scope import export_scope


def latest_per_key(df: DataFrame, keys: Sequence[str], ts_col: str) -> DataFrame:
    """The row with the greatest ``ts_col`` per key (ties: greatest remaining
    columns, so the pick is deterministic)."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(ts_col), *[F.col(c) for c in rest if c != ts_col])
    picked = (df.where(F.col(ts_col).isNotNull())
                .groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")))
    return picked.select(*keys, *[F.col("_r")[c].alias(c) for c in rest])


def kpi_latest_items(kpi: DataFrame) -> DataFrame:
    """Latest KPI row per (region, country) inside the report scope, with the
    bucket start rendered as ISO-8601 ``Z`` text."""
    latest = latest_per_key(export_scope(kpi), ["region", "country"], "period_start_utc")
    cols = [c for c in LATEST_KPI_ITEM_COLS if c in latest.columns]
    return latest.withColumn("period_start_utc", iso_z("period_start_utc")).select(*cols)


def dq_latest_items(dq: DataFrame, period: str) -> DataFrame:
    d = dq.where(F.col("period") == F.lit(period))
    latest = latest_per_key(export_scope(d), ["region", "country"], "ts_utc")
    cols = [c for c in LATEST_DQ_ITEM_COLS if c in latest.columns]
    return latest.select(*cols)


def dq_summary(dq: DataFrame, period: str, threshold: float = REPORT_COVERAGE_PCT) -> DataFrame:
    """One row over the latest DQ item per country: lowest coverage, countries
    below the fixed 98 % line, total issues, and the overall latest bucket."""
    items = dq_latest_items(dq, period)
    return items.agg(
        F.min("coverage_pct").alias("min_coverage_pct"),
        F.count_if(F.col("coverage_pct") < F.lit(threshold)).cast("long").alias("countries_below_98pct"),
        F.coalesce(F.sum("issue_count"), F.lit(0)).cast("long").alias("total_issue_count"),
        iso_z(F.max("ts_utc")).alias("ts_utc"),
        F.count(F.lit(1)).cast("long").alias("n_items"),
    )


def latest_snapshot(df: DataFrame, ts_col: str = "period_start_utc") -> DataFrame:
    """All rows at the overall latest timestamp: an equi-join with the
    one-row global maximum (exactly one row, so broadcasting it is safe); no
    window over the whole table. The maximum's side needs the key columns
    only, so its scan reads no values."""
    mx = df.agg(F.max(ts_col).alias("_latest_ts"))
    return df.join(F.broadcast(mx), F.col(ts_col) == F.col("_latest_ts"), "inner").drop("_latest_ts")


def regional_comparison(kpi: DataFrame,
                        metrics: Sequence[str] = ("avg_price", "renewable_share_pct", "price_volatility")
                        ) -> DataFrame:
    """Mean of each metric per region and bucket."""
    return (kpi.groupBy("region", "period_start_utc")
               .agg(*[F.avg(m).alias(f"mean_{m}") for m in metrics]))


def region_country(kpi: DataFrame) -> DataFrame:
    return kpi.select("region", "country").distinct()


def variation_guard(kpi: DataFrame, keys: Sequence[str] = ("region", "country"),
                    time_col: str = "period_start_utc",
                    value_cols: Sequence[str] = ("renewable_share_pct", "fossil_share_pct",
                                                 "nuclear_share_pct"),
                    min_points: int = 2) -> DataFrame:
    """Per key: True when there are at least ``min_points`` distinct times and
    some value column has ``min_points`` non-NULL values that are not all equal."""
    varies = F.lit(False)
    for c in value_cols:
        varies = varies | F.coalesce((F.count(c) >= min_points) & (F.min(c) != F.max(c)), F.lit(False))
    return (kpi.groupBy(*keys)
               .agg(((F.count_distinct(time_col) >= min_points) & varies).alias("has_variation")))


def energy_mix_series(kpi: DataFrame, region: str = "EU") -> DataFrame:
    """Share series per country (chart data), ordered at the sink."""
    return (kpi.where(F.col("region") == region)
               .select("region", "country", "period_start_utc", "renewable_share_pct",
                       "fossil_share_pct", "nuclear_share_pct"))


def price_vs_mix(kpi: DataFrame, region: str = "EU") -> DataFrame:
    return (kpi.where(F.col("region") == region)
               .select("region", "country", "period_start_utc", "renewable_share_pct", "avg_price"))


def head_rows(df: DataFrame, order_cols: Sequence[str], n: int = 10) -> DataFrame:
    """First ``n`` rows in an explicit order (a top-k, never "whatever comes first")."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order_cols]).limit(n)


def history_tail(kpi: DataFrame, n: int = 50) -> DataFrame:
    """Last ``n`` rows of the history in file order (region, country, time)."""
    return kpi.orderBy(F.col("region").desc(), F.col("country").desc(),
                       F.col("period_start_utc").desc()).limit(n)


def price_summary(kpi: DataFrame, warn_missing_rate: float = 0.02) -> DataFrame:
    """Per report date over all countries: price level and spread, a
    volatility index (std / mean), the missing rate (1 - mean coverage, floored
    at 0) and an OK/WARN status."""
    cov = F.least(F.avg("dq_coverage_pct"), F.lit(100.0))
    out = (kpi.groupBy(F.to_date("period_start_utc").alias("report_date"))
              .agg(F.avg("avg_price").alias("avg_price"),
                   F.max("avg_price").alias("max_price"),
                   F.min("avg_price").alias("min_price"),
                   (F.stddev_samp("avg_price") / F.nullif(F.avg("avg_price"), F.lit(0.0))).alias("volatility_index"),
                   (F.lit(1.0) - cov / F.lit(100.0)).alias("missing_rate")))
    return out.withColumn("status", F.when(F.col("missing_rate") <= warn_missing_rate, F.lit("OK"))
                                     .otherwise(F.lit("WARN")))


def _smallest(columns: list[str], size: int):
    def smallest(batches):
        """The ``size`` smallest distinct values of each column that the task has seen."""
        import pyarrow as pa
        import pyarrow.compute as pc

        held = {}
        for batch in batches:
            for c, values in zip(columns, batch.columns):
                some = pc.unique(pa.chunked_array([held[c], values.drop_null()]) if c in held else values.drop_null())
                held[c] = some.take(pc.sort_indices(some))[:size] if len(some) > size else some
        for c, values in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([c] * len(values), pa.string()), values.cast(pa.string())], names=["column_name", "value"])
    return smallest


#: Of the sketch of distinct values: log2 of its buckets (a few kB; one standard error is 1.04 / sqrt(2 ** SKETCH) = 0.8 %).
SKETCH = 14


def table_profile_sketched(df: DataFrame, columns: Sequence[str] | None = None, sample_size: int = 50) -> DataFrame:
    """``table_profile`` for tables of any cardinality: distinct counts are those of
    mergeable sketches (a relative error of 0.8 % at one standard error; exact
    for small counts), and of the values only each task's ``sample_size``
    smallest ones are moved. Two scans of the profiled columns; from each task
    comes one row of sketches, and at most ``sample_size`` values of a column."""
    cols = [c for c in (list(columns) if columns else [c for c, t in df.dtypes if t == "string"]) if c in df.columns]
    text = {c: F.col(f"`{c}`").cast("string") for c in cols}
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.hll_sketch_agg(text[c], F.lit(SKETCH)).alias(f"s{i}") for i, c in enumerate(cols)])
    stats = one.select("n", F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"s{i}").alias("s")) for i, c in enumerate(cols)])).alias("x"))
    stats = stats.select(F.col("x.c").alias("column_name"), F.col("n").cast("long").alias("n_rows"),
                         F.coalesce(F.hll_sketch_estimate("x.s"), F.lit(0)).cast("long").alias("distinct_count"))
    parts = df.select(*text.values()).mapInArrow(_smallest(cols, sample_size), "column_name string, value string")
    w = Window.partitionBy("column_name").orderBy("value")
    sample = (parts.distinct().withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= sample_size)
              .groupBy("column_name").agg(F.array_join(F.array_sort(F.collect_list("value")), "|").alias("sample_values")))
    return stats.join(sample, "column_name", "left")


def table_profile(df: DataFrame, columns: Sequence[str] | None = None, sample_size: int = 50, sketched: bool = False) -> DataFrame:
    """Row count, distinct count and the ``sample_size`` smallest distinct
    values of each text column, from one scan; ``sketched`` as in ``table_profile_sketched``.

    One ``(column_name, value)`` count, aggregated map-side, gives all three:
    its sum, its number of non-NULL rows, and its first values (a
    ``row_number`` limit that Spark applies per partition before the shuffle).
    """
    if sketched:
        return table_profile_sketched(df, columns, sample_size)
    cols = list(columns) if columns else [c for c, t in df.dtypes if t == "string"]
    cols = [c for c in cols if c in df.columns]
    kv = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols
    ])).alias("kv")).select("kv.*")
    counts = kv.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    stats = counts.groupBy("column_name").agg(F.sum("n").cast("long").alias("n_rows"),
                                              F.count("value").cast("long").alias("distinct_count"))
    w = Window.partitionBy("column_name").orderBy("value")
    # the test on n keeps the two branches' aggregate the same, so its exchange is reused
    sample = (counts.where(F.col("value").isNotNull() & (F.col("n") > 0))
                    .withColumn("_rn", F.row_number().over(w))
                    .where(F.col("_rn") <= sample_size)
                    .groupBy("column_name")
                    .agg(F.array_join(F.array_sort(F.collect_list("value")), "|").alias("sample_values")))
    # one row for each profiled column on both sides; its values may be long texts, so Spark sizes the join
    return stats.join(sample, "column_name", "left")


# ---- year-comparison dashboard data -------------------------------------

def delta_bounds(cmp: DataFrame) -> DataFrame:
    """Slider defaults: min/max of the non-NULL deltas, else +-100 / +-500."""
    r = DELTA_DEFAULT_BOUNDS["renewable_share_pct_delta"]
    p = DELTA_DEFAULT_BOUNDS["avg_price_delta"]
    return cmp.agg(
        F.coalesce(F.min("renewable_share_pct_delta"), F.lit(-r)).alias("renewable_delta_min"),
        F.coalesce(F.max("renewable_share_pct_delta"), F.lit(r)).alias("renewable_delta_max"),
        F.coalesce(F.min("avg_price_delta"), F.lit(-p)).alias("price_delta_min"),
        F.coalesce(F.max("avg_price_delta"), F.lit(p)).alias("price_delta_max"),
    )


def delta_range_filter(cmp: DataFrame, renewable_range: tuple[float, float],
                       price_range: tuple[float, float], only_price: bool = True) -> DataFrame:
    """Inclusive slider filter; NULL deltas count as 0."""
    out = cmp.where(F.col("avg_price_delta").isNotNull()) if only_price else cmp
    ren = F.coalesce(F.col("renewable_share_pct_delta"), F.lit(0.0))
    pr = F.coalesce(F.col("avg_price_delta"), F.lit(0.0))
    return out.where(ren.between(*renewable_range) & pr.between(*price_range))


def delta_headline(filtered: DataFrame) -> DataFrame:
    return filtered.agg(
        F.count(F.lit(1)).cast("long").alias("countries"),
        F.max("renewable_share_pct_delta").alias("max_renewable_delta"),
        F.max("avg_price_delta").alias("max_price_delta"),
        F.min("avg_price_delta").alias("min_price_delta"),
    )


def transition_scatter(cmp: DataFrame, size_year: int) -> DataFrame:
    """Plot-ready rows (both deltas and the later year's generation present)
    with bubble size sqrt(x) scaled so the largest is 2500."""
    tot = f"total_generation_mwh_{size_year}"
    rows = cmp.where(F.col("renewable_share_pct_delta").isNotNull() & F.col("avg_price_delta").isNotNull()
                     & F.col(tot).isNotNull())
    mx = rows.select(F.max(F.sqrt(tot))).scalar()
    return rows.select("country", "renewable_share_pct_delta", "avg_price_delta", tot,
                       ((F.sqrt(tot) / mx) * F.lit(BUBBLE_MAX)).alias("bubble_size"))


def _filled_columns(df: DataFrame) -> list[str]:
    """Columns with a value, by one counting pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return [c for i, c in enumerate(df.columns) if counts[f"c{i}"] > 0]


def _filled_by_footers(df: DataFrame, paths: Sequence[str]) -> list[str] | None:
    """Columns with a value by the NULL counts in the footers of Parquet files: the
    same count, pushed into the reader, which then opens no column. None where
    the reader cannot take it, as without statistics."""
    own = df.sparkSession.newSession()  # settings of its own, the same tables
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    try:
        table = own.read.parquet(*paths).select(*[F.col(f"`{c}`") for c in df.columns])
        counts = table.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
        if "PushedAggregation: [COUNT" not in counts._jdf.queryExecution().toString():
            return None
        row = counts.first()
    except Exception:  # noqa: BLE001 - files without NULL counts; any other fault shows again in the counting pass
        return None
    return [c for i, c in enumerate(df.columns) if row[f"c{i}"] > 0]


def drop_empty(df: DataFrame, parquet: Sequence[str] | None = None) -> DataFrame:
    """Drop columns that are entirely NULL, then rows that are entirely NULL.

    Which columns are empty has to be known when the query is built: by one
    counting pass, or where ``df`` is the plain scan of the Parquet paths
    ``parquet``, by their footers alone."""
    keep = (_filled_by_footers(df, parquet) if parquet else None)
    keep = _filled_columns(df) if keep is None else keep
    out = df.select(*[F.col(f"`{c}`") for c in keep])
    return out.dropna(how="all") if keep else out
