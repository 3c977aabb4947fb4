"""Calendar grids and constant-profile baseline sources.

A grid is generated from a small *bounds* frame (keys, start, end): each
bounds row is cut into chunks of at most ``chunk_steps`` steps, the chunk
rows are hash-spread over the cluster (explicit partition count, so AQE does
not fold them back into one task), and every task expands only its own
chunks. The profile rows are attached with an inline generator, not a join.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import check_level
from ..functions.time import chunked_range, nth_step, steps_between
from ..session import default_parallelism
from ..schema import CN_MONTHLY_PROFILE, EU_HOURLY_PROFILE, READING_COLS, US_DAILY_PROFILE


def _grid_first_and_count(start: Column, end: Column, level: str):
    """First grid point and number of points in ``[start, end)``.

    Fixed-length steps start at ``start``; month steps start at the first
    month start on or after ``start``."""
    if level == "month":
        m0 = F.date_trunc("month", start)
        first = F.when(m0 == start, m0).otherwise(F.add_months(F.to_date(m0), 1).cast("timestamp"))
        return first, steps_between(first, end, level)
    return start, steps_between(start, end, level)


def calendar_grid(bounds: DataFrame, level: str, start_col: str = "start", end_col: str = "end",
                  cap: int | None = None, chunk_steps: int = 4096,
                  partitions: int | None = None) -> DataFrame:
    """Expand each ``bounds`` row into one row per step in ``[start, end)``
    (``ts_utc``); ``cap`` keeps only the first N steps of each row."""
    lv = check_level(level)
    keys = [c for c in bounds.columns if c not in (start_col, end_col)]
    first, n = _grid_first_and_count(F.col(start_col).cast("timestamp"),
                                     F.col(end_col).cast("timestamp"), lv)
    if cap is not None:
        n = F.least(n, F.lit(int(cap)).cast("long"))
    b = bounds.select(*keys, first.alias("_first"), n.alias("_n"))
    ids, lo, hi = chunked_range(F.col("_n"), chunk_steps)
    chunks = b.select(*keys, "_first", "_n", F.explode(ids).alias("_chunk"))
    parts = partitions or default_parallelism(bounds.sparkSession)
    chunks = chunks.repartition(int(parts), *keys, "_chunk")
    idx = chunks.select(*keys, "_first", F.explode(F.sequence(lo(F.col("_chunk")), hi(F.col("_chunk")))).alias("_i"))
    return idx.select(*keys, nth_step(F.col("_first"), F.col("_i"), lv).alias("ts_utc"))


def profile_rows(grid: DataFrame, profile: Sequence[tuple], *, period: str, region: Column | str,
                 country: Column | str, source_system: str) -> DataFrame:
    """Attach constant profile rows to every grid point (canonical readings)."""
    prof = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(s).alias("energy_source"),
                              F.lit(float(v)).alias("value"), F.lit(u).alias("unit"),
                              F.lit(q).alias("quality_flag")) for m, s, v, u, q in profile])
    region = F.lit(region) if isinstance(region, str) else region
    country = F.lit(country) if isinstance(country, str) else country
    g = grid.select("*", region.alias("_region"), country.alias("_country"),
                    F.explode(prof).alias("_p"))
    return g.select(
        F.col("ts_utc"), F.lit(period).alias("period"), F.col("_region").alias("region"),
        F.col("_country").alias("country"), F.col("_p.metric").alias("metric"),
        F.col("_p.energy_source").alias("energy_source"), F.col("_p.value").alias("value"),
        F.col("_p.unit").alias("unit"), F.col("_p.quality_flag").alias("quality_flag"),
        F.lit(source_system).alias("source_system")).select(*READING_COLS)


def bounds_frame(spark: SparkSession, countries: Iterable[str], start: str, end: str) -> DataFrame:
    """Bounds for an explicit country list (the list is an argument, small)."""
    rows = [(c, start, end) for c in countries]
    return (spark.createDataFrame(rows, "country string, start string, end string")
                 .select("country", F.to_timestamp("start").alias("start"), F.to_timestamp("end").alias("end")))


def baseline_hourly(bounds: DataFrame, cap: int | None = None, region: str = "EU") -> DataFrame:
    """Hourly EU profile per (country, start, end) row; ``cap`` keeps the first
    steps only (the older variant's ``cap=48``)."""
    grid = calendar_grid(bounds.select("country", "start", "end"), "hour", cap=cap)
    return profile_rows(grid, EU_HOURLY_PROFILE, period="hour", region=region,
                        country=F.col("country"), source_system="entsoe")


def baseline_daily(bounds: DataFrame, cap: int | None = None) -> DataFrame:
    """Daily US profile over each ``[start, end)`` row (at most ``cap`` days if given)."""
    grid = calendar_grid(bounds.select("start", "end"), "day", cap=cap)
    return profile_rows(grid, US_DAILY_PROFILE, period="day", region="US", country="US",
                        source_system="eia")


def baseline_monthly(bounds: DataFrame, cap: int | None = None) -> DataFrame:
    """Monthly CN profile: month starts on/after start, before end (at most
    ``cap`` of them if given)."""
    grid = calendar_grid(bounds.select("start", "end"), "month", cap=cap)
    return profile_rows(grid, CN_MONTHLY_PROFILE, period="month", region="CN", country="CN",
                        source_system="nbs_cn")


def data_range(df: DataFrame, ts_col: str = "ts_utc", level: str = "day") -> DataFrame:
    """One-row bounds ``[trunc(min), trunc(max) + 1 step)`` of a table's time column."""
    lv = check_level(level)
    step = {"hour": "INTERVAL 1 HOUR", "day": "INTERVAL 1 DAY",
            "week": "INTERVAL 7 DAYS", "month": "INTERVAL 1 MONTH"}[lv]
    t = F.col(ts_col).cast("timestamp")
    return df.agg(F.date_trunc(lv, F.min(t)).alias("start"),
                  (F.date_trunc(lv, F.max(t)) + F.expr(step)).alias("end"))


def country_bounds(df: DataFrame, ts_col: str = "ts_utc", country_col: str = "country") -> DataFrame:
    """Bounds for every country of ``df``: the day range of the whole table, in
    one pass (a grouped min/max, then their overall min/max over the few
    country rows)."""
    t = F.col(ts_col).cast("timestamp")
    per = df.groupBy(F.col(country_col).alias("country")).agg(F.min(t).alias("lo"), F.max(t).alias("hi"))
    whole = Window.partitionBy(F.lit(0))
    return per.select("country", F.date_trunc("day", F.min("lo").over(whole)).alias("start"),
                      (F.date_trunc("day", F.max("hi").over(whole)) + F.expr("INTERVAL 1 DAY")).alias("end"))


def multi_region_union(eu: DataFrame, us: DataFrame, cn: DataFrame) -> DataFrame:
    """EU hourly + US daily + CN monthly canonical readings in one table."""
    return eu.select(*READING_COLS).unionByName(us.select(*READING_COLS)).unionByName(cn.select(*READING_COLS))
