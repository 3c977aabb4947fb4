"""Yearly roll-ups and year-against-year comparison.

Yearly rows are few per country (one per year), so windows partitioned by
country stay small; the wide comparison is one conditional aggregate per
country (no pivot() discovery pass, no join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import round_half_even, safe_div, ts_of
from ..schema import PLACEHOLDER_PRICE_SHARE, PLACEHOLDER_TOTAL_MWH, require_columns

COMPARE_METRICS = {
    "avg_price": "mean",
    "renewable_share_pct": "mean",
    "price_volatility": "mean",
    "total_generation_mwh": "sum",
}


def yearly_kpis(daily: DataFrame, country_col: str = "country_iso2", date_col: str = "date",
                value_col: str = "avg_price", years: Sequence[int] | None = None) -> DataFrame:
    """Mean and sample std of daily prices per country and calendar year,
    rounded half-even to 2 decimals. ``years`` restricts the input to these
    calendar years by range predicates on the date column, which reach the
    scan (a test on ``year(date)`` would not)."""
    require_columns(daily, {country_col, date_col, value_col}, "daily df")
    if years is not None:
        daily = daily.where(in_years(date_col, years))
    d = daily.select(F.col(country_col).alias("country_iso2"),
                     ts_of(daily, date_col).alias("_d"), F.col(value_col).alias("_v"))
    d = d.where(F.col("_d").isNotNull() & F.col("country_iso2").isNotNull())
    return (d.groupBy("country_iso2", F.year("_d").cast("long").alias("year"))
             .agg(round_half_even(F.avg("_v"), 2).alias("avg_price"),
                  round_half_even(F.stddev_samp("_v"), 2).alias("price_volatility")))


def in_years(col: str, years: Sequence[int]) -> Column:
    """Half-open date ranges of calendar years, as plain predicates on ``col``."""
    cond = F.lit(False)
    for y in years:
        cond = cond | ((F.col(col) >= F.lit(f"{y:04d}-01-01").cast("timestamp"))
                       & (F.col(col) < F.lit(f"{y + 1:04d}-01-01").cast("timestamp")))
    return cond


def year_compare(yearly: DataFrame, metric: str, year_a: int, year_b: int,
                 key: str = "country_iso2") -> DataFrame:
    """Year A beside year B per key (NULL keys belong together), for the keys
    that have both; absolute and percent delta, percent NULL on a NULL or zero
    base. ``yearly`` has one row per key and year, so one conditional aggregate
    over one scan does what a self-join would."""
    require_columns(yearly, {key, "year", metric}, "yearly df")
    in_a, in_b = F.col("year") == year_a, F.col("year") == year_b
    both = (yearly.where(in_a | in_b).groupBy(key)
            .agg(F.max(F.when(in_a, F.col(metric))).alias("value_a"), F.max(F.when(in_b, F.col(metric))).alias("value_b"),
                 F.count_if(in_a).alias("_a"), F.count_if(in_b).alias("_b"))
            .where("_a > 0 AND _b > 0"))
    delta = F.col("value_b") - F.col("value_a")
    base = F.nullif(F.col("value_a").cast("double"), F.lit(0.0))
    return both.select(key, F.lit(year_a).cast("long").alias("year_a"), F.lit(year_b).cast("long").alias("year_b"),
                       "value_a", "value_b", delta.alias("delta_abs"), (delta / base * F.lit(100.0)).alias("delta_pct"))


def placeholder_mask(df: DataFrame) -> Column:
    """True for rows that look like baseline placeholders (NULL-safe)."""
    price, share = PLACEHOLDER_PRICE_SHARE
    cond = F.lit(False)
    cols = set(df.columns)
    if {"avg_price", "renewable_share_pct"} <= cols:
        cond = cond | F.coalesce((F.col("avg_price") == price) & (F.col("renewable_share_pct") == share),
                                 F.lit(False))
    if "total_generation_mwh" in cols:
        cond = cond | F.coalesce(F.col("total_generation_mwh") == PLACEHOLDER_TOTAL_MWH, F.lit(False))
    return cond


def drop_placeholder_rows(df: DataFrame) -> DataFrame:
    return df.where(~placeholder_mask(df))


def year_window_filter(df: DataFrame, years: Sequence[int], window_days: int | None = None,
                       ts_col: str = "period_start_utc") -> DataFrame:
    """Rows of each calendar year, or with ``window_days`` of its first days
    only, as plain range predicates so they reach the scan."""
    cond = F.lit(False)
    for y in years:
        lo = F.to_timestamp(F.lit(f"{y:04d}-01-01"))
        hi = (lo + F.expr(f"INTERVAL {int(window_days)} DAYS")) if window_days else \
            F.to_timestamp(F.lit(f"{y + 1:04d}-01-01"))
        cond = cond | ((F.col(ts_col) >= lo) & (F.col(ts_col) < hi))
    return df.where(cond)


def year_comparison(kpi: DataFrame, years: Sequence[int] = (2015, 2024), window_days: int | None = None,
                    region: str = "EU", metrics: dict | None = None,
                    ts_col: str = "period_start_utc") -> DataFrame:
    """Per country: each metric for each year (mean, or sum for energy), then
    ``{metric}_delta`` = last year minus first year."""
    metrics = metrics or COMPARE_METRICS
    years = list(years)
    df = year_window_filter(kpi.where(F.col("region") == region), years, window_days, ts_col)
    df = drop_placeholder_rows(df).where(F.col("country").isNotNull())
    df = df.withColumn("_year", F.year(ts_col))
    aggs = []
    for m, how in metrics.items():
        for y in years:
            in_year = F.col("_year") == y
            if how == "sum":
                e = F.when(F.count_if(in_year) > 0,
                           F.coalesce(F.sum(F.when(in_year, F.col(m))), F.lit(0.0)))
            else:
                e = F.avg(F.when(in_year, F.col(m)))
            aggs.append(e.alias(f"{m}_{y}"))
    out = df.groupBy("country").agg(*aggs)
    a, b = years[0], years[-1]
    for m in metrics:
        out = out.withColumn(f"{m}_delta", F.col(f"{m}_{b}") - F.col(f"{m}_{a}"))
    return out


def order_by_delta(cmp: DataFrame, metric: str = "renewable_share_pct") -> DataFrame:
    """Sink-side ordering: largest delta first, NULL deltas last."""
    return cmp.orderBy(F.col(f"{metric}_delta").desc_nulls_last(), F.col("country").asc())


def ranked_by_delta(cmp: DataFrame, metric: str = "renewable_share_pct") -> DataFrame:
    """The sink order as a column: 1 for the largest delta, NULL deltas last.
    The comparison has one row per country, so one window may hold it."""
    w = Window.orderBy(F.col(f"{metric}_delta").desc_nulls_last(), F.col("country").asc())
    return cmp.withColumn("delta_rank", F.row_number().over(w).cast("long"))


def top_movers(cmp: DataFrame, metric: str, years: Sequence[int], k: int = 10) -> DataFrame:
    """The k largest ``{metric}_delta`` rows (a top-k: TakeOrderedAndProject)."""
    a, b = years[0], years[-1]
    return (cmp.orderBy(F.col(f"{metric}_delta").desc_nulls_last(), F.col("country").asc())
               .limit(k)
               .select("country", f"{metric}_{a}", f"{metric}_{b}", f"{metric}_delta"))


def yoy_change(yearly: DataFrame, value_col: str = "avg_price", key: str = "country_iso2") -> DataFrame:
    """Current vs previous year per country and the change in percent."""
    w = Window.partitionBy(key).orderBy("year")
    prev = F.lag(value_col).over(w)
    out = yearly.select(key, "year", F.col(value_col).alias("current_avg_price"),
                        prev.alias("previous_avg_price"))
    pct = safe_div(F.col("current_avg_price") - F.col("previous_avg_price"),
                   F.col("previous_avg_price")) * F.lit(100.0)
    return out.withColumn("change_pct", round_half_even(pct, 2))
