"""

Every query reads the driver's parquet tables through the adapters in
``gridmetrics.plans.adapters`` (whole tables, no row subsets) and runs the
package's operators. ``oracle_sql`` holds an independently written DuckDB
twin of each one. Output normalisation (both sides): timestamps are
zone-less UTC, integers are 64-bit, doubles are rounded to 10 significant
digits (tie-proof, see ``sig_round``).
"""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import entry_oracles as O  # noqa: E402
from gridmetrics import operators as ops  # noqa: E402
from gridmetrics import sources as src  # noqa: E402
from gridmetrics.plans import adapters as ad  # noqa: E402
from gridmetrics.functions.canonical import json_key_column  # noqa: E402
from gridmetrics.plans.pipeline import eu_pipeline, global_pipeline, run_eu, run_global  # noqa: E402
from gridmetrics.schema import (CN_MONTHLY_PROFILE, EU27, EU_HOURLY_PROFILE, KPI, KPI_COLS,  # noqa: E402
                                METRIC_RULES, SOURCE_RULES, US_DAILY_PROFILE)
from gridmetrics.session import ensure_utc, scratch_path  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
SIG_DIGITS = 10
# Check normalisation of doubles: 10 significant digits (a fixed number of
# decimals is too fine for sums near 1e9, whose summation-order noise reaches
# the 7th decimal). Means of 2-decimal inputs can sit exactly on a decimal
# rounding tie, so every value is first scaled by (1 + SIG_SHIFT), far below
# the kept precision, which moves such ties off the boundary. Both sides use
# the same IEEE steps: exact powers of ten, one multiply or divide, one
# round-to-integer.
SIG_SHIFT = 1e-11 * (2 ** 0.5 - 1)


def sig_round_expr(col: str) -> str:
    """Spark SQL text of the normalisation of column ``col`` (built as text so a
    whole row of columns costs one ``selectExpr`` call, not hundreds of py4j
    round trips)."""
    v = f"(CAST(`{col}` AS DOUBLE) * {1.0 + SIG_SHIFT!r}D)"
    s = f"({SIG_DIGITS - 1} - CAST(floor(log10(abs({v}))) AS INT))"
    return (f"CASE WHEN {v} IS NULL THEN NULL WHEN {v} = 0 THEN 0.0D "
            f"WHEN isnan({v}) OR abs({v}) = double('inf') THEN {v} "
            f"WHEN {s} > 290 THEN {v} "
            f"WHEN {s} >= 0 THEN round({v} * pow(10.0D, {s}), 0) / pow(10.0D, {s}) "
            f"ELSE round({v} / pow(10.0D, -{s}), 0) * pow(10.0D, -{s}) END")


def sig_round(c):
    """Column form of the normalisation (used by tests on single columns)."""
    v = c * F.lit(1.0 + SIG_SHIFT)
    s = F.lit(SIG_DIGITS - 1) - F.floor(F.log10(F.abs(v))).cast("int")
    up = F.round(v * F.pow(F.lit(10.0), s), 0) / F.pow(F.lit(10.0), s)
    down = F.round(v / F.pow(F.lit(10.0), -s), 0) * F.pow(F.lit(10.0), -s)
    special = F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    return (F.when(v == 0, F.lit(0.0)).when(special, v).when(s > 290, v)
             .when(s >= 0, up).otherwise(down))


def sig_round_sql(col: str) -> str:
    v = f'(CAST("{col}" AS DOUBLE) * CAST({1.0 + SIG_SHIFT!r} AS DOUBLE))'
    s = f"({SIG_DIGITS - 1} - CAST(floor(log10(abs({v}))) AS INTEGER))"
    return (f"CASE WHEN {v} IS NULL THEN NULL WHEN {v} = 0 THEN 0.0 WHEN isnan({v}) OR isinf({v}) THEN {v} "
            f"WHEN {s} > 290 THEN {v} "
            f"WHEN {s} >= 0 THEN round({v} * pow(10.0, {s})) / pow(10.0, {s}) "
            f"ELSE round({v} / pow(10.0, -{s})) * pow(10.0, -{s}) END")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}
#: The operators' own frames, without the check's rounding (what ``bench.py`` times).
_FRAMES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def finalize(df: DataFrame) -> DataFrame:
    """Comparable output: UTC timestamps as zone-less, ints as long, doubles
    normalised; one ``selectExpr`` for the whole row."""
    exprs = []
    for f in df.schema.fields:
        q = f"`{f.name}`"
        if isinstance(f.dataType, T.TimestampType):
            e = f"CAST({q} AS TIMESTAMP_NTZ)"
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            e = f"CAST({q} AS BIGINT)"
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            e = sig_round_expr(f.name)
        else:
            e = q
        exprs.append(f"{e} AS {q}")
    return df.selectExpr(*exprs)


def oracle_round(sql: str, doubles: list[str]) -> str:
    if not doubles:
        return sql
    rep = ", ".join(f'{sig_round_sql(c)} AS "{c}"' for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) q"


def register(name: str, sql: str | None = None, doubles: list[str] | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return finalize(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        _FRAMES[name] = fn
        if sql is not None:
            _ORACLES[name] = oracle_round(sql, doubles or [])
        return fn
    return deco


def A(spark, sf, name):  # adapter shorthand
    return ad.adapter(spark, sf, name)


KPI_DOUBLES = ["fossil_mwh", "renewable_mwh", "nuclear_mwh", "total_generation_mwh",
               "renewable_share_pct", "fossil_share_pct", "nuclear_share_pct", "avg_price",
               "price_volatility", "net_import_mwh", "dq_coverage_pct"]
KPI_SELECT = ", ".join(KPI_COLS)

# ---------------------------------------------------------------------------
# A1-A4, P5: buckets, gap fill, coverage, data quality
# ---------------------------------------------------------------------------


def _cov(spark, sf, level, thr=98.0, adapter="readings"):
    return ops.bucket_coverage(A(spark, sf, adapter), level, thr)


def _bucket_oracle(level, adapter="readings", thr=98.0):
    ctes = duck_scope(adapter) + O.bucket_ctes("scoped", level, thr)
    return O.with_(ctes, O.bucketed_select("cov"))


def duck_scope(adapter):
    return ad.duck_ctes(adapter) + [O.scope_cte("scoped", adapter)]


for _lv, _adp in (("hour", "readings"), ("day", "readings"), ("week", "readings"),
                  ("month", "readings_years")):
    def _mk(lv=_lv, adp=_adp):
        @register(f"bucket_{lv}", _bucket_oracle(lv, adp), ["value"])
        def q(spark, sf):
            """A1: resample canonical readings to the bucket level (EU scope, gaps filled)."""
            return ops.bucketed_view(_cov(spark, sf, lv, adapter=adp))

        @register(f"dq_{lv}", O.with_(duck_scope(adp) + O.bucket_ctes("scoped", lv) + [O.dq_cte("cov")],
                                      "SELECT * FROM dq"), ["coverage_pct"])
        def d(spark, sf):
            """A4: min coverage and flagged-series count per bucket and country."""
            return ops.dq_rollup(_cov(spark, sf, lv, adapter=adp))
    _mk()


@register("gap_fill_day",
          O.with_(duck_scope("readings") + O.bucket_ctes("scoped", "day"),
                  f"SELECT {O.SERIES}, ts_utc, value, actual_points FROM filled"),
          ["value"])
def q_gap_fill_day(spark, sf):
    """A2: interior gap fill (lead + sequence) vs per-series generate_series twin."""
    df = ops.normalize_ts(A(spark, sf, "readings"))
    b = ops.bucket_values(ops.eu_scope(df), "day")
    return ops.fill_interior_gaps(b, "day")


for _lv, _adp in (("day", "readings"), ("month", "readings_years")):
    def _mk2(lv=_lv, adp=_adp):
        @register(f"coverage_{lv}",
                  O.with_(duck_scope(adp) + O.bucket_ctes("scoped", lv),
                          f"SELECT {O.SERIES}, ts_utc, actual_points, expected_points, coverage_pct, "
                          f"quality_flag, period FROM cov"),
                  ["coverage_pct"])
        def q(spark, sf):
            """A3: expected points per bucket and coverage percent."""
            return _cov(spark, sf, lv, adapter=adp).select(
                *ops.bucket.SERIES_COLS, "ts_utc", "actual_points", "expected_points",
                "coverage_pct", "quality_flag", "period")
    _mk2()


@register("quality_flags",
          O.with_(duck_scope("readings") + O.bucket_ctes("scoped", "day", 5.0),
                  f"SELECT {O.SERIES}, ts_utc, coverage_pct, quality_flag FROM cov"),
          ["coverage_pct"])
def q_quality_flags(spark, sf):
    """P5: missing_interval below a 5 % coverage threshold, else ok."""
    return _cov(spark, sf, "day", 5.0).select(*ops.bucket.SERIES_COLS, "ts_utc", "coverage_pct",
                                              "quality_flag")


# ---------------------------------------------------------------------------
# Normalisation and scope
# ---------------------------------------------------------------------------

@register("eu_scope", O.with_(duck_scope("readings"), "SELECT * FROM scoped"), ["value"])
def q_eu_scope(spark, sf):
    """EU27 by ISO2 or (padded) display name, codes renamed, region EU."""
    return ops.eu_scope(ops.normalize_ts(A(spark, sf, "readings")))


# ---------------------------------------------------------------------------
# KPI
# ---------------------------------------------------------------------------

def _bucketed_day(spark, sf):
    return ops.bucketed_view(_cov(spark, sf, "day"))


@register("kpi_compute",
          O.with_(O.eu_chain("readings", "day", with_dq=False),
                  "SELECT " + ", ".join(KPI_COLS[:-2]) + " FROM kpi"),
          KPI_DOUBLES[:-1])
def q_kpi_compute(spark, sf):
    """KPI per bucket/country as one conditional aggregate (oracle: 3 aggregates + joins)."""
    return ops.kpi_core(_bucketed_day(spark, sf), "day")


@register("kpi_with_dq", O.with_(O.eu_chain("readings", "day"), f"SELECT {KPI_SELECT} FROM kpi"),
          KPI_DOUBLES)
def q_kpi_with_dq(spark, sf):
    """KPI left-joined with the DQ roll-up of the same period. Both sides
    come from one lazy coverage frame; Spark reuses its exchanges."""
    cov = _cov(spark, sf, "day")
    return ops.compute_kpis(ops.bucketed_view(cov), "day", dq=ops.dq_rollup(cov))


@register("eu_pipeline", O.with_(O.eu_chain("readings", "day"), f"SELECT {KPI_SELECT} FROM kpi"),
          KPI_DOUBLES)
def q_eu_pipeline(spark, sf):
    """Readings -> scope -> day buckets + coverage -> KPI with DQ in one aggregate."""
    return eu_pipeline(A(spark, sf, "readings"), "day").kpi

# ---------------------------------------------------------------------------
# A5-A8 parts, W1/W2, A14-A20, W4, P21, T4: reports over the day KPI
# ---------------------------------------------------------------------------

def _kpi_day(spark, sf):
    return eu_pipeline(A(spark, sf, "readings"), "day").kpi


def _chain_day():
    return O.eu_chain("readings", "day")


@register("energy_mix",
          O.with_(_chain_day(), """SELECT ts_utc AS period_start_utc, region, country, renewable_mwh, fossil_mwh,
  nuclear_mwh, renewable_mwh + fossil_mwh + nuclear_mwh AS total_generation_mwh,
  renewable_mwh / nullif(renewable_mwh + fossil_mwh + nuclear_mwh, 0.0) * 100.0 AS renewable_share_pct,
  fossil_mwh / nullif(renewable_mwh + fossil_mwh + nuclear_mwh, 0.0) * 100.0 AS fossil_share_pct,
  nuclear_mwh / nullif(renewable_mwh + fossil_mwh + nuclear_mwh, 0.0) * 100.0 AS nuclear_share_pct
  FROM kpi_gen"""),
          ["renewable_mwh", "fossil_mwh", "nuclear_mwh", "total_generation_mwh", "renewable_share_pct",
           "fossil_share_pct", "nuclear_share_pct"])
def q_energy_mix(spark, sf):
    """Generation per source pivoted to fixed columns, total and shares."""
    return ops.energy_mix(_bucketed_day(spark, sf))


@register("price_stats",
          O.with_(_chain_day(), "SELECT ts_utc AS period_start_utc, region, country, avg_price, "
                                "price_volatility, price_unit FROM kpi_pr"),
          ["avg_price", "price_volatility"])
def q_price_stats(spark, sf):
    """Mean, sample std and first unit of bucketed prices."""
    return ops.price_stats(_bucketed_day(spark, sf))


@register("net_import",
          O.with_(_chain_day(), "SELECT ts_utc AS period_start_utc, region, country, net_import_mwh FROM kpi_ni"),
          ["net_import_mwh"])
def q_net_import(spark, sf):
    """Net import sum per bucket and country."""
    return ops.net_import(_bucketed_day(spark, sf))


_EU_NAMES = ", ".join(f"'{n}'" for _, n in EU27)


@register("kpi_latest",
          O.with_(_chain_day(), f"""SELECT region, country, strftime(period_start_utc, '%Y-%m-%dT%H:%M:%SZ') AS period_start_utc,
  total_generation_mwh, renewable_share_pct, fossil_share_pct, nuclear_share_pct, avg_price, price_unit,
  price_volatility, dq_coverage_pct, dq_issue_count
  FROM (SELECT *, row_number() OVER (PARTITION BY region, country ORDER BY period_start_utc DESC) AS rn
        FROM kpi WHERE country IN ({_EU_NAMES})) WHERE rn = 1"""),
          ["total_generation_mwh", "renewable_share_pct", "fossil_share_pct", "nuclear_share_pct",
           "avg_price", "price_volatility", "dq_coverage_pct"])
def q_kpi_latest(spark, sf):
    """Latest KPI row per (region, country) — the items of the latest-KPI document."""
    return ops.kpi_latest_items(_kpi_day(spark, sf))


_DQ_LATEST = f"""dql AS (SELECT region, country, ts_utc, coverage_pct, issue_count FROM (
  SELECT *, row_number() OVER (PARTITION BY region, country ORDER BY ts_utc DESC) AS rn
  FROM dq WHERE period = 'day' AND country IN ({_EU_NAMES})) WHERE rn = 1)"""


@register("dq_latest", O.with_(_chain_day() + [_DQ_LATEST], "SELECT * FROM dql"), ["coverage_pct"])
def q_dq_latest(spark, sf):
    """Latest DQ bucket per (region, country)."""
    cov = _cov(spark, sf, "day")
    return ops.dq_latest_items(ops.dq_rollup(cov), "day")


@register("dq_summary",
          O.with_(_chain_day() + [_DQ_LATEST], """SELECT min(coverage_pct) AS min_coverage_pct,
  CAST(count(*) FILTER (WHERE coverage_pct < 98.0) AS BIGINT) AS countries_below_98pct,
  CAST(coalesce(sum(issue_count), 0) AS BIGINT) AS total_issue_count,
  strftime(max(ts_utc), '%Y-%m-%dT%H:%M:%SZ') AS ts_utc, CAST(count(*) AS BIGINT) AS n_items FROM dql"""),
          ["min_coverage_pct"])
def q_dq_summary(spark, sf):
    """Summary over the latest DQ items (fixed 98 % line)."""
    cov = _cov(spark, sf, "day")
    return ops.dq_summary(ops.dq_rollup(cov), "day")


@register("latest_snapshot",
          O.with_(_chain_day(), f"SELECT {KPI_SELECT} FROM kpi WHERE period_start_utc = (SELECT max(period_start_utc) FROM kpi)"),
          KPI_DOUBLES)
def q_latest_snapshot(spark, sf):
    """Every KPI row at the overall latest bucket; one plan, nothing written."""
    return ops.latest_snapshot(_kpi_day(spark, sf))


@register("regional_comparison",
          O.with_(_chain_day(), """SELECT region, period_start_utc, avg(avg_price) AS mean_avg_price,
  avg(renewable_share_pct) AS mean_renewable_share_pct, avg(price_volatility) AS mean_price_volatility
  FROM kpi GROUP BY region, period_start_utc"""),
          ["mean_avg_price", "mean_renewable_share_pct", "mean_price_volatility"])
def q_regional_comparison(spark, sf):
    """Mean price, renewable share and volatility per region and bucket."""
    return ops.regional_comparison(_kpi_day(spark, sf))


@register("region_country", O.with_(_chain_day(), "SELECT DISTINCT region, country FROM kpi"))
def q_region_country(spark, sf):
    """Distinct (region, country) pairs."""
    return ops.region_country(_kpi_day(spark, sf))


@register("variation_guard",
          O.with_(_chain_day(), """SELECT region, country, (count(DISTINCT period_start_utc) >= 2 AND (
    coalesce(count(renewable_share_pct) >= 2 AND min(renewable_share_pct) <> max(renewable_share_pct), false)
 OR coalesce(count(fossil_share_pct) >= 2 AND min(fossil_share_pct) <> max(fossil_share_pct), false)
 OR coalesce(count(nuclear_share_pct) >= 2 AND min(nuclear_share_pct) <> max(nuclear_share_pct), false)))
 AS has_variation FROM kpi GROUP BY region, country"""))
def q_variation_guard(spark, sf):
    """Does each country's share series really vary over time?"""
    return ops.variation_guard(_kpi_day(spark, sf))


@register("energy_mix_series",
          O.with_(_chain_day(), "SELECT region, country, period_start_utc, renewable_share_pct, fossil_share_pct, "
                                "nuclear_share_pct FROM kpi WHERE region = 'EU'"),
          ["renewable_share_pct", "fossil_share_pct", "nuclear_share_pct"])
def q_energy_mix_series(spark, sf):
    """Share series per country (chart data)."""
    return ops.energy_mix_series(_kpi_day(spark, sf))


@register("price_vs_mix",
          O.with_(_chain_day(), "SELECT region, country, period_start_utc, renewable_share_pct, avg_price "
                                "FROM kpi WHERE region = 'EU'"),
          ["renewable_share_pct", "avg_price"])
def q_price_vs_mix(spark, sf):
    """Renewable share against average price per country (chart data)."""
    return ops.price_vs_mix(_kpi_day(spark, sf))


@register("history_tail",
          O.with_(_chain_day(), f"SELECT {KPI_SELECT} FROM kpi ORDER BY region DESC, country DESC, "
                                "period_start_utc DESC LIMIT 50"),
          KPI_DOUBLES)
def q_history_tail(spark, sf):
    """T4: last 50 history rows in file order (a top-k by key)."""
    return ops.history_tail(_kpi_day(spark, sf))


@register("price_summary",
          O.with_(_chain_day(), """SELECT report_date, avg_price, max_price, min_price, volatility_index, missing_rate,
  CASE WHEN missing_rate <= 0.02 THEN 'OK' ELSE 'WARN' END AS status FROM (
  SELECT CAST(period_start_utc AS DATE) AS report_date, avg(avg_price) AS avg_price, max(avg_price) AS max_price,
    min(avg_price) AS min_price, stddev_samp(avg_price) / nullif(avg(avg_price), 0.0) AS volatility_index,
    1.0 - least(avg(dq_coverage_pct), 100.0) / 100.0 AS missing_rate
  FROM kpi GROUP BY CAST(period_start_utc AS DATE))"""),
          ["avg_price", "max_price", "min_price", "volatility_index", "missing_rate"])
def q_price_summary(spark, sf):
    """Daily price summary with volatility index, missing rate and status."""
    return ops.price_summary(_kpi_day(spark, sf))


_PROFILE_COLS = ["period", "region", "country", "metric", "energy_source", "unit", "quality_flag",
                 "source_system"]


def _profile_oracle():
    kv = " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS value FROM readings" for c in _PROFILE_COLS)
    return O.with_(ad.duck_ctes("readings") + [f"kv AS ({kv})"], """SELECT s.column_name, s.n_rows, s.distinct_count,
  array_to_string(list_sort(d.vals)[1:50], '|') AS sample_values
  FROM (SELECT column_name, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT value) AS BIGINT) AS distinct_count
        FROM kv GROUP BY column_name) s
  LEFT JOIN (SELECT column_name, list(DISTINCT value) AS vals FROM kv WHERE value IS NOT NULL GROUP BY column_name) d
  ON s.column_name = d.column_name""")


@register("table_profile", _profile_oracle())
def q_table_profile(spark, sf):
    """Per text column row count, distinct count and sorted 50-value sample."""
    return ops.table_profile(A(spark, sf, "readings"), _PROFILE_COLS)



@register("table_profile_sketched", _profile_oracle())
def q_table_profile_sketched(spark, sf):
    """The same profile from mergeable sketches (0.8 % at one standard error; exact for counts as small as these)."""
    return ops.table_profile(A(spark, sf, "readings"), _PROFILE_COLS, sketched=True)

# ---------------------------------------------------------------------------
# Yearly and year comparison
# ---------------------------------------------------------------------------

YEARS = (1995, 2000)

_YEARLY = """yearly AS (SELECT country_iso2, CAST(year(date) AS BIGINT) AS year,
  round_even(avg(avg_price), 2) AS avg_price, round_even(stddev_samp(avg_price), 2) AS price_volatility
  FROM daily_prices WHERE date IS NOT NULL AND country_iso2 IS NOT NULL GROUP BY country_iso2, year(date))"""


@register("yearly_kpis", O.with_(ad.duck_ctes("daily_prices") + [_YEARLY], "SELECT * FROM yearly"),
          ["avg_price", "price_volatility"])
def q_yearly_kpis(spark, sf):
    """A10: yearly mean and std of daily prices per country (2 dp, half-even)."""
    return ops.yearly_kpis(A(spark, sf, "daily_prices"))


@register("year_compare",
          O.with_(ad.duck_ctes("daily_prices") + [_YEARLY], f"""SELECT a.country_iso2, CAST({YEARS[0]} AS BIGINT) AS year_a,
  CAST({YEARS[1]} AS BIGINT) AS year_b, a.avg_price AS value_a, b.avg_price AS value_b,
  b.avg_price - a.avg_price AS delta_abs,
  CASE WHEN a.avg_price IS NULL OR a.avg_price = 0 THEN NULL ELSE (b.avg_price - a.avg_price) / a.avg_price * 100.0 END AS delta_pct
  FROM (SELECT * FROM yearly WHERE year = {YEARS[0]}) a
  JOIN (SELECT * FROM yearly WHERE year = {YEARS[1]}) b ON a.country_iso2 IS NOT DISTINCT FROM b.country_iso2"""),
          ["value_a", "value_b", "delta_abs", "delta_pct"])
def q_year_compare(spark, sf):
    """Year A vs year B per country (one scan of the two years; oracle: self-join)."""
    return ops.year_compare(ops.yearly_kpis(A(spark, sf, "daily_prices"), years=YEARS), "avg_price", *YEARS)


@register("yoy_change",
          O.with_(ad.duck_ctes("daily_prices") + [_YEARLY], """SELECT country_iso2, year, avg_price AS current_avg_price,
  lag(avg_price) OVER (PARTITION BY country_iso2 ORDER BY year) AS previous_avg_price,
  round_even((avg_price - lag(avg_price) OVER (PARTITION BY country_iso2 ORDER BY year))
    / nullif(lag(avg_price) OVER (PARTITION BY country_iso2 ORDER BY year), 0.0) * 100.0, 2) AS change_pct
  FROM yearly"""),
          ["current_avg_price", "previous_avg_price", "change_pct"])
def q_yoy_change(spark, sf):
    """Current vs previous year average price and change percent."""
    return ops.yoy_change(ops.yearly_kpis(A(spark, sf, "daily_prices")))


_STUB = ("(coalesce(avg_price = 90.0 AND renewable_share_pct = 50.0, false) "
         "OR coalesce(total_generation_mwh = 336000.0, false))")
_KY_DOUBLES = ["avg_price", "renewable_share_pct", "price_volatility", "total_generation_mwh"]


@register("drop_placeholder_rows",
          O.with_(ad.duck_ctes("kpi_years"), f"SELECT * FROM kpi_years WHERE NOT {_STUB}"), _KY_DOUBLES)
def q_drop_placeholder_rows(spark, sf):
    """Drop baseline-looking rows (price 90 & share 50, or total 336000), NULL-safe."""
    return ops.drop_placeholder_rows(A(spark, sf, "kpi_years"))


def _cmp_cols():
    cols = []
    for m in ops.compare.COMPARE_METRICS:
        cols += [f"{m}_{YEARS[0]}", f"{m}_{YEARS[1]}", f"{m}_delta"]
    return cols


def _cmp_cte():
    a, b = YEARS
    per = []
    for m, how in ops.compare.COMPARE_METRICS.items():
        for y in YEARS:
            if how == "sum":
                per.append(f"CASE WHEN count(*) FILTER (WHERE yr = {y}) > 0 THEN coalesce(sum({m}) FILTER (WHERE yr = {y}), 0.0) END AS {m}_{y}")
            else:
                per.append(f"avg({m}) FILTER (WHERE yr = {y}) AS {m}_{y}")
    deltas = [f"{m}_{b} - {m}_{a} AS {m}_delta" for m in ops.compare.COMPARE_METRICS]
    return [f"""ky AS (SELECT *, year(period_start_utc) AS yr FROM kpi_years
  WHERE region = 'EU' AND country IS NOT NULL AND NOT {_STUB} AND (
   year(period_start_utc) IN ({a}, {b})))""",
            f"cmp0 AS (SELECT country, {', '.join(per)} FROM ky GROUP BY country)",
            f"cmp AS (SELECT *, {', '.join(deltas)} FROM cmp0)"]


def _cmp(spark, sf):
    return ops.year_comparison(A(spark, sf, "kpi_years"), YEARS)


def _cmp_sql(select, extra=None):
    return O.with_(ad.duck_ctes("kpi_years") + _cmp_cte() + (extra or []), select)


@register("year_comparison", _cmp_sql("SELECT * FROM cmp"), _cmp_cols())
def q_year_comparison(spark, sf):
    """Per-country metrics of two whole years and deltas."""
    return _cmp(spark, sf)


@register("year_comparison_ranked", _cmp_sql("""SELECT *, CAST(row_number() OVER (
  ORDER BY renewable_share_pct_delta DESC NULLS LAST, country) AS BIGINT) AS delta_rank FROM cmp"""), _cmp_cols())
def q_year_comparison_ranked(spark, sf):
    """The comparison in sink order (largest delta first, NULL last), the place as a column."""
    return ops.ranked_by_delta(_cmp(spark, sf))


for _m, _key in (("renewable_share_pct", "top_movers_renewable"), ("avg_price", "top_movers_price")):
    def _mk3(m=_m, key=_key):
        @register(key, _cmp_sql(f"SELECT country, {m}_{YEARS[0]}, {m}_{YEARS[1]}, {m}_delta FROM cmp "
                                f"ORDER BY {m}_delta DESC NULLS LAST, country LIMIT 10"),
                  [f"{m}_{YEARS[0]}", f"{m}_{YEARS[1]}", f"{m}_delta"])
        def q(spark, sf):
            """Top-10 movers by delta (NULL deltas last)."""
            return ops.top_movers(_cmp(spark, sf), m, YEARS, 10)
    _mk3()


@register("delta_bounds", _cmp_sql("""SELECT coalesce(min(renewable_share_pct_delta), -100.0) AS renewable_delta_min,
  coalesce(max(renewable_share_pct_delta), 100.0) AS renewable_delta_max,
  coalesce(min(avg_price_delta), -500.0) AS price_delta_min, coalesce(max(avg_price_delta), 500.0) AS price_delta_max FROM cmp"""),
          ["renewable_delta_min", "renewable_delta_max", "price_delta_min", "price_delta_max"])
def q_delta_bounds(spark, sf):
    """Default slider bounds from the non-NULL deltas."""
    return ops.delta_bounds(_cmp(spark, sf))


REN_RANGE, PRICE_RANGE = (-40.0, 40.0), (-400.0, 400.0)
_RANGE_WHERE = (f"avg_price_delta IS NOT NULL AND coalesce(renewable_share_pct_delta, 0.0) BETWEEN {REN_RANGE[0]} AND {REN_RANGE[1]} "
                f"AND coalesce(avg_price_delta, 0.0) BETWEEN {PRICE_RANGE[0]} AND {PRICE_RANGE[1]}")


@register("delta_range_filter", _cmp_sql(f"SELECT * FROM cmp WHERE {_RANGE_WHERE}"), _cmp_cols())
def q_delta_range_filter(spark, sf):
    """Slider filter (has price, both deltas in range, NULL read as 0)."""
    return ops.delta_range_filter(_cmp(spark, sf), REN_RANGE, PRICE_RANGE, only_price=True)


@register("delta_headline", _cmp_sql(f"""SELECT CAST(count(*) AS BIGINT) AS countries,
  max(renewable_share_pct_delta) AS max_renewable_delta, max(avg_price_delta) AS max_price_delta,
  min(avg_price_delta) AS min_price_delta FROM cmp WHERE {_RANGE_WHERE}"""),
          ["max_renewable_delta", "max_price_delta", "min_price_delta"])
def q_delta_headline(spark, sf):
    """Headline figures of the filtered comparison."""
    return ops.delta_headline(ops.delta_range_filter(_cmp(spark, sf), REN_RANGE, PRICE_RANGE))


_TOT_B = f"total_generation_mwh_{YEARS[1]}"


@register("transition_scatter", _cmp_sql(f"""SELECT country, renewable_share_pct_delta, avg_price_delta, {_TOT_B},
  sqrt({_TOT_B}) / (SELECT max(sqrt({_TOT_B})) FROM cmp WHERE renewable_share_pct_delta IS NOT NULL
     AND avg_price_delta IS NOT NULL AND {_TOT_B} IS NOT NULL) * 2500.0 AS bubble_size
  FROM cmp WHERE renewable_share_pct_delta IS NOT NULL AND avg_price_delta IS NOT NULL AND {_TOT_B} IS NOT NULL"""),
          ["renewable_share_pct_delta", "avg_price_delta", _TOT_B, "bubble_size"])
def q_transition_scatter(spark, sf):
    """Plot-ready rows with sqrt-scaled bubble size (max 2500)."""
    return ops.transition_scatter(_cmp(spark, sf), YEARS[1])


@register("drop_empty",
          O.with_(ad.duck_ctes("kpi_years"), "SELECT period_start_utc, region, country, avg_price, "
                  "renewable_share_pct, total_generation_mwh FROM kpi_years"),
          ["avg_price", "renewable_share_pct", "total_generation_mwh"])
def q_drop_empty(spark, sf):
    """Drop all-NULL columns (one counting pass), then all-NULL rows."""
    return ops.drop_empty(A(spark, sf, "kpi_years"))



@register("drop_empty_footers", "SELECT doc_id, lang, source, n_chars FROM documents")
def q_drop_empty_footers(spark, sf):
    """A written table with an empty column, which its file footers alone show (writers leave
    statistics of texts of several kB out; then the columns are counted, so ``text`` is not taken here)."""
    path = scratch_path(spark, "drop_empty")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "source", "n_chars")
    docs.withColumn("nothing", F.lit(None).cast("double")).write.parquet(path)
    return ops.drop_empty(spark.read.parquet(path), parquet=[path])

# ---------------------------------------------------------------------------
# Baseline grids (countries and ranges derived from the tables)
# ---------------------------------------------------------------------------

M1_DOUBLES = ["value"]


def _eu_bounds(spark, sf):
    """Observed member countries, each with the day range of the whole table (one scan)."""
    return ops.eu_scope(src.country_bounds(A(spark, sf, "readings"))).select("country", "start", "end").distinct()


def _years_bounds(spark, sf):
    return src.data_range(A(spark, sf, "readings_years"), "ts_utc", "day")


def _duck_eu_grid():
    return [O.scope_cte("scoped", "readings"),
            "rng AS (SELECT date_trunc('day', min(ts_utc)) AS s, date_trunc('day', max(ts_utc)) + INTERVAL 1 DAY AS e FROM readings)",
            f"eg AS (SELECT country, ts_utc FROM (SELECT c.country, s, unnest(generate_series(s, e - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS ts_utc "
            f"FROM (SELECT DISTINCT country FROM scoped) c CROSS JOIN rng))",
            O.profile_cte("eprof", EU_HOURLY_PROFILE)]


_YRNG = ("yrng AS (SELECT date_trunc('day', min(ts_utc)) AS s, date_trunc('day', max(ts_utc)) + INTERVAL 1 DAY AS e "
         "FROM readings_years)")
_DAYS = ("dg AS (SELECT ts_utc FROM (SELECT s, unnest(generate_series(s, e - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS ts_utc "
         "FROM yrng))")
_MONTHS = ("mg AS (SELECT ts_utc FROM (SELECT f, e, unnest(generate_series(f, e, INTERVAL 1 MONTH)) AS ts_utc FROM ("
           "SELECT CASE WHEN date_trunc('month', s) = s THEN date_trunc('month', s) ELSE date_trunc('month', s) + INTERVAL 1 MONTH END AS f, e FROM yrng)) "
           "WHERE ts_utc < e)")
_EU_BASE = O.baseline_select("eg", "eprof", "hour", "'EU'", "g.country", "entsoe")
_US_BASE = O.baseline_select("dg", "uprof", "day", "'US'", "'US'", "eia")
_CN_BASE = O.baseline_select("mg", "cprof", "month", "'CN'", "'CN'", "nbs_cn")


@register("baseline_hourly", O.with_(ad.duck_ctes("readings") + _duck_eu_grid(), _EU_BASE), M1_DOUBLES)
def q_baseline_hourly(spark, sf):
    """Hourly EU profile per observed member country over the data's day range."""
    return src.baseline_hourly(_eu_bounds(spark, sf))


@register("baseline_daily",
          O.with_(ad.duck_ctes("readings_years") + [_YRNG, _DAYS, O.profile_cte("uprof", US_DAILY_PROFILE)], _US_BASE),
          M1_DOUBLES)
def q_baseline_daily(spark, sf):
    """Daily US profile over the whole range."""
    return src.baseline_daily(_years_bounds(spark, sf))


@register("baseline_monthly",
          O.with_(ad.duck_ctes("readings_years") + [_YRNG, _MONTHS, O.profile_cte("cprof", CN_MONTHLY_PROFILE)], _CN_BASE),
          M1_DOUBLES)
def q_baseline_monthly(spark, sf):
    """S3: monthly CN profile, month starts on/after the range start."""
    return src.baseline_monthly(_years_bounds(spark, sf))


@register("multi_region_union",
          O.with_(ad.duck_ctes("readings", "readings_years") + _duck_eu_grid()
                  + [_YRNG, _DAYS, _MONTHS, O.profile_cte("uprof", US_DAILY_PROFILE),
                     O.profile_cte("cprof", CN_MONTHLY_PROFILE)],
                  f"{_EU_BASE} UNION ALL {_US_BASE} UNION ALL {_CN_BASE}"),
          M1_DOUBLES)
def q_multi_region_union(spark, sf):
    """EU hourly + US daily + CN monthly canonical readings."""
    yb = _years_bounds(spark, sf)
    return src.multi_region_union(src.baseline_hourly(_eu_bounds(spark, sf)),
                                  src.baseline_daily(yb), src.baseline_monthly(yb))


# ---------------------------------------------------------------------------
# Wide generation and price series
# ---------------------------------------------------------------------------
_FUELS = ["wind_onshore", "fossil_gas", "nuclear", "hydro_pumped_storage", "waste"]
_GW_H = ("gwh AS (SELECT country, date_trunc('hour', ts) AS ts_utc, "
         + ", ".join(f"sum({c}) AS {c}" for c in _FUELS) + " FROM gen_wide GROUP BY country, date_trunc('hour', ts))")


@register("generation_wide_to_long",
          O.with_(ad.duck_ctes("gen_wide") + [_GW_H, f"gwu AS (UNPIVOT gwh ON {', '.join(_FUELS)} INTO NAME fuel_type VALUE value)"],
                  f"""SELECT ts_utc, 'hour' AS period, 'EU' AS region, country, 'generation' AS metric,
  {O.fuel_case('fuel_type')} AS energy_source, value, 'MWh' AS unit, 'ok' AS quality_flag, 'entsoe' AS source_system
  FROM gwu WHERE value IS NOT NULL AND ts_utc IS NOT NULL"""),
          M1_DOUBLES)
def q_generation_wide_to_long(spark, sf):
    """Wide hourly generation -> canonical long rows (hourly sum, fuel buckets)."""
    return src.generation_wide_to_long(A(spark, sf, "gen_wide"))


@register("fuel_buckets",
          O.with_(ad.duck_ctes("gen_wide") + [f"u AS (UNPIVOT (SELECT ts AS ts_utc, country, {', '.join(_FUELS)} FROM gen_wide) "
                                              f"ON {', '.join(_FUELS)} INTO NAME fuel_type VALUE value)"],
                  f"SELECT ts_utc, country, fuel_type, value, {O.fuel_case('fuel_type')} AS energy_source FROM u WHERE value IS NOT NULL"),
          M1_DOUBLES)
def q_fuel_buckets(spark, sf):
    """Fuel-type name -> energy source (last matching rule wins)."""
    return src.fuel_types(A(spark, sf, "gen_wide"))


@register("flatten_columns",
          O.with_(ad.duck_ctes("gen_wide"), 'SELECT ts, country, wind_onshore AS "Wind Onshore_Actual Aggregated", '
                  'fossil_gas AS "Wind Onshore_Actual Consumption", nuclear AS "Nuclear_Actual Aggregated", '
                  'waste AS "Nuclear", hydro_pumped_storage AS "Hydro.Pumped" FROM gen_wide'),
          ["Wind Onshore_Actual Aggregated", "Wind Onshore_Actual Consumption", "Nuclear_Actual Aggregated", "Nuclear",
           "Hydro.Pumped"])
def q_flatten_columns(spark, sf):
    """P20: two-level column names flattened, blank levels skipped, dots kept."""
    g = A(spark, sf, "gen_wide")
    nested = g.select("ts", "country",
                      F.struct(F.col("wind_onshore").alias("Actual Aggregated"),
                               F.col("fossil_gas").alias("Actual Consumption")).alias("Wind Onshore"),
                      F.struct(F.col("nuclear").alias("Actual Aggregated"),
                               F.col("waste").alias(" ")).alias("Nuclear"),
                      F.col("hydro_pumped_storage").alias("Hydro.Pumped"))
    return src.flatten_columns(nested)


@register("price_hourly",
          O.with_(ad.duck_ctes("readings") + [O.scope_cte("scoped", "readings")], """SELECT ts_utc, 'hour' AS period, 'EU' AS region,
  country, 'price' AS metric, 'all' AS energy_source, value, 'EUR/MWh' AS unit, 'ok' AS quality_flag, 'entsoe' AS source_system
  FROM (SELECT country, date_trunc('hour', ts_utc) AS ts_utc, avg(value) AS value FROM scoped WHERE metric = 'price'
        GROUP BY country, date_trunc('hour', ts_utc)) WHERE value IS NOT NULL"""),
          M1_DOUBLES)
def q_price_hourly(spark, sf):
    """Price series -> hourly mean per country; empty hours vanish."""
    prices = ops.eu_scope(ops.normalize_ts(A(spark, sf, "readings"))).where(F.col("metric") == "price")
    return src.price_to_hourly(prices)


# ---------------------------------------------------------------------------
# Monthly files and pages
# ---------------------------------------------------------------------------
_ML = O.monthly_long_cte("ml", "monthly_raw", '"Date"', '"Area"', '" Variable"', '"Value"', '"Unit"')
_MR_COLS = ["Date", "Area", " Variable", "Unit", "Value"]


@register("monthly_to_long", O.with_(ad.duck_ctes("monthly_raw") + [_ML], "SELECT * FROM ml"), M1_DOUBLES)
def q_monthly_to_long(spark, sf):
    """S7 (long input): role detection, metric/source rules, lenient parsing."""
    return src.monthly_to_long(A(spark, sf, "monthly_raw"))


_WIDE_COLS = ", ".join(f'"{v}"' for v in ad.WIDE_VARIABLES)


@register("monthly_wide_to_long",
          O.with_(ad.duck_ctes("monthly_wide") + [f'mwu AS (UNPIVOT monthly_wide ON {_WIDE_COLS} INTO NAME variable VALUE value)',
                                                  O.monthly_long_cte("mwl", "mwu", '"Date"', '"Area"', "variable", "value", "'unknown'")],
                  "SELECT * FROM mwl"),
          M1_DOUBLES)
def q_monthly_wide_to_long(spark, sf):
    """S7 (wide input): unpivot the variable columns, then the same rules."""
    return src.monthly_to_long(A(spark, sf, "monthly_wide"))


@register("monthly_raw_long",
          O.with_(ad.duck_ctes("monthly_raw"), """SELECT * FROM (
  SELECT TRY_CAST("Date" AS TIMESTAMP) AS ts_utc, 'month' AS period, 'GLOBAL' AS region, "Area" AS country,
    lower(u.variable) AS metric, 'all' AS energy_source, TRY_CAST(u.value AS DOUBLE) AS value, 'unknown' AS unit,
    'ok' AS quality_flag, 'ember' AS source_system
  FROM (UNPIVOT monthly_raw ON " Variable", "Unit", "Value" INTO NAME variable VALUE value) u)
  WHERE ts_utc IS NOT NULL AND value IS NOT NULL"""),
          M1_DOUBLES)
def q_monthly_raw_long(spark, sf):
    """The older rule-free monthly shaping (verbatim variable as metric)."""
    return src.monthly_raw_to_long(A(spark, sf, "monthly_raw"))


@register("normalize_ts",
          O.with_(ad.duck_ctes("monthly_raw"), 'SELECT TRY_CAST("Date" AS TIMESTAMP) AS "Date", "Area", " Variable", "Unit", "Value" '
                  'FROM monthly_raw WHERE TRY_CAST("Date" AS TIMESTAMP) IS NOT NULL'))
def q_normalize_ts(spark, sf):
    """Parse a text time column as UTC and drop what does not parse."""
    return ops.normalize_ts(A(spark, sf, "monthly_raw"), "Date")


@register("rule_buckets",
          O.with_(ad.duck_ctes("monthly_raw"), f"""SELECT *, {O.rule_case('lower(trim(" Variable"))', METRIC_RULES, 'other')} AS metric,
  {O.rule_case('lower(trim(" Variable"))', SOURCE_RULES, 'all')} AS energy_source FROM monthly_raw"""))
def q_rule_buckets(spark, sf):
    """Variable text -> metric and energy-source buckets (first rule wins)."""
    return src.rule_buckets(A(spark, sf, "monthly_raw"), " Variable")


@register("eu_scope_export",
          O.with_(ad.duck_ctes("monthly_raw") + [_ML], f"SELECT ts_utc, period, 'EU' AS region, country, metric, energy_source, "
                  f"value, unit, quality_flag, source_system FROM ml WHERE country IN ({_EU_NAMES})"),
          M1_DOUBLES)
def q_eu_scope_export(spark, sf):
    """Report scope keeps display names of members only, region EU."""
    return ops.export_scope(src.monthly_to_long(A(spark, sf, "monthly_raw")))


@register("page_data_links", O.with_(ad.duck_ctes("linked_pages"), """SELECT page_id,
  CASE WHEN link LIKE '/%' THEN concat(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1), link) ELSE link END AS data_url
FROM (SELECT page_id, url, nullif(regexp_extract(html, '(?i)href="([^"]+\\.csv)"', 1), '') AS link FROM linked_pages) WHERE link IS NOT NULL"""))
def q_page_data_links(spark, sf):
    """First CSV link per page, site-relative links made absolute."""
    return src.page_data_links(A(spark, sf, "linked_pages"))


# ---------------------------------------------------------------------------
# Fallback, range selection, country aliases
# ---------------------------------------------------------------------------
_FILLED = (ad.duck_ctes("readings_partial") + [
    O.scope_cte("scoped", "readings_partial"),
    "win AS (SELECT date_trunc('day', min(ts_utc)) AS ws, date_trunc('day', max(ts_utc)) + INTERVAL 1 DAY AS we FROM readings_partial)",
    "req AS (SELECT DISTINCT country FROM scoped)",
    "miss AS (SELECT country FROM req WHERE country NOT IN (SELECT country FROM scoped WHERE metric IN ('generation','price')))",
    "eg AS (SELECT country, unnest(generate_series(ws, we - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS ts_utc FROM miss, win)",
    O.profile_cte("eprof", EU_HOURLY_PROFILE),
    f"runrows AS (SELECT *, 'live' AS source_kind FROM scoped UNION ALL SELECT *, 'stub' AS source_kind FROM ({_EU_BASE}))"])


def _request(spark, sf):
    """Feed, requested countries (all that ever report), and the run window (the feed's days)."""
    feed = A(spark, sf, "readings_partial")
    win = src.data_range(feed).select(F.struct("start", "end")).scalar()
    return feed, ops.eu_scope(feed.select("country").distinct()).select("country"), win["start"], win["end"]


@register("fallback_fill", O.with_(_FILLED, "SELECT * FROM runrows"), M1_DOUBLES)
def q_fallback_fill(spark, sf):
    """Requested countries that delivered no generation or price rows in
    the run window get the hourly baseline, the others keep their rows."""
    feed, requested, start, end = _request(spark, sf)
    return src.fallback_fill(ops.eu_scope(ops.normalize_ts(feed)), requested, start, end)


@register("run_kind", O.with_(_FILLED, """SELECT CASE WHEN count(*) FILTER (WHERE source_kind = 'live') = 0 THEN 'eu_stub'
  WHEN count(*) FILTER (WHERE source_kind = 'stub') > 0 THEN 'eu_live_with_stub' ELSE 'eu_live' END AS raw_kind FROM runrows"""))
def q_run_kind(spark, sf):
    """Label of a run that mixes live and stub countries."""
    feed, requested, start, end = _request(spark, sf)
    return src.run_kind(src.fallback_fill(ops.eu_scope(ops.normalize_ts(feed)), requested, start, end))


@register("range_select",
          O.with_(ad.duck_ctes("readings") + [O.scope_cte("scoped", "readings")],
                  "SELECT * FROM scoped WHERE ts_utc >= TIMESTAMP '2024-01-08' AND ts_utc < TIMESTAMP '2024-01-15' "
                  f"AND country IN ({_EU_NAMES})"),
          M1_DOUBLES)
def q_range_select(spark, sf):
    """Half-open week range and a country list (the members)."""
    scoped = ops.eu_scope(ops.normalize_ts(A(spark, sf, "readings")))
    return ops.range_select(scoped, "2024-01-08", "2024-01-15", [n for _, n in EU27])


@register("country_alias",
          O.with_(ad.duck_ctes("country_lists"), """SELECT event_id, countries,
  array_to_string(list_transform(list_filter(list_transform(string_split(countries, ','), lambda x: trim(x)), lambda x: x <> ''),
    lambda x: CASE WHEN upper(x) = 'DE' THEN 'DE_LU' ELSE x END), ',') AS countries_alias,
  array_to_string(list_transform(list_filter(list_transform(string_split(
    array_to_string(list_transform(list_filter(list_transform(string_split(countries, ','), lambda x: trim(x)), lambda x: x <> ''),
      lambda x: CASE WHEN upper(x) = 'DE' THEN 'DE_LU' ELSE x END), ','), ','), lambda x: trim(x)), lambda x: x <> ''),
    lambda x: CASE WHEN upper(x) = 'DE_LU' THEN 'DE' ELSE x END), ',') AS countries_back
  FROM country_lists"""))
def q_country_alias(spark, sf):
    """Comma lists trimmed, blanks dropped, DE -> DE_LU (and back)."""
    df = ops.alias_countries(A(spark, sf, "country_lists"), "countries", "countries_alias")
    return ops.alias_countries(df, "countries_alias", "countries_back", inverse=True)


# ---------------------------------------------------------------------------
# Round trips through files, global pipeline
# ---------------------------------------------------------------------------

@register("csv_roundtrip", O.with_(ad.duck_ctes("text_rows"), "SELECT * FROM text_rows"))
def q_csv_roundtrip(spark, sf):
    """CSV sink then all-text CSV scan; line breaks, quotes, empty text and NULL survive."""
    path = scratch_path(spark, "csv_roundtrip")
    src.write_csv(A(spark, sf, "text_rows"), path)
    return src.read_csv(spark, path)


@register("csv_typed_text", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_csv_typed_text(spark, sf):
    """Whole documents with their line breaks and quotes through CSV and back, typed by a schema."""
    path = scratch_path(spark, "csv_typed_text")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    src.write_csv(docs, path)
    return src.read_csv(spark, path, docs.schema)


def _history_order_oracle():
    return O.with_(_chain_day(), f"""SELECT region, country, period_start_utc,
  CAST(row_number() OVER (ORDER BY region, country, period_start_utc) - 1 AS BIGINT) AS position
  FROM kpi WHERE country IN ({_EU_NAMES})""")


@register("kpi_history_order", _history_order_oracle())
def q_kpi_history_order(spark, sf):
    """The place of every row in the written history files, read back, is its place in key order."""
    path = scratch_path(spark, "kpi_history_order")
    src.write_kpi_history(_kpi_day(spark, sf), path)
    return src.read_csv_in_order(spark, path, KPI).select("region", "country", "period_start_utc", "position")


@register("cache_keys", """SELECT doc_id, substring(sha256('{"agg": "day", "countries": [' || coalesce(to_json(lang)::VARCHAR, 'null') || ', '
  || coalesce(to_json(source)::VARCHAR, 'null') || '], "end": null, "kind": ' || coalesce(to_json(text)::VARCHAR, 'null')
  || ', "mode": "eu", "start": ' || coalesce(n_chars::VARCHAR, 'null') || '}'), 1, 16) AS cache_key FROM documents""")
def q_cache_keys(spark, sf):
    """S10/hash: the cache key of a table of parameters (texts with quotes and line breaks, arrays, NULLs)."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    params = F.struct(F.lit("eu").alias("mode"), F.array("lang", "source").alias("countries"), F.col("n_chars").alias("start"),
                      F.lit(None).cast("string").alias("end"), F.lit("day").alias("agg"), F.col("text").alias("kind"))
    kind = docs.select(params.alias("p")).schema["p"].dataType
    return docs.select("doc_id", json_key_column(params, kind).alias("cache_key"))


@register("raw_cache_roundtrip", O.with_(ad.duck_ctes("readings") + [O.scope_cte("scoped", "readings")],
                                         "SELECT * FROM scoped"), M1_DOUBLES)
def q_raw_cache_roundtrip(spark, sf):
    """Parameter-keyed parquet cache write and read-back."""
    root = scratch_path(spark, "raw_cache")
    path = src.raw_path(root, "entsoe", "eu", {"mode": "eu", "agg": "day", "sf": sf})
    src.write_raw(ops.eu_scope(ops.normalize_ts(A(spark, sf, "readings"))), path)
    return src.read_raw(spark, path)


@register("latest_cached", O.with_(ad.duck_ctes("readings") + [O.scope_cte("scoped", "readings")],
                                   "SELECT * FROM scoped"), M1_DOUBLES)
def q_latest_cached(spark, sf):
    """Of two cache entries, read the one committed last: laid out by
    month, at the smaller path (the entry before it is flat and at the greater)."""
    root = scratch_path(spark, "raw_cache")
    src.write_raw(src.monthly_to_long(A(spark, sf, "monthly_raw")),
                  src.raw_path(root, "ember", "monthly", {"mode": "global"}))
    src.write_raw(ops.eu_scope(ops.normalize_ts(A(spark, sf, "readings"))),
                  src.raw_path(root, "actuals", "eu", {"mode": "eu"}), partition_by_month=True)
    return src.read_latest_cached(spark, root)


_KPI_ITEMS = ["total_generation_mwh", "renewable_share_pct", "fossil_share_pct", "nuclear_share_pct", "avg_price",
              "price_volatility", "dq_coverage_pct"]
_KPI_LATEST_CTE = f"""kl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY region, country ORDER BY period_start_utc DESC) AS rn
  FROM kpi WHERE country IN ({_EU_NAMES})) WHERE rn = 1)"""


@register("kpi_latest_document", O.with_(_chain_day() + [_KPI_LATEST_CTE], f"""SELECT 'day' AS period,
  strftime((SELECT max(period_start_utc) FROM kl), '%Y-%m-%dT%H:%M:%SZ') AS document_start, region, country,
  strftime(period_start_utc, '%Y-%m-%dT%H:%M:%SZ') AS period_start_utc, price_unit, dq_issue_count, {', '.join(_KPI_ITEMS)} FROM kl"""),
          _KPI_ITEMS)
def q_kpi_latest_document(spark, sf):
    """The latest-KPI document, written as JSON and read back, one row per item."""
    path = scratch_path(spark, "kpi_latest")
    src.write_json_document(src.kpi_latest_document(_kpi_day(spark, sf), "day"), path)
    doc = src.read_json_document(spark, path).withColumnRenamed("period_start_utc", "document_start")
    cols = ["region", "country", "period_start_utc", "price_unit", "dq_issue_count", *_KPI_ITEMS]
    return doc.select("period", "document_start", F.explode("items").alias("i")).select(
        "period", "document_start", *(F.col(f"i.{c}") for c in cols))


@register("dq_latest_document", O.with_(_chain_day() + [_DQ_LATEST], """SELECT 'day' AS period,
  strftime(max(ts_utc) OVER (), '%Y-%m-%dT%H:%M:%SZ') AS document_ts, min(coverage_pct) OVER () AS min_coverage_pct,
  CAST(sum(CASE WHEN coverage_pct < 98.0 THEN 1 ELSE 0 END) OVER () AS BIGINT) AS countries_below_98pct,
  CAST(sum(issue_count) OVER () AS BIGINT) AS total_issue_count, region, country,
  strftime(ts_utc, '%Y-%m-%dT%H:%M:%SZ') AS ts_utc, coverage_pct, issue_count FROM dql"""),
          ["min_coverage_pct", "coverage_pct"])
def q_dq_latest_document(spark, sf):
    """The latest-DQ document, written as JSON and read back, one row per item."""
    path = scratch_path(spark, "dq_latest")
    src.write_json_document(src.dq_latest_document(ops.dq_rollup(_cov(spark, sf, "day")), "day"), path)
    doc = src.read_json_document(spark, path)
    return doc.select("period", F.col("ts_utc").alias("document_ts"), "summary.*", F.explode("items").alias("i")).select(
        "period", "document_ts", "min_coverage_pct", "countries_below_98pct", "total_issue_count",
        *(F.col(f"i.{c}") for c in ("region", "country", "ts_utc", "coverage_pct", "issue_count")))


def _run_oracle():
    ctes = _FILLED + O.bucket_ctes("runrows", "day")
    ctes.append(f"bucketed AS ({O.bucketed_select('cov')})")
    ctes.append(O.dq_cte("cov"))
    ctes += O.kpi_ctes("bucketed", "day", "dq")
    return O.with_(ctes, f"SELECT {KPI_SELECT}, 'entsoe' AS raw_source, 'eu_live_with_stub' AS raw_kind FROM kpi "
                         f"WHERE country IN ({_EU_NAMES})")


@register("eu_run", _run_oracle(), KPI_DOUBLES)
def q_eu_run(spark, sf):
    """A whole run (request, fallback, raw cache, reports); its history file
    read back, with the labels that the run reports."""
    feed, requested, start, end = _request(spark, sf)
    out = run_eu(spark, feed, scratch_path(spark, "eu_run"), "day", requested=requested, start=start, end=end)
    return (src.read_kpi_history(spark, out["kpi_history_csv"])
            .withColumn("raw_source", F.lit(out["raw_source"])).withColumn("raw_kind", F.lit(out["raw_kind"])))


@register("history_head", O.with_(_chain_day(), f"SELECT {KPI_SELECT} FROM kpi ORDER BY region NULLS LAST, country NULLS LAST, "
                                                "period_start_utc NULLS LAST LIMIT 10"), KPI_DOUBLES)
def q_history_head(spark, sf):
    """T5: first 10 rows in a stated order (a top-k)."""
    return ops.head_rows(_kpi_day(spark, sf), ["region", "country", "period_start_utc"], 10)


@register("monthly_dropped_rows", O.with_(ad.duck_ctes("monthly_raw") + [f"""mr AS (SELECT TRY_CAST("Date" AS TIMESTAMP) AS ts,
  TRY_CAST("Value" AS DOUBLE) AS v, {O.rule_case('lower(trim(" Variable"))', METRIC_RULES, 'other')} AS m FROM monthly_raw)"""],
    """SELECT count(*) AS n_rows, count(*) FILTER (WHERE ts IS NULL) AS bad_date,
  count(*) FILTER (WHERE ts IS NOT NULL AND v IS NULL) AS bad_value,
  count(*) FILTER (WHERE ts IS NOT NULL AND v IS NOT NULL AND m = 'other') AS other_metric,
  count(*) FILTER (WHERE ts IS NOT NULL AND v IS NOT NULL AND m <> 'other') AS kept FROM mr"""))
def q_monthly_dropped_rows(spark, sf):
    """What the monthly shaping keeps and drops, and why."""
    return src.dropped_rows(A(spark, sf, "monthly_raw"))


@register("kpi_history_export", O.with_(_chain_day(), f"SELECT {KPI_SELECT} FROM kpi WHERE country IN ({_EU_NAMES})"),
          KPI_DOUBLES)
def q_kpi_history_export(spark, sf):
    """History CSV (report scope, overwrite) read back with the KPI schema."""
    path = scratch_path(spark, "kpi_history")
    src.write_kpi_history(_kpi_day(spark, sf), path)
    return src.read_kpi_history(spark, path)


def _global_oracle():
    ctes = ad.duck_ctes("monthly_raw") + [_ML, O.scope_cte("gscoped", "ml")]
    ctes += O.bucket_ctes("gscoped", "month")
    ctes.append(f"bucketed AS ({O.bucketed_select('cov')})")
    ctes.append(O.dq_cte("cov"))
    ctes += O.kpi_ctes("bucketed", "month", "dq")
    return O.with_(ctes, f"SELECT {KPI_SELECT} FROM kpi")


def _global_run_oracle():
    ctes = ad.duck_ctes("monthly_raw") + [_ML, O.scope_cte("gscoped", "ml")] + O.bucket_ctes("gscoped", "month")
    ctes += [f"bucketed AS ({O.bucketed_select('cov')})", O.dq_cte("cov")] + O.kpi_ctes("bucketed", "month", "dq")
    return O.with_(ctes, f"""SELECT {KPI_SELECT}, (SELECT count(*) FROM ml) AS cached_rows, 'ember' AS raw_source,
  'monthly_kpi' AS raw_kind, strftime(max(period_start_utc) OVER (), '%Y-%m-%dT%H:%M:%SZ') AS latest_start,
  (SELECT count(DISTINCT country) FROM kpi WHERE country IN ({_EU_NAMES})) AS latest_items,
  (SELECT strftime(max(ts_utc), '%Y-%m-%dT%H:%M:%SZ') FROM dq) AS dq_latest_ts
  FROM kpi WHERE country IN ({_EU_NAMES})""")


@register("global_run", _global_run_oracle(), KPI_DOUBLES)
def q_global_run(spark, sf):
    """A whole global run; its history read back, with what its cache entry and its two documents hold."""
    out = run_global(spark, A(spark, sf, "monthly_raw"), scratch_path(spark, "global_run"))
    kpi, dq = (src.read_json_document(spark, out[k]).first() for k in ("kpi_latest_json", "dq_latest_json"))
    facts = {"cached_rows": src.read_raw(spark, out["raw_cache"]).count(), "raw_source": out["raw_source"], "raw_kind": out["raw_kind"],
             "latest_start": kpi["period_start_utc"], "latest_items": len(kpi["items"]), "dq_latest_ts": dq["ts_utc"]}
    return src.read_kpi_history(spark, out["kpi_history_csv"]).select("*", *[F.lit(v).alias(k) for k, v in facts.items()])


@register("global_pipeline", _global_oracle(), KPI_DOUBLES)
def q_global_pipeline(spark, sf):
    """Monthly global table -> long -> EU scope -> month buckets -> KPI with DQ."""
    return global_pipeline(A(spark, sf, "monthly_raw")).kpi


def _optional_queries():
    """The training-data operators (subpackage ``llm`` with ``corpus_pipeline``)
    are registered only where that subpackage is present."""
    try:
        return importlib.import_module("gridmetrics.llm.queries")
    except ModuleNotFoundError as e:
        if (e.name or "").startswith("gridmetrics.llm") or e.name == "corpus_pipeline":
            return None
        raise


_LLM = _optional_queries()
if _LLM is not None:
    _QUERIES.update(_LLM.QUERIES)
    _ORACLES.update(_LLM.ORACLES)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query (E1) on the sf0.001 tables."""
    return _QUERIES["eu_pipeline"](spark, SMOKE_DIR)


def frames() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_FRAMES)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
