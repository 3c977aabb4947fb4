"""Table schemas and the fixed values results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as listed for results to match:
# the EU27 member list (ISO2 code, display name), the constant baseline
# profiles, the text rules that bucket fuels and variables, the data-quality
# thresholds, and the column lists of the tables and documents.
# ---------------------------------------------------------------------------
EU27 = [
    ("AT", "Austria"),
    ("BE", "Belgium"),
    ("BG", "Bulgaria"),
    ("HR", "Croatia"),
    ("CY", "Cyprus"),
    ("CZ", "Czechia"),
    ("DK", "Denmark"),
    ("EE", "Estonia"),
    ("FI", "Finland"),
    ("FR", "France"),
    ("DE", "Germany"),
    ("GR", "Greece"),
    ("HU", "Hungary"),
    ("IE", "Ireland"),
    ("IT", "Italy"),
    ("LV", "Latvia"),
    ("LT", "Lithuania"),
    ("LU", "Luxembourg"),
    ("MT", "Malta"),
    ("NL", "Netherlands"),
    ("PL", "Poland"),
    ("PT", "Portugal"),
    ("RO", "Romania"),
    ("SK", "Slovakia"),
    ("SI", "Slovenia"),
    ("ES", "Spain"),
    ("SE", "Sweden"),
]

# Baseline profiles: (metric, energy_source, value, unit, quality_flag)
EU_HOURLY_PROFILE = [
    ("generation", "renewable", 1000.0, "MWh", "ok"),
    ("generation", "fossil", 800.0, "MWh", "ok"),
    ("generation", "nuclear", 200.0, "MWh", "ok"),
    ("price", "all", 90.0, "EUR/MWh", "ok"),
]
US_DAILY_PROFILE = [
    ("generation", "renewable", 50000.0, "MWh", "ok"),
    ("generation", "fossil", 120000.0, "MWh", "ok"),
    ("generation", "nuclear", 30000.0, "MWh", "ok"),
    ("price", "all", 60.0, "USD/MWh", "unit_converted"),
]
CN_MONTHLY_PROFILE = [
    ("generation", "renewable", 900000.0, "MWh", "low_granularity"),
    ("generation", "fossil", 2500000.0, "MWh", "low_granularity"),
    ("generation", "nuclear", 300000.0, "MWh", "low_granularity"),
]

# Fuel-type column names (wide hourly generation): regex alternatives per bucket,
# applied in this order with the LAST matching rule winning.
FUEL_RULES = [
    ("nuclear", "nuclear"),
    ("renewable", "wind|solar|hydro|renewable|biomass|geothermal"),
    ("fossil", "coal|gas|oil|lignite|fossil"),
]

# Variable text (monthly data): substring lists, FIRST matching rule wins.
METRIC_RULES = [
    ("generation", ["generation", "electricity generation", "power generation"]),
    ("price", ["price", "wholesale", "spot"]),
]
SOURCE_RULES = [
    ("nuclear", ["nuclear"]),
    ("renewable", ["renewable", "wind", "solar", "hydro", "biomass", "geothermal"]),
    ("fossil", ["fossil", "coal", "gas", "oil", "lignite"]),
]

# Metric -> resample aggregate
METRIC_AGG = {"generation": "sum", "load": "sum", "net_import": "sum", "price": "mean"}
MIN_COVERAGE_PCT = 98.0          # default data-quality threshold
REPORT_COVERAGE_PCT = 98.0       # fixed threshold of the DQ report summary
LEVELS = ("hour", "day", "week", "month")
DEFAULT_LEVEL = {"eu": "day", "global": "month"}
PRICE_UNIT_PREFERRED = "EUR/MWh"
GERMANY_ALIAS = ("DE", "DE_LU")
# Placeholder-row signature: (avg_price, renewable_share_pct) pair, or total generation
PLACEHOLDER_PRICE_SHARE = (90.0, 50.0)
PLACEHOLDER_TOTAL_MWH = 336000.0
BUBBLE_MAX = 2500.0
DELTA_DEFAULT_BOUNDS = {"renewable_share_pct_delta": 100.0, "avg_price_delta": 500.0}
SERIES_COLS = ["region", "country", "metric", "energy_source", "unit", "source_system"]
KPI_KEY = ["period_start_utc", "region", "country"]
MWH_COLS = ["renewable_mwh", "fossil_mwh", "nuclear_mwh", "total_generation_mwh", "net_import_mwh"]

READINGS = T.StructType([
    T.StructField("ts_utc", T.TimestampType()),
    T.StructField("period", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("energy_source", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("quality_flag", T.StringType()),
    T.StructField("source_system", T.StringType()),
])
READING_COLS = [f.name for f in READINGS.fields]

DQ_BUCKET = T.StructType([
    T.StructField("ts_utc", T.TimestampType()),
    T.StructField("region", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("period", T.StringType()),
    T.StructField("coverage_pct", T.DoubleType()),
    T.StructField("issue_count", T.LongType()),
])

KPI = T.StructType([
    T.StructField("period_start_utc", T.TimestampType()),
    T.StructField("region", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("fossil_mwh", T.DoubleType()),
    T.StructField("renewable_mwh", T.DoubleType()),
    T.StructField("nuclear_mwh", T.DoubleType()),
    T.StructField("total_generation_mwh", T.DoubleType()),
    T.StructField("renewable_share_pct", T.DoubleType()),
    T.StructField("fossil_share_pct", T.DoubleType()),
    T.StructField("nuclear_share_pct", T.DoubleType()),
    T.StructField("avg_price", T.DoubleType()),
    T.StructField("price_volatility", T.DoubleType()),
    T.StructField("price_unit", T.StringType()),
    T.StructField("net_import_mwh", T.DoubleType()),
    T.StructField("period", T.StringType()),
    T.StructField("dq_coverage_pct", T.DoubleType()),
    T.StructField("dq_issue_count", T.LongType()),
])
KPI_COLS = [f.name for f in KPI.fields]
KPI_CORE_COLS = KPI_COLS[:-2]

LATEST_KPI_ITEM_COLS = [
    "region", "country", "period_start_utc", "total_generation_mwh",
    "renewable_share_pct", "fossil_share_pct", "nuclear_share_pct",
    "avg_price", "price_unit", "price_volatility", "dq_coverage_pct", "dq_issue_count",
]
LATEST_DQ_ITEM_COLS = ["region", "country", "ts_utc", "coverage_pct", "issue_count"]
# ---------------------------------------------------------------------------


def require_columns(df, required, what: str = "input") -> None:
    """Fail early, on the driver, when a required column is missing."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing columns in {what}: {missing}")
