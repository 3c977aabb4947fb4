"""Adapters from the driver's generic test tables to this package's input
shapes (canonical readings, wide generation, monthly files, daily prices,
KPI-like history).

Each adapter is ONE SQL text, run by Spark (tables bound as DataFrame
parameters) and by DuckDB (tables as views), so both sides start from the
same rows. Every adapter reads its whole source table; modulo arithmetic
only *assigns* attributes (country, metric, NULL injection). The joins with
the small value lists (geo, variables) match every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import EU27

# Test-only extension of the member list: three non-members that scope must drop.
NON_MEMBERS = [("GB", "United Kingdom"), ("NO", "Norway"), ("CH", "Switzerland")]
GEO = [(i, iso, name) for i, (iso, name) in enumerate(EU27 + NON_MEMBERS)]


def geo_cte() -> str:
    vals = ", ".join(f"({i}, '{iso}', '{name}')" for i, iso, name in GEO)
    return f"geo(idx, iso2, name) AS (VALUES {vals})"


BODIES: dict[str, tuple[str, list[str]]] = {
    "readings": ("""
SELECT CAST(e.ts AS TIMESTAMP) AS ts_utc, 'hour' AS period, 'X' AS region,
  CASE WHEN e.event_id % 2 = 0 THEN g.iso2 ELSE concat(' ', g.name, ' ') END AS country,
  CASE e.event_type WHEN 'signup' THEN 'price'
    WHEN 'error' THEN CASE e.event_id % 3 WHEN 0 THEN 'load' WHEN 1 THEN 'net_import' ELSE 'other' END
    ELSE 'generation' END AS metric,
  CASE e.event_type WHEN 'click' THEN 'renewable' WHEN 'view' THEN 'fossil' WHEN 'purchase' THEN 'nuclear' ELSE 'all' END AS energy_source,
  CASE WHEN e.event_id % 17 = 0 THEN NULL ELSE e.value END AS value,
  CASE WHEN e.event_id % 101 = 0 THEN NULL WHEN e.event_type = 'signup' THEN 'EUR/MWh' ELSE 'MWh' END AS unit,
  'ok' AS quality_flag,
  CASE WHEN e.event_id % 5 = 0 THEN 'ember' ELSE 'entsoe' END AS source_system
FROM {events} e JOIN geo g ON e.user_id % 30 = g.idx""", ["events"]),
    "readings_years": ("""
SELECT CAST(l.l_shipdate AS TIMESTAMP) AS ts_utc, 'hour' AS period, 'X' AS region, g.iso2 AS country,
  CASE WHEN l.l_linenumber = 1 THEN 'price' WHEN l.l_linenumber = 2 THEN 'net_import' ELSE 'generation' END AS metric,
  CASE WHEN l.l_linenumber <= 2 THEN 'all' WHEN l.l_returnflag = 'R' THEN 'renewable' WHEN l.l_returnflag = 'A' THEN 'fossil' ELSE 'nuclear' END AS energy_source,
  CASE WHEN l.l_linenumber = 1 THEN l.l_extendedprice / l.l_quantity ELSE l.l_quantity END AS value,
  CASE WHEN l.l_linenumber = 1 THEN 'EUR/MWh' ELSE 'MWh' END AS unit,
  'ok' AS quality_flag, 'entsoe' AS source_system
FROM {lineitem} l JOIN geo g ON l.l_suppkey % 30 = g.idx""", ["lineitem"]),
    "gen_wide": ("""
SELECT CAST(e.ts AS TIMESTAMP) AS ts, g.iso2 AS country,
  CASE WHEN e.event_type = 'click' THEN e.value END AS wind_onshore,
  CASE WHEN e.event_type = 'view' THEN e.value END AS fossil_gas,
  CASE WHEN e.event_type = 'purchase' THEN e.value END AS nuclear,
  CASE WHEN e.event_type = 'signup' THEN e.value END AS hydro_pumped_storage,
  CASE WHEN e.event_type = 'error' THEN e.value END AS waste
FROM {events} e JOIN geo g ON e.user_id % 30 = g.idx""", ["events"]),
    "monthly_raw": ("""
SELECT CASE WHEN o.o_orderkey % 97 = 0 THEN 'n/a' ELSE concat(substring(CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR(10)), 1, 7), '-01') END AS `Date`,
  g.name AS `Area`, v.variable AS ` Variable`, v.unit AS `Unit`,
  CASE WHEN o.o_orderkey % 89 = 0 THEN '-' ELSE CAST(CAST(round(o.o_totalprice * 100) AS BIGINT) AS VARCHAR(20)) END AS `Value`
FROM {orders} o JOIN geo g ON o.o_custkey % 30 = g.idx JOIN v ON o.o_orderkey % 8 = v.k""", ["orders"]),
    "daily_prices": ("""
SELECT CASE WHEN o.o_orderkey % 211 = 0 THEN NULL ELSE g.iso2 END AS country_iso2,
  CAST(o.o_orderdate AS TIMESTAMP) AS date, o.o_totalprice AS avg_price
FROM {orders} o JOIN geo g ON o.o_custkey % 27 = g.idx""", ["orders"]),
    "kpi_years": ("""
SELECT CAST(o.o_orderdate AS TIMESTAMP) AS period_start_utc, 'EU' AS region, g.name AS country,
  CASE WHEN o.o_orderkey % 11 = 0 THEN 90.0E0 WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE o.o_totalprice / 1000.0E0 END AS avg_price,
  CASE WHEN o.o_orderkey % 11 = 0 THEN 50.0E0 ELSE CAST(o.o_orderkey % 101 AS DOUBLE) END AS renewable_share_pct,
  CAST(NULL AS DOUBLE) AS price_volatility,
  CASE WHEN o.o_orderkey % 19 = 0 THEN 336000.0E0 ELSE o.o_totalprice END AS total_generation_mwh
FROM {orders} o JOIN geo g ON o.o_custkey % 27 = g.idx""", ["orders"]),
}

VARIABLES_CTE = ("v(k, variable, unit) AS (VALUES (0,'Total Generation','TWh'),(1,'Wind generation','TWh'),"
                 "(2,'Gas power generation','TWh'),(3,' Nuclear Generation ','TWh'),"
                 "(4,'Day-ahead electricity price','EUR/MWh'),(5,'Demand','TWh'),"
                 "(6,'CO2 intensity','gCO2/kWh'),(7,'Hydro, Bioenergy and Other Renewables','TWh'))")

WIDE_VARIABLES = ["Total Generation", "Wind generation", "Gas power generation", " Nuclear Generation ",
                  "Day-ahead electricity price", "Demand", "CO2 intensity",
                  "Hydro, Bioenergy and Other Renewables"]


def _ctes_for(name: str) -> list[str]:
    ctes = [geo_cte()]
    if name == "monthly_raw":
        ctes.append(VARIABLES_CTE)
    return ctes


def monthly_wide_body(src: str) -> str:
    cols = ",\n  ".join(
        f"sum(CASE WHEN ` Variable` = '{v}' THEN TRY_CAST(`Value` AS DOUBLE) END) AS `{v}`"
        for v in WIDE_VARIABLES)
    return f"SELECT `Date`, `Area`,\n  {cols}\nFROM {src} GROUP BY `Date`, `Area`"


_TABLES: dict[tuple[int, str], DataFrame] = {}


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of a driver table; the (lazy) scan is reused within a
    session so its file listing and footer read happen once."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def adapter(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Spark side of an adapter."""
    if name == "monthly_wide":
        raw = adapter(spark, sf_dir, "monthly_raw")
        return spark.sql(monthly_wide_body("{raw}"), raw=raw)
    body, tables = BODIES[name]
    text = "WITH " + ",\n".join(_ctes_for(name)) + "\n" + body
    return spark.sql(text, **{t: load_table(spark, sf_dir, t) for t in tables})


def duck_ctes(*names: str) -> list[str]:
    """DuckDB CTE definitions (``name AS (...)``) for the given adapters, in
    dependency order, reading the pre-registered views."""
    out = [geo_cte()]
    need = list(names)
    if "monthly_wide" in need and "monthly_raw" not in need:
        need.insert(need.index("monthly_wide"), "monthly_raw")
    if "monthly_raw" in need:
        out.append(VARIABLES_CTE)
    for n in need:
        if n == "monthly_wide":
            body = monthly_wide_body("monthly_raw")
        else:
            body, tables = BODIES[n]
            body = body.format(**{t: t for t in tables})
        out.append(f"{n} AS ({body.replace('`', chr(34))})")
    return out


BODIES["country_lists"] = ("""
SELECT e.event_id, concat(g.iso2, ', ', CASE WHEN e.event_id % 4 = 0 THEN 'de' ELSE 'DE' END, ' ,, ', g.name, ' ,') AS countries
FROM {events} e JOIN geo g ON e.user_id % 30 = g.idx""", ["events"])

# Readings in which a few countries deliver load only: silent for the fallback.
BODIES["readings_partial"] = (BODIES["readings"][0].replace(
    "    ELSE 'generation' END AS metric",
    "    ELSE 'generation' END AS metric0, g.idx AS idx").replace("\nSELECT ", "\nSELECT ts_utc, period, region, country, "
    "CASE WHEN idx % 9 = 4 THEN 'load' ELSE metric0 END AS metric, energy_source, value, unit, quality_flag, source_system "
    "FROM (SELECT ", 1) + ") p", ["events"])

# Text with everything a CSV file can trip over: quotes, backslashes, line breaks, NULL, empty.
BODIES["text_rows"] = ("""
SELECT CAST(d.doc_id AS VARCHAR(20)) AS doc_id,
  CASE WHEN d.doc_id % 7 = 3 THEN NULL WHEN d.doc_id % 7 = 5 THEN '' ELSE d.text END AS text,
  concat('"', d.lang, '", ', chr(92), d.source, chr(10)) AS label
FROM {documents} d""", ["documents"])

# Pages with CSV links: site-relative, absolute, or none.
BODIES["linked_pages"] = ("""
SELECT p.page_id, p.url, CASE p.page_id % 4
    WHEN 0 THEN concat(p.html, '<a href="/files/', CAST(p.page_id AS VARCHAR(20)), '.csv">data</a>')
    WHEN 1 THEN concat('<a HREF="https://data.example/', CAST(p.page_id AS VARCHAR(20)), '.CSV">data</a>', p.html)
    WHEN 2 THEN concat(p.html, '<a href="/a.txt">a</a><a href="/b.csv">b</a><a href="/c.csv">c</a>')
    ELSE p.html END AS html
FROM {pages} p""", ["pages"])
