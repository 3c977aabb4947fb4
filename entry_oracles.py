"""DuckDB twins of the registered queries (the correctness oracle).

Written independently of the Spark code path, in the *reference* form where
the two differ: the KPI is the union of three aggregates joined back
(Spark: one conditional aggregate), gap filling uses per-series
``generate_series`` (Spark: ``lead`` + ``sequence``), and so on. Doubles are
normalised to 10 significant digits on both sides before comparison.
"""

from __future__ import annotations

from gridmetrics.plans.adapters import duck_ctes

SERIES = "region, country, metric, energy_source, unit, source_system"
EU_SCOPE_JOIN = "JOIN geo g ON g.idx < 27 AND (trim(r.country) = g.iso2 OR trim(r.country) = g.name)"

BUCKET = {
    "hour": "date_trunc('hour', ts_utc)",
    "day": "date_trunc('day', ts_utc)",
    "week": "date_trunc('week', ts_utc - INTERVAL 1 DAY) + INTERVAL 7 DAY",
    "month": "date_trunc('month', ts_utc)",
}
STEP = {"hour": "INTERVAL 1 HOUR", "day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAY",
        "month": "INTERVAL 1 MONTH"}
EXPECTED = {"hour": "1", "day": "24", "week": "168",
            "month": "datediff('day', ts_utc, ts_utc + INTERVAL 1 MONTH) * 24"}


def with_(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def scope_cte(name: str, src: str) -> str:
    return (f"{name} AS (SELECT r.ts_utc, r.period, 'EU' AS region, g.name AS country, r.metric, "
            f"r.energy_source, r.value, r.unit, r.quality_flag, r.source_system FROM {src} r "
            f"{EU_SCOPE_JOIN} WHERE r.ts_utc IS NOT NULL)")


def bucket_ctes(src: str, level: str, thr: float = 98.0, prefix: str = "") -> list[str]:
    """``{prefix}agg`` (bucket rows), ``{prefix}filled`` (gap rows in),
    ``{prefix}cov`` (coverage + flags)."""
    p = prefix
    return [
        f"""{p}agg AS (SELECT {SERIES}, {BUCKET[level]} AS ts_utc,
  CASE WHEN metric = 'price' THEN avg(value) ELSE coalesce(sum(value), 0.0) END AS value,
  count(value) AS actual_points
  FROM {src}
  WHERE metric IN ('generation','load','net_import','price') AND ts_utc IS NOT NULL
    AND region IS NOT NULL AND country IS NOT NULL AND metric IS NOT NULL
    AND energy_source IS NOT NULL AND unit IS NOT NULL AND source_system IS NOT NULL
  GROUP BY {SERIES}, {BUCKET[level]})""",
        f"""{p}span AS (SELECT {SERIES}, min(ts_utc) AS lo, max(ts_utc) AS hi FROM {p}agg GROUP BY {SERIES})""",
        f"""{p}grid AS (SELECT {SERIES}, unnest(generate_series(lo, hi, {STEP[level]})) AS ts_utc FROM {p}span)""",
        f"""{p}filled AS (SELECT g.region, g.country, g.metric, g.energy_source, g.unit, g.source_system, g.ts_utc,
  CASE WHEN a.ts_utc IS NOT NULL THEN a.value WHEN g.metric = 'price' THEN NULL ELSE 0.0 END AS value,
  coalesce(a.actual_points, 0) AS actual_points
  FROM {p}grid g LEFT JOIN {p}agg a ON a.region = g.region AND a.country = g.country AND a.metric = g.metric
   AND a.energy_source = g.energy_source AND a.unit = g.unit AND a.source_system = g.source_system
   AND a.ts_utc = g.ts_utc)""",
        f"""{p}cov AS (SELECT *, CASE WHEN coverage_pct < {thr} THEN 'missing_interval' ELSE 'ok' END AS quality_flag
  FROM (SELECT *, (actual_points / expected_points) * 100.0 AS coverage_pct
        FROM (SELECT *, '{level}' AS period, CAST({EXPECTED[level]} AS BIGINT) AS expected_points FROM {p}filled)))""",
    ]


def dq_cte(cov: str, name: str = "dq") -> str:
    return (f"{name} AS (SELECT ts_utc, region, country, period, min(coverage_pct) AS coverage_pct, "
            f"CAST(count(*) FILTER (WHERE quality_flag <> 'ok') AS BIGINT) AS issue_count "
            f"FROM {cov} GROUP BY ts_utc, region, country, period)")


def kpi_ctes(bucketed: str, level: str, dq: str | None = None, name: str = "kpi") -> list[str]:
    """Reference form: three aggregates, union of keys, left joins."""
    k = "ts_utc, region, country"
    dq_part = []
    dq_cols = "CAST(NULL AS DOUBLE) AS dq_coverage_pct, CAST(NULL AS BIGINT) AS dq_issue_count"
    dq_join = ""
    if dq:
        dq_part = [f"{name}_dq AS (SELECT ts_utc, region, country, period, min(coverage_pct) AS c, "
                   f"CAST(sum(issue_count) AS BIGINT) AS i FROM {dq} WHERE period = '{level}' "
                   f"GROUP BY ts_utc, region, country, period)"]
        dq_cols = "d.c AS dq_coverage_pct, d.i AS dq_issue_count"
        dq_join = (f" LEFT JOIN {name}_dq d ON d.ts_utc = k.ts_utc AND d.region = k.region "
                   f"AND d.country = k.country AND d.period = '{level}'")
    return [
        f"""{name}_gen AS (SELECT {k},
  coalesce(sum(CASE WHEN energy_source = 'renewable' THEN value END), 0.0) AS renewable_mwh,
  coalesce(sum(CASE WHEN energy_source = 'fossil' THEN value END), 0.0) AS fossil_mwh,
  coalesce(sum(CASE WHEN energy_source = 'nuclear' THEN value END), 0.0) AS nuclear_mwh
  FROM {bucketed} WHERE metric = 'generation' AND energy_source IN ('renewable','fossil','nuclear') GROUP BY {k})""",
        f"""{name}_pr AS (SELECT {k}, avg(value) AS avg_price, stddev_samp(value) AS price_volatility,
  first(unit ORDER BY energy_source, unit, source_system) AS price_unit
  FROM {bucketed} WHERE metric = 'price' GROUP BY {k})""",
        f"""{name}_ni AS (SELECT {k}, sum(value) AS net_import_mwh FROM {bucketed} WHERE metric = 'net_import' GROUP BY {k})""",
        f"""{name}_keys AS (SELECT {k} FROM {name}_gen UNION SELECT {k} FROM {name}_pr UNION SELECT {k} FROM {name}_ni)""",
        *dq_part,
        f"""{name} AS (SELECT k.ts_utc AS period_start_utc, k.region, k.country,
  coalesce(gn.fossil_mwh, 0.0) AS fossil_mwh, coalesce(gn.renewable_mwh, 0.0) AS renewable_mwh,
  coalesce(gn.nuclear_mwh, 0.0) AS nuclear_mwh,
  coalesce(gn.renewable_mwh + gn.fossil_mwh + gn.nuclear_mwh, 0.0) AS total_generation_mwh,
  gn.renewable_mwh / nullif(gn.renewable_mwh + gn.fossil_mwh + gn.nuclear_mwh, 0.0) * 100.0 AS renewable_share_pct,
  gn.fossil_mwh / nullif(gn.renewable_mwh + gn.fossil_mwh + gn.nuclear_mwh, 0.0) * 100.0 AS fossil_share_pct,
  gn.nuclear_mwh / nullif(gn.renewable_mwh + gn.fossil_mwh + gn.nuclear_mwh, 0.0) * 100.0 AS nuclear_share_pct,
  p.avg_price, p.price_volatility, p.price_unit, coalesce(n.net_import_mwh, 0.0) AS net_import_mwh,
  '{level}' AS period, {dq_cols}
  FROM {name}_keys k
  LEFT JOIN {name}_gen gn ON gn.ts_utc = k.ts_utc AND gn.region = k.region AND gn.country = k.country
  LEFT JOIN {name}_pr p ON p.ts_utc = k.ts_utc AND p.region = k.region AND p.country = k.country
  LEFT JOIN {name}_ni n ON n.ts_utc = k.ts_utc AND n.region = k.region AND n.country = k.country{dq_join})""",
    ]


def bucketed_select(cov: str) -> str:
    return (f"SELECT ts_utc, period, region, country, metric, energy_source, value, unit, "
            f"quality_flag, source_system FROM {cov}")


def eu_chain(src_adapter: str, level: str, thr: float = 98.0, with_dq: bool = True) -> list[str]:
    """adapter -> scope -> buckets -> dq -> kpi (reference form)."""
    ctes = duck_ctes(src_adapter)
    ctes.append(scope_cte("scoped", src_adapter))
    ctes += bucket_ctes("scoped", level, thr)
    ctes.append(f"bucketed AS ({bucketed_select('cov')})")
    ctes.append(dq_cte("cov"))
    ctes += kpi_ctes("bucketed", level, "dq" if with_dq else None)
    return ctes


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rule_case(expr: str, rules, default: str) -> str:
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains({expr}, {_q(w.lower())})" for w in words) + f" THEN '{b}'"
        for b, words in rules)
    return f"CASE {whens} ELSE '{default}' END"


def fuel_case(expr: str) -> str:
    from gridmetrics.schema import FUEL_RULES
    whens = " ".join(f"WHEN regexp_matches(lower({expr}), {_q(p)}) THEN '{b}'" for b, p in reversed(FUEL_RULES))
    return f"CASE {whens} ELSE 'all' END"


def monthly_long_cte(name: str, src: str, time_col: str, geo_col: str, var_expr: str, value_col: str,
                     unit_expr: str) -> str:
    from gridmetrics.schema import METRIC_RULES, SOURCE_RULES
    v = f"lower(trim({var_expr}))"
    return f"""{name} AS (SELECT * FROM (SELECT TRY_CAST({time_col} AS TIMESTAMP) AS ts_utc, 'month' AS period,
  'GLOBAL' AS region, CAST({geo_col} AS VARCHAR) AS country, {rule_case(v, METRIC_RULES, 'other')} AS metric,
  {rule_case(v, SOURCE_RULES, 'all')} AS energy_source, TRY_CAST({value_col} AS DOUBLE) AS value,
  {unit_expr} AS unit, 'ok' AS quality_flag, 'ember' AS source_system FROM {src})
  WHERE ts_utc IS NOT NULL AND value IS NOT NULL AND metric IN ('generation', 'price'))"""


def profile_cte(name: str, profile) -> str:
    vals = ", ".join(f"({_q(m)}, {_q(s)}, CAST({float(v)!r} AS DOUBLE), {_q(u)}, {_q(q)})"
                     for m, s, v, u, q in profile)
    return f"{name}(metric, energy_source, value, unit, quality_flag) AS (VALUES {vals})"


def baseline_select(grid: str, prof: str, period: str, region: str, country: str, system: str) -> str:
    return (f"SELECT g.ts_utc, '{period}' AS period, {region} AS region, {country} AS country, p.metric, "
            f"p.energy_source, p.value, p.unit, p.quality_flag, '{system}' AS source_system "
            f"FROM {grid} g CROSS JOIN {prof} p")
