import datetime as dt

from pyspark.sql import functions as F

from conftest import readings_rows
from gridmetrics import operators as ops
from gridmetrics.schema import KPI_COLS


def test_kpi_price_and_generation(spark):
    ts = "2026-01-01T00:00:00Z"
    bucketed = readings_rows(spark, [(ts, "Germany", "price", "all", 100.0, "EUR/MWh"),
                                     (ts, "Germany", "generation", "renewable", 500.0, "MWh")]) \
        .withColumn("period", F.lit("day"))
    dq = spark.createDataFrame([(dt.datetime(2026, 1, 1), "EU", "Germany", "day", 100.0, 0)],
                               "ts_utc timestamp, region string, country string, period string, coverage_pct double, issue_count long")
    k = ops.compute_kpis(bucketed, "day", dq=dq).collect()
    assert len(k) == 1
    r = k[0]
    assert r["avg_price"] == 100.0 and r["renewable_share_pct"] == 100.0
    assert r["price_volatility"] is None and r["net_import_mwh"] == 0.0
    assert r["dq_coverage_pct"] == 100.0 and r["dq_issue_count"] == 0
    assert list(ops.compute_kpis(bucketed, "day").columns) == KPI_COLS


def test_zero_total_load_only_and_first_unit(spark):
    ts = "2026-01-01T00:00:00Z"
    b = readings_rows(spark, [
        (ts, "Germany", "generation", "fossil", 0.0, "MWh"),
        (ts, "France", "load", "all", 7.0, "MWh"),                     # load-only key vanishes
        (ts, "Spain", "price", "all", 10.0, "USD/MWh", "zz"),
        (ts, "Spain", "price", "all", 20.0, "EUR/MWh", "aa"),
    ])
    k = {r["country"]: r for r in ops.compute_kpis(b, "day").collect()}
    assert set(k) == {"Germany", "Spain"}
    assert k["Germany"]["renewable_share_pct"] is None and k["Germany"]["total_generation_mwh"] == 0.0
    assert k["Spain"]["price_unit"] == "EUR/MWh"        # order: (source, unit, system)
    assert k["Spain"]["fossil_mwh"] == 0.0 and k["Spain"]["fossil_share_pct"] is None


def test_fused_equals_join_form(spark):
    rows = []
    for d in (1, 2, 4):
        for h in (0, 5):
            rows += [(f"2024-01-0{d}T{h:02d}:00:00Z", c, m, s, float(d * 10 + h), u)
                     for c in ("DE", "FR") for m, s, u in (("generation", "renewable", "MWh"),
                                                           ("generation", "nuclear", "MWh"),
                                                           ("price", "all", "EUR/MWh"),
                                                           ("net_import", "all", "MWh"),
                                                           ("load", "all", "MWh"))]
    cov = ops.bucket_coverage(readings_rows(spark, rows), "day")
    fused = ops.compute_kpis_with_quality(cov, "day")
    joined = ops.compute_kpis(ops.bucketed_view(cov), "day", dq=ops.dq_rollup(cov))
    assert sorted(fused.collect()) == sorted(joined.select(*fused.columns).collect())
    assert fused.count() == 2 * 4   # gap day 3 is filled for both countries


def test_fill_mwh_and_compare_years(spark):
    from gridmetrics.plans.pipeline import compare_years
    kpi = spark.createDataFrame([(None, 1.0, None)], "renewable_mwh double, fossil_mwh double, avg_price double")
    r = ops.fill_mwh(kpi).first()
    assert (r["renewable_mwh"], r["fossil_mwh"], r["avg_price"]) == (0.0, 1.0, None)
    hist = spark.createDataFrame([], "period_start_utc timestamp, region string, country string, avg_price double, "
                                     "renewable_share_pct double, price_volatility double, total_generation_mwh double")
    assert compare_years(hist, (2015, 2024)).count() == 0
