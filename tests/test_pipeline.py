import os

from gridmetrics import operators as ops
from gridmetrics import sources as src
from gridmetrics.functions import resolve_level
from gridmetrics.plans.pipeline import eu_pipeline, run_eu
from gridmetrics.session import scratch_path

import pytest


def test_eu_run_one_day_baseline(spark):
    # the reference pipeline test: DE, one day, day level, baseline input
    raw = src.baseline_hourly(src.bounds_frame(spark, ["DE"], "2026-01-01", "2026-01-02"))
    k = eu_pipeline(raw, "day").kpi.collect()
    assert len(k) == 1
    r = k[0]
    assert r["country"] == "Germany"
    assert (r["renewable_mwh"], r["fossil_mwh"], r["nuclear_mwh"], r["total_generation_mwh"]) == \
        (24000.0, 19200.0, 4800.0, 48000.0)
    assert (r["renewable_share_pct"], r["fossil_share_pct"], r["nuclear_share_pct"]) == (50.0, 40.0, 10.0)
    assert r["avg_price"] == 90.0 and r["dq_coverage_pct"] == 100.0 and r["dq_issue_count"] == 0


def test_run_eu_writes_reports(spark):
    raw = src.baseline_hourly(src.bounds_frame(spark, ["DE", "AT"], "2026-01-01", "2026-01-02"))
    req = spark.createDataFrame([("DE",), ("AT",), ("FR",)], "country string")
    out = run_eu(spark, raw.limit(0), scratch_path(spark, "run"), "day", requested=req,
                 start="2026-01-01", end="2026-01-02", params={"countries": ["DE", "AT", "FR"]})
    assert set(out) == {"raw_cache", "raw_source", "raw_kind", "kpi_history_csv", "kpi_latest_json",
                        "dq_latest_json"}
    assert out["raw_kind"] == "eu_stub" and out["raw_source"] == "entsoe_stub"
    assert "/entsoe_stub/eu_stub/" in out["raw_cache"]
    hist = src.read_kpi_history(spark, out["kpi_history_csv"])
    assert sorted(r["country"] for r in hist.collect()) == ["Austria", "France", "Germany"]
    assert os.path.isdir(out["kpi_latest_json"])


def test_run_labels_and_threshold(spark):
    raw = src.baseline_hourly(src.bounds_frame(spark, ["DE"], "2026-01-01", "2026-01-02"))
    half = raw.where("hour(ts_utc) < 12")
    live = run_eu(spark, half, scratch_path(spark, "run"), "day")
    assert (live["raw_kind"], live["raw_source"]) == ("eu_live", "entsoe")
    assert run_eu(spark, half.limit(0), scratch_path(spark, "run"), "day")["raw_kind"] == "eu_stub"
    lax = run_eu(spark, half, scratch_path(spark, "run"), "day", min_coverage_pct=40.0)
    issues = lambda out: src.read_kpi_history(spark, out["kpi_history_csv"]).first()["dq_issue_count"]
    assert issues(live) == 4 and issues(lax) == 0


def test_global_rules_are_arguments(spark):
    from gridmetrics.plans.pipeline import global_pipeline
    monthly = spark.createDataFrame([("15.01.2024", "Germany", "Tidal output", "TWh", "10")],
                                    "Date string, Area string, Variable string, Unit string, Value string")
    assert global_pipeline(monthly).kpi.count() == 0
    kpi = global_pipeline(monthly, metric_rules=[("generation", ["output"])], source_rules=[("renewable", ["tidal"])],
                          date_formats=["dd.MM.yyyy"]).kpi.first()
    assert kpi["renewable_mwh"] == 10.0


def test_cli_open_ended_range(spark):
    from gridmetrics.cli import main
    path = scratch_path(spark, "landed")
    src.baseline_hourly(src.bounds_frame(spark, ["DE"], "2024-01-01", "2024-01-05")).write.parquet(path)
    days = lambda *a: sorted(r["period_start_utc"].day for r in src.read_kpi_history(
        spark, main(["run", "--input", path, "--out", scratch_path(spark, "cli"), *a])["kpi_history_csv"]).collect())
    assert days("--start", "2024-01-03") == [3, 4] and days("--end", "2024-01-03") == [1, 2]


def test_level_resolution():
    assert resolve_level("eu") == "day" and resolve_level("global") == "month"
    assert resolve_level("eu", " Week ") == "week"
    with pytest.raises(ValueError):
        resolve_level("eu", "quarter")


def test_required_columns(spark):
    with pytest.raises(ValueError):
        ops.yearly_kpis(spark.createDataFrame([("DE",)], "country_iso2 string"))


def test_run_global(spark):
    from gridmetrics.plans.pipeline import run_pipeline
    monthly = spark.createDataFrame([
        ("2024-01-01", "Germany", "Wind generation", "TWh", "10"),
        ("2024-01-01", "Norway", "Wind generation", "TWh", "10"),
        ("2024-03-01", "Germany", "Day-ahead electricity price", "EUR/MWh", "80.5"),
    ], "Date string, Area string, Variable string, Unit string, Value string")
    out = run_pipeline(spark, "global", monthly, scratch_path(spark, "grun"))
    hist = {(r["period_start_utc"].month, r["country"]): r for r in src.read_kpi_history(spark, out["kpi_history_csv"]).collect()}
    # gap filling is per series: the generation and price series have one bucket each
    assert set(hist) == {(1, "Germany"), (3, "Germany")}
    assert hist[(1, "Germany")]["renewable_mwh"] == 10.0 and hist[(3, "Germany")]["avg_price"] == 80.5
    assert hist[(1, "Germany")]["avg_price"] is None and hist[(1, "Germany")]["period"] == "month"
    assert hist[(1, "Germany")]["dq_issue_count"] == 1      # one monthly point vs 744 expected


def test_cli_stub_run_and_compare(spark):
    from gridmetrics.cli import main
    out = scratch_path(spark, "cli")
    res = main(["run", "--mode", "eu", "--countries", "DE,FR", "--start", "2024-01-01", "--end", "2024-01-03",
                "--agg", "day", "--out", out])
    assert res["raw_kind"] == "eu_stub"
    hist = src.read_kpi_history(spark, res["kpi_history_csv"])
    assert hist.count() == 4 and {r["avg_price"] for r in hist.collect()} == {90.0}
    cmp = main(["compare", "--history", res["kpi_history_csv"], "--years", "2023,2024", "--out", out + "/cmp"])
    back = src.read_csv(spark, cmp["year_comparison_csv"])
    # the baseline rows are placeholders (price 90, share 50), so nothing is left to compare
    assert back.count() == 0
