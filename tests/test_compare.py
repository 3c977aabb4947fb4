import datetime as dt

from gridmetrics import operators as ops


def test_yearly_rounding_half_even_and_nulls(spark):
    daily = spark.createDataFrame([
        ("DE", "2020-01-01", 0.125), ("DE", "2020-06-01", 0.125),
        (None, "2020-01-01", 5.0), ("DE", "garbage", 7.0),
    ], "country_iso2 string, date string, avg_price double")
    y = ops.yearly_kpis(daily).collect()
    assert len(y) == 1 and y[0]["avg_price"] == 0.12 and y[0]["price_volatility"] == 0.0 and y[0]["year"] == 2020


def test_year_compare_deltas(spark):
    yearly = spark.createDataFrame([("AT", 2015, 0.0), ("AT", 2024, 10.0), ("BE", 2015, -4.0), ("BE", 2024, 2.0),
                                    (None, 2015, 1.0), (None, 2024, 3.0), ("CZ", 2024, 9.0)],
                                   "country_iso2 string, year long, avg_price double")
    c = {r["country_iso2"]: r for r in ops.year_compare(yearly, "avg_price", 2015, 2024).collect()}
    assert set(c) == {"AT", "BE", None}
    assert c["AT"]["delta_pct"] is None and c["AT"]["delta_abs"] == 10.0
    assert c["BE"]["delta_pct"] == -150.0
    assert c[None]["delta_abs"] == 2.0


def test_year_comparison_wide_and_placeholders(spark):
    rows = [
        (dt.datetime(2015, 1, 2), "EU", "Austria", 50.0, 20.0, None, 100.0),
        (dt.datetime(2015, 1, 3), "EU", "Austria", 90.0, 50.0, None, 100.0),     # placeholder
        (dt.datetime(2024, 1, 2), "EU", "Austria", 70.0, 30.0, None, 336000.0),  # placeholder
        (dt.datetime(2024, 1, 3), "EU", "Austria", 60.0, 40.0, None, None),
        (dt.datetime(2024, 1, 9), "EU", "Austria", 1.0, 1.0, None, 1.0),         # outside window
        (dt.datetime(2024, 1, 2), "EU", "Belgium", 10.0, 5.0, None, 7.0),
    ]
    kpi = spark.createDataFrame(rows, "period_start_utc timestamp, region string, country string, avg_price double, "
                                      "renewable_share_pct double, price_volatility double, total_generation_mwh double")
    cmp = {r["country"]: r for r in ops.year_comparison(kpi, (2015, 2024), 7).collect()}
    a = cmp["Austria"]
    assert (a["avg_price_2015"], a["avg_price_2024"], a["avg_price_delta"]) == (50.0, 60.0, 10.0)
    assert a["total_generation_mwh_2024"] == 0.0 and a["total_generation_mwh_delta"] == -100.0
    b = cmp["Belgium"]
    assert b["avg_price_2015"] is None and b["renewable_share_pct_delta"] is None
    ordered = [r["country"] for r in ops.order_by_delta(ops.year_comparison(kpi, (2015, 2024), 7)).collect()]
    assert ordered == ["Austria", "Belgium"]


def test_yoy_change(spark):
    yearly = spark.createDataFrame([("DE", 2024, 78.4), ("DE", 2025, 84.2), ("DE", 2023, 71.2)],
                                   "country_iso2 string, year long, avg_price double")
    r = {x["year"]: x for x in ops.yoy_change(yearly).collect()}
    assert r[2023]["change_pct"] is None and r[2024]["change_pct"] == 10.11 and r[2025]["change_pct"] == 7.4
