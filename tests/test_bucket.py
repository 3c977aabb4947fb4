import datetime as dt

from pyspark.sql import functions as F

from conftest import readings_rows
from gridmetrics import operators as ops
from gridmetrics.functions import bucket_start, expected_points


def rows_by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_day_bucket_means_and_names(spark):
    # three hourly prices: DE 00:00 = 50, DE 01:00 = 100, FR 00:00 = 150
    df = readings_rows(spark, [("2026-01-01T00:00:00Z", "DE", "price", "all", 50.0, "EUR/MWh"),
                               ("2026-01-01T01:00:00Z", "DE", "price", "all", 100.0, "EUR/MWh"),
                               ("2026-01-01T00:00:00Z", "FR", "price", "all", 150.0, "EUR/MWh")])
    bucketed, dq = ops.aggregate_timeseries(df, "day")
    b = rows_by(bucketed, "country")
    assert set(b) == {("Germany",), ("France",)}
    assert b[("Germany",)]["value"] == 75.0 and b[("France",)]["value"] == 150.0
    assert all(r["quality_flag"] == "missing_interval" for r in b.values())
    d = rows_by(dq, "country")
    assert abs(d[("Germany",)]["coverage_pct"] - 100 * 2 / 24) < 1e-9
    assert abs(d[("France",)]["coverage_pct"] - 100 / 24) < 1e-9
    assert d[("Germany",)]["issue_count"] == 1


def test_week_label_is_ending_monday(spark):
    df = spark.createDataFrame([("2024-01-02 00:00:00",), ("2024-01-08 23:00:00",), ("2024-01-08 00:00:00",),
                                ("2024-01-09 00:00:00",)], "t string").select(F.to_timestamp("t").alias("t"))
    got = [r[0] for r in df.select(bucket_start("t", "week")).collect()]
    assert got == [dt.datetime(2024, 1, 8)] * 3 + [dt.datetime(2024, 1, 15)]


def test_expected_points_leap_february(spark):
    df = spark.createDataFrame([("2024-02-01 00:00:00",), ("2023-02-01 00:00:00",), ("2024-01-01 00:00:00",)], "t string")
    got = [r[0] for r in df.select(expected_points(F.to_timestamp("t"), "month")).collect()]
    assert got == [29 * 24, 28 * 24, 31 * 24]


def test_interior_gaps_filled_no_edges(spark):
    df = readings_rows(spark, [
        ("2024-01-01T05:00:00Z", "DE", "generation", "renewable", 10.0, "MWh"),
        ("2024-01-04T05:00:00Z", "DE", "generation", "renewable", 20.0, "MWh"),
        ("2024-01-01T05:00:00Z", "DE", "price", "all", 40.0, "EUR/MWh"),
        ("2024-01-03T05:00:00Z", "DE", "price", "all", 60.0, "EUR/MWh"),
    ])
    cov = ops.bucket_coverage(df, "day")
    gen = sorted((r["ts_utc"].day, r["value"], r["actual_points"]) for r in
                 cov.where("metric = 'generation'").collect())
    assert gen == [(1, 10.0, 1), (2, 0.0, 0), (3, 0.0, 0), (4, 20.0, 1)]
    price = sorted((r["ts_utc"].day, r["value"]) for r in cov.where("metric = 'price'").collect())
    assert price == [(1, 40.0), (2, None), (3, 60.0)]


def test_null_rules_and_scope(spark):
    df = readings_rows(spark, [
        ("2024-01-01T00:00:00Z", " Germany ", "generation", "fossil", None, "MWh"),   # padded name, NULL value
        ("2024-01-01T01:00:00Z", "DE", "generation", "fossil", None, "MWh"),
        ("2024-01-01T00:00:00Z", "DE", "generation", "fossil", 5.0, None),            # NULL unit -> dropped
        ("2024-01-01T00:00:00Z", "GB", "generation", "fossil", 5.0, "MWh"),           # not a member
        ("2024-01-01T00:00:00Z", "DE", "other", "all", 5.0, "MWh"),                   # unknown metric
        ("not a time", "DE", "generation", "fossil", 5.0, "MWh"),
    ], raw_ts=True)
    cov = ops.bucket_coverage(df, "day")
    rows = cov.collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["country"], r["value"], r["actual_points"], r["region"]) == ("Germany", 0.0, 0, "EU")


def test_coverage_can_exceed_100(spark):
    rows = [(f"2024-01-01T{h:02d}:00:00Z", "DE", "generation", "renewable", 1.0, "MWh") for h in range(24)] * 2
    cov = ops.bucket_coverage(readings_rows(spark, rows), "day")
    assert cov.first()["coverage_pct"] == 200.0


def test_hour_and_month_levels(spark):
    df = readings_rows(spark, [("2024-02-10T03:30:00Z", "FR", "load", "all", 2.0, "MWh"),
                               ("2024-02-10T03:45:00Z", "FR", "load", "all", 3.0, "MWh")])
    h = ops.bucket_coverage(df, "hour").first()
    assert (h["value"], h["expected_points"], h["coverage_pct"]) == (5.0, 1, 200.0)
    m = ops.bucket_coverage(df, "month").first()
    assert m["ts_utc"] == dt.datetime(2024, 2, 1) and m["expected_points"] == 696


def test_long_gap_is_filled_in_bounded_chunks(spark):
    from gridmetrics.operators.bucket import GAP_CHUNK
    df = readings_rows(spark, [("2020-01-01T00:00:00Z", "DE", "load", "all", 1.0, "MWh"),
                               ("2021-03-01T00:00:00Z", "DE", "load", "all", 2.0, "MWh")])
    cov = ops.bucket_coverage(df, "hour")
    hours = int((dt.datetime(2021, 3, 1) - dt.datetime(2020, 1, 1)).total_seconds() // 3600)
    assert hours > GAP_CHUNK
    agg = cov.agg(F.count("*"), F.sum("value"), F.sum("actual_points"), F.countDistinct("ts_utc")).first()
    assert tuple(agg) == (hours + 1, 3.0, 2, hours + 1)


def test_long_gap_is_expanded_by_many_tasks(spark):
    """One stray timestamp centuries away: the same buckets, from several tasks."""
    from gridmetrics.operators.bucket import GAP_CHUNK, fill_interior_gaps
    rows = [("2024-01-01 00:00:00", "FR", 1.0), ("2024-01-04 00:00:00", "FR", 2.0), ("2024-01-01 00:00:00", "DE", 3.0),
            ("2084-01-01 00:00:00", "DE", 4.0)]
    df = spark.createDataFrame(rows, "t string, country string, value double").select(
        F.lit("EU").alias("region"), "country", F.lit("generation").alias("metric"), F.lit("fossil").alias("energy_source"),
        F.lit("MWh").alias("unit"), F.lit("entsoe").alias("source_system"), F.to_timestamp("t").alias("ts_utc"), "value",
        F.lit(1).cast("long").alias("actual_points"))
    out = fill_interior_gaps(df, "hour").withColumn("task", F.spark_partition_id())
    by_country = {r["country"]: r for r in out.groupBy("country").agg(
        F.count("*").alias("n"), F.count_distinct("ts_utc").alias("d"), F.count_distinct("task").alias("tasks"),
        F.sum("value").alias("v"), F.min("ts_utc").alias("lo"), F.max("ts_utc").alias("hi")).collect()}
    hours = (dt.datetime(2084, 1, 1) - dt.datetime(2024, 1, 1)).days * 24 + 1
    de, fr = by_country["DE"], by_country["FR"]
    assert hours > 100 * GAP_CHUNK and de["n"] == de["d"] == hours and de["tasks"] >= 4 and de["v"] == 7.0
    assert (de["lo"], de["hi"]) == (dt.datetime(2024, 1, 1), dt.datetime(2084, 1, 1))
    assert fr["n"] == 73 and fr["tasks"] <= 2
