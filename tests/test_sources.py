import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from gridmetrics import operators as ops
from gridmetrics import sources as src
from gridmetrics.functions import extract_link
from gridmetrics.session import scratch_path


def test_wide_generation_to_long(spark):
    df = spark.createDataFrame([
        (dt.datetime(2024, 1, 1, 0, 15), "DE", 1.0, 2.0, None, 4.0),
        (dt.datetime(2024, 1, 1, 0, 45), "DE", 1.5, None, None, None),
        (dt.datetime(2024, 1, 1, 2, 0), "DE", None, None, 3.0, None),
    ], "ts timestamp, country string, `Fossil Gas` double, `Wind Onshore` double, Nuclear double, `Gas Wind mix` double")
    rows = {(r["ts_utc"].hour, r["energy_source"], r["value"]) for r in src.generation_wide_to_long(df).collect()}
    # hour 0: gas 2.5, wind 2.0, mix -> fossil (the later rule wins); hour 2: nuclear
    assert rows == {(0, "fossil", 2.5), (0, "renewable", 2.0), (0, "fossil", 4.0), (2, "nuclear", 3.0)}


def test_monthly_rules_and_parsing(spark):
    df = spark.createDataFrame([
        ("2024-01-01", "Germany", "Hydro, Bioenergy and Other Renewables", "TWh", "1"),
        ("2024-01-01", "Germany", " Nuclear Generation ", "TWh", "2"),
        ("2024-01-01", "Germany", "Day-ahead electricity price", "EUR/MWh", "3.5"),
        ("n/a", "Germany", "Wind generation", "TWh", "4"),
        ("2024-02-01", "Germany", "Gas power generation", "TWh", "-"),
    ], "` Date ` string, AREA string, Variable string, Unit string, Value string")
    out = sorted((r["metric"], r["energy_source"], r["value"]) for r in src.monthly_to_long(df).collect())
    assert out == [("generation", "nuclear", 2.0), ("price", "all", 3.5)]


def test_csv_link_extraction(spark):
    df = spark.createDataFrame([
        (1, "https://site.example/data/page", '<a HREF="/files/monthly.CSV">x</a><a href="/b.csv">'),
        (2, "https://site.example/p", '<a href="https://cdn.example/x.csv">'),
        (3, "https://site.example/p", '<a href="/x.txt">'),
    ], "page_id long, url string, html string")
    got = {r["page_id"]: r["data_url"] for r in src.page_data_links(df).collect()}
    assert got == {1: "https://site.example/files/monthly.CSV", 2: "https://cdn.example/x.csv"}
    assert df.select(extract_link("html")).collect()[2][0] is None


def test_calendar_grid_whole_range_and_month_start(spark):
    b = spark.createDataFrame([("2024-01-15 00:00:00", "2026-06-01 00:00:00")], "start string, end string") \
        .select(F.to_timestamp("start").alias("start"), F.to_timestamp("end").alias("end"))
    months = [r["ts_utc"] for r in src.baseline_monthly(b).where("metric = 'nuclear' OR energy_source = 'nuclear'").collect()]
    assert len(months) == 28 and min(months) == dt.datetime(2024, 2, 1)  # nothing is cut unless asked for
    assert src.baseline_monthly(b, cap=24).count() == 24 * 3
    days = src.baseline_daily(b)
    assert days.count() == (dt.datetime(2026, 6, 1) - dt.datetime(2024, 1, 15)).days * 4
    assert src.baseline_daily(b, cap=60).count() == 60 * 4
    one = spark.createDataFrame([("DE", "2024-01-01 00:00:00", "2024-02-01 00:00:00")], "country string, start string, end string")
    assert src.baseline_hourly(one, cap=48).count() == 48 * 4
    hours = src.calendar_grid(b, "hour", cap=None, chunk_steps=1000)
    assert hours.count() == (dt.datetime(2026, 6, 1) - dt.datetime(2024, 1, 15)).days * 24
    empty = spark.createDataFrame([(dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1))], "start timestamp, end timestamp")
    assert src.calendar_grid(empty, "day").count() == 0


def test_fallback_fill_and_kind(spark):
    from conftest import readings_rows
    obs = readings_rows(spark, [("2026-01-01T03:00:00Z", "Germany", "generation", "fossil", 1.0, "MWh"),
                                ("2026-01-01T03:00:00Z", "France", "load", "all", 1.0, "MWh")])
    req = spark.createDataFrame([("Germany",), ("France",)], "country string")
    out = src.fallback_fill(obs, req, "2026-01-01", "2026-01-02")
    kinds = {(r["country"], r["source_kind"]) for r in out.collect()}
    assert kinds == {("Germany", "live"), ("France", "live"), ("France", "stub")}
    assert out.where("source_kind = 'stub'").count() == 24 * 4
    assert src.run_kind(out).first()[0] == "eu_live_with_stub"


def test_cache_entries_and_latest(spark):
    assert src.params_digest({"b": 1, "a": [1, 2]}) == src.params_digest({"a": (1, 2), "b": 1})
    assert src.params_digest({"a": 1}) != src.params_digest({"a": "1"})
    root = scratch_path(spark, "cache-test")
    first, later = src.raw_path(root, "z", "k", {"x": 1}), src.raw_path(root, "a", "k", {"x": 2})
    src.write_raw(spark.range(3), first)
    rows = spark.range(2000).select(
        (F.col("id") % 5).cast("string").alias("country"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600).alias("ts_utc"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else tiny tasks are joined
    src.write_raw(rows, later, partition_by_month=True)  # later, at the smaller path
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert src.latest_cached_path(spark, root).endswith(later)
    back = src.read_latest_cached(spark, root)
    assert back.count() == 2000 and back.columns == ["country", "ts_utc"]
    month = os.path.join(later, "ts_month=2024-01")
    assert sum(f.endswith(".parquet") for f in os.listdir(month)) > 1  # one month, several tasks
    os.remove(os.path.join(later, "_SUCCESS"))  # an unfinished entry does not count
    assert src.latest_cached_path(spark, root).endswith(first)


def test_cache_key_is_that_of_sorted_json(spark):
    """Fixed by the SHA-256 of the text {"agg": "day", "countries": ["DE", "Österreich"], "end": null, "mode": "eu"}."""
    import hashlib
    params = {"mode": "eu", "countries": ["DE", "Österreich"], "end": None, "agg": "day"}
    text = '{"agg": "day", "countries": ["DE", "Österreich"], "end": null, "mode": "eu"}'
    want = hashlib.sha256(text.encode()).hexdigest()[:16]
    assert src.params_digest(params) == want
    assert src.raw_path("/r/", "entsoe", "eu_live", params) == f"/r/entsoe/eu_live/{want}.parquet"


def test_key_columns_equal_the_driver(spark):
    from gridmetrics.functions.canonical import canonical_json, json_key, json_key_column, json_text
    odd = ["", "plain", 'q"uote', "back\\slash", "".join(map(chr, range(40))), "\x7f\x85", "日本 é", "/", None]
    rows = [(t, [t, "b"], i, i % 2 == 0, {"z": t, "a": "x", 'k"': None}, (t, None)) for i, t in enumerate(odd)] + [(None,) * 6]
    df = spark.createDataFrame(rows, "s string, l array<string>, n long, b boolean, m map<string,string>, t struct<y:string,x:int>")
    p = F.struct(*df.columns)
    kind = df.select(p.alias("p")).schema["p"].dataType
    out = df.select(F.struct("*").alias("row"), canonical_json(p, kind).alias("text"), json_key_column(p, kind).alias("key")).collect()
    for r in out:
        params = r["row"].asDict(recursive=True)
        assert r["text"] == json_text(params) and r["key"] == json_key(params)
    with pytest.raises(TypeError, match="double"):
        canonical_json(F.lit(1.0), spark.range(1).select(F.lit(1.0).alias("x")).schema["x"].dataType)


def test_publication(spark, monkeypatch):
    from gridmetrics.sources import cache
    root = scratch_path(spark, "publish-test")
    path = src.raw_path(root, "a", "k", {"x": 1})
    def attempt(n):
        a = src.attempt_path(root)
        src.write_raw(spark.range(n), a)
        return a
    src.publish(spark, attempt(3), path)
    assert src.read_latest_cached(spark, root).count() == 3
    pending = attempt(5)  # a crash between write and commit leaves the old entry
    assert src.latest_cached_path(spark, root).endswith(path) and src.read_raw(spark, path).count() == 3
    real = cache.move_path
    def fail(s, a, b):
        if a == pending:
            raise OSError("lost")
        real(s, a, b)
    monkeypatch.setattr(cache, "move_path", fail)
    with pytest.raises(OSError):
        src.publish(spark, pending, path)  # a crash between the two renames
    monkeypatch.setattr(cache, "move_path", real)
    assert src.latest_cached_path(spark, root).endswith(path) and src.read_raw(spark, path).count() == 3
    src.publish(spark, pending, path)
    assert src.read_raw(spark, path).count() == 5
    assert not os.path.exists(path + cache.REPLACED) and not os.path.exists(pending)
    os.remove(os.path.join(half := attempt(1), "_SUCCESS"))
    with pytest.raises(FileNotFoundError):
        src.publish(spark, half, path)


def test_flatten_columns(spark):
    df = spark.createDataFrame([(1, (2.0, 3.0))], "id long, `Wind` struct<`Actual Aggregated`: double, ` `: double>")
    assert src.flatten_columns(df).columns == ["id", "Wind_Actual Aggregated", "Wind"]
    dotted = spark.createDataFrame([(1, (2.0,))], "`a.b` long, `c.d` struct<`e.f`: double>")
    assert src.flatten_columns(dotted).columns == ["a.b", "c.d_e.f"]
    assert tuple(src.flatten_columns(dotted).first()) == (1, 2.0)
    clash = spark.createDataFrame([(1, (2,))], "a_b long, a struct<b: long>")
    with pytest.raises(ValueError, match="a_b"):
        src.flatten_columns(clash)


def test_csv_keeps_odd_text(spark):
    rows = [("1", "two\nlines", 'say "x"'), ("2", None, ""), ("3", "", "a,b"), ("4", " pad ", "back\\slash"), ("5", "\r\n", "\t")]
    path = scratch_path(spark, "csv-odd")
    src.write_csv(spark.createDataFrame(rows, "a string, b string, c string"), path)
    assert sorted(tuple(r) for r in src.read_csv(spark, path).collect()) == rows


def test_other_date_formats_and_dropped_rows(spark):
    df = spark.createDataFrame([("2024-01-01", "Germany", "Wind generation", "1"), ("01/02/2024", "Germany", "Wind generation", "2"),
                                ("?", "Germany", "Wind generation", "3"), ("2024-03-01", "Germany", "Demand", "4"),
                                ("2024-03-01", "Germany", "Spot price", "-")],
                               "date string, country string, variable string, value string")
    assert src.monthly_to_long(df).count() == 1
    out = src.monthly_to_long(df, date_formats=["dd/MM/yyyy"])
    assert sorted(r["ts_utc"].month for r in out.collect()) == [1, 2]
    assert tuple(src.dropped_rows(df, date_formats=["dd/MM/yyyy"]).first()) == (5, 1, 1, 1, 2)


def test_repeated_queries_leave_no_more_folders(spark):
    import __spark_entry__ as E
    from gridmetrics.session import _SCRATCH, _drop_all_scratch, shared_dir
    base = shared_dir(spark)
    checkpoints = {d for d in os.listdir(base) if len(d) == 36}
    for _ in range(2):
        E.queries()["csv_roundtrip"](spark, "/root/testdata/sf0.001").count()
    assert {d for d in os.listdir(base) if len(d) == 36} == checkpoints  # one checkpoint folder a session
    made = [p for p in _SCRATCH if "csv_roundtrip" in p]
    assert made and all(os.path.isdir(p) for p in made)
    _drop_all_scratch()
    assert not any(os.path.exists(p) for p in made)


def test_history_and_documents(spark):
    from gridmetrics.plans.pipeline import eu_pipeline
    bounds = src.bounds_frame(spark, ["DE", "FR"], "2026-01-01", "2026-01-03")
    raw = src.baseline_hourly(bounds)
    res = eu_pipeline(raw, "day")
    path = scratch_path(spark, "hist")
    src.write_kpi_history(res.kpi, path)
    back = src.read_kpi_history(spark, path)
    assert back.count() == 4 and back.where("country = 'Germany'").count() == 2
    assert src.read_kpi_history(spark, path + "-missing").count() == 0
    doc_path = scratch_path(spark, "doc")
    src.write_json_document(src.kpi_latest_document(res.kpi, "day"), doc_path)
    files = [f for f in os.listdir(doc_path) if f.endswith(".json")]
    doc = json.loads(open(os.path.join(doc_path, files[0])).read().splitlines()[0])
    assert doc["period"] == "day" and doc["period_start_utc"] == "2026-01-02T00:00:00Z"
    assert len(doc["items"]) == 2 and doc["items"][0]["price_volatility"] is None
    back = src.read_json_document(spark, doc_path).first()
    assert back["period"] == "day" and len(back["items"]) == 2
    assert {i["country"] for i in back["items"]} == {"Germany", "France"}
    dq = src.dq_latest_document(res.dq, "day").first()
    assert dq["summary"]["countries_below_98pct"] == 0 and dq["summary"]["min_coverage_pct"] == 100.0


def test_odd_column_names(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 5), "DE", 1.0, 2.0)],
                               "ts timestamp, country string, `Solar.PV` double, `Hard coal ` double")
    rows = sorted((r["energy_source"], r["value"]) for r in src.generation_wide_to_long(df).collect())
    assert rows == [("fossil", 2.0), ("renewable", 1.0)]
    wide = spark.createDataFrame([("2024-01-01", "Germany", 3.0)], "`Month` string, `Country` string, `Wind.generation` double")
    out = src.monthly_to_long(wide).collect()
    assert [(r["metric"], r["energy_source"], r["value"], r["unit"]) for r in out] == [("generation", "renewable", 3.0, "unknown")]
