import datetime as dt

from pyspark.sql import functions as F

from gridmetrics import operators as ops


def _kpi(spark, rows):
    return spark.createDataFrame(rows, "period_start_utc timestamp, region string, country string, "
                                       "renewable_share_pct double, fossil_share_pct double, nuclear_share_pct double")


def test_latest_per_key_and_snapshot(spark):
    d1, d2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    k = _kpi(spark, [(d1, "EU", "Germany", 1.0, 2.0, 3.0), (d2, "EU", "Germany", 4.0, 5.0, 6.0),
                     (d1, "EU", "France", 7.0, 8.0, 9.0)])
    latest = {r["country"]: r for r in ops.latest_per_key(k, ["region", "country"], "period_start_utc").collect()}
    assert latest["Germany"]["renewable_share_pct"] == 4.0 and latest["France"]["period_start_utc"] == d1
    assert [r["country"] for r in ops.latest_snapshot(k).collect()] == ["Germany"]


def test_variation_guard(spark):
    d = [dt.datetime(2024, 1, i) for i in (1, 2, 3)]
    k = _kpi(spark, [(d[0], "EU", "A", 1.0, None, 5.0), (d[1], "EU", "A", 1.0, None, 5.0),
                     (d[0], "EU", "B", 1.0, 2.0, 5.0), (d[1], "EU", "B", 1.0, 3.0, 5.0),
                     (d[2], "EU", "C", 1.0, 2.0, 3.0)])
    g = {r["country"]: r["has_variation"] for r in ops.variation_guard(k).collect()}
    assert g == {"A": False, "B": True, "C": False}


def test_table_profile_sample_is_sorted_and_capped(spark):
    df = spark.range(120).selectExpr("cast(id % 60 as string) as s", "cast(null as string) as n")
    p = {r["column_name"]: r for r in ops.table_profile(df, sample_size=5).collect()}
    assert p["s"]["distinct_count"] == 60 and p["s"]["n_rows"] == 120
    assert p["s"]["sample_values"] == "0|1|10|11|12"
    assert p["n"]["distinct_count"] == 0 and p["n"]["sample_values"] is None


def test_drop_empty_and_bounds(spark):
    df = spark.createDataFrame([(None, 1.0, None), (None, None, None)], "a double, b double, c string")
    out = ops.drop_empty(df)
    assert out.columns == ["b"] and out.count() == 1
    empty = spark.createDataFrame([], "renewable_share_pct_delta double, avg_price_delta double")
    b = ops.delta_bounds(empty).first()
    assert tuple(b) == (-100.0, 100.0, -500.0, 500.0)


def test_alias_lists(spark):
    df = spark.createDataFrame([("de, FR ,,NL",), ("DE_LU",)], "c string")
    fwd = [r[0] for r in ops.alias_countries(df, "c", "o").select("o").collect()]
    assert fwd == ["DE_LU,FR,NL", "DE_LU"]
    back = [r[0] for r in ops.alias_countries(df, "c", "o", inverse=True).select("o").collect()]
    assert back == ["de,FR,NL", "DE"]


def test_head_rows_ordered(spark):
    df = spark.createDataFrame([(3, "c"), (1, None), (2, "b")], "k long, v string")
    assert [r["k"] for r in ops.head_rows(df, ["v", "k"], 2).collect()] == [2, 3]


def test_sketched_profile(spark):
    df = spark.range(60_000).select((F.col("id") % 7).cast("string").alias("few"), F.sha2(F.col("id").cast("string"), 256).alias("many"),
                                    F.lit(None).cast("string").alias("none"), F.when(F.col("id") == 5, "x").alias("odd name"))
    exact = {r["column_name"]: r for r in ops.table_profile(df, sample_size=5).collect()}
    out = {r["column_name"]: r for r in ops.table_profile(df.repartition(6), sample_size=5, sketched=True).collect()}
    assert set(out) == set(exact)
    for c, r in out.items():
        assert (r["n_rows"], r["sample_values"]) == (exact[c]["n_rows"], exact[c]["sample_values"])
        assert abs(r["distinct_count"] - exact[c]["distinct_count"]) <= 4 * 0.0082 * exact[c]["distinct_count"]
    assert [out[c]["distinct_count"] for c in ("few", "none", "odd name")] == [7, 0, 1]


def test_drop_empty_by_footers(spark, monkeypatch):
    from gridmetrics.operators import reports
    from gridmetrics.session import scratch_path
    df = spark.range(50).select("id", F.lit(None).cast("double").alias("a"), F.when(F.col("id") > 48, "x").alias("b b"),
                                F.lit(None).cast("string").alias("c"), F.when(F.col("id") < 0, F.current_timestamp()).alias("t"))
    path = scratch_path(spark, "footers")
    df.repartition(3).write.parquet(path)
    table = spark.read.parquet(path)
    def no_pass(_):
        raise AssertionError("the data was counted")
    want = sorted(ops.drop_empty(table).collect())
    monkeypatch.setattr(reports, "_filled_columns", no_pass)
    out = ops.drop_empty(table, parquet=[path])
    assert out.columns == ["id", "b b"] and sorted(out.collect()) == want


def test_drop_empty_without_statistics(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    pq.write_table(pa.table({"a": pa.array([None, None], pa.int64()), "b": [1, None]}), tmp_path / "x.parquet", write_statistics=False)
    path = str(tmp_path / "x.parquet")
    out = ops.drop_empty(spark.read.parquet(path), parquet=[path])
    assert out.columns == ["b"] and [r[0] for r in out.collect()] == [1]
