"""CSV files whose quoted values hold line breaks, read by byte ranges."""
import csv
import random

import pytest
from pyspark.sql import functions as F

from gridmetrics import sources as src
from gridmetrics.schema import KPI
from gridmetrics.session import scratch_path
from gridmetrics.sources import csvfiles


@pytest.fixture
def small_ranges(spark):
    for k, v in (("maxPartitionBytes", "300"), ("openCostInBytes", "1")):
        spark.conf.set(f"spark.sql.files.{k}", v)
    yield
    for k in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{k}")


def odd_values(seed, n):
    r = random.Random(seed)
    bits = ["a", '"', "\n", "\r\n", ",", "\\", "\\N", " ", "é", "日", "\n\n", "x" * 40, '""', "\t"]
    value = lambda: None if r.random() < 0.1 else "".join(r.choice(bits) for _ in range(r.randrange(6)))
    return [(str(i), value(), value()) for i in range(n)]


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_one_file_read_by_many_tasks(spark, small_ranges, monkeypatch, seed, broadcast):
    if not broadcast:
        monkeypatch.setattr(csvfiles, "MOST_BROADCAST_RANGES", 0)
    rows = odd_values(seed, 400) + [("long", "line\n" * 300, 'say ""\n' * 90)]
    path = scratch_path(spark, "csv-one")
    src.write_csv(spark.createDataFrame(rows, "a string, b string, c string").coalesce(1), path)
    lines = csvfiles.csv_lines(spark, path)
    assert lines.select("file").distinct().count() == 1 and lines.select("block").distinct().count() > 20
    tasks = src.csv_records(spark, path).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > (4 if broadcast else 1)  # the tests' sessions have four shuffle partitions
    key = lambda r: tuple((x is not None, x or "") for x in r)
    assert sorted((tuple(r) for r in src.read_csv(spark, path).collect()), key=key) == sorted(rows, key=key)


def test_null_text_and_marker_stay_apart(spark):
    rows = [(None,), ("\\N",), ("\\\\N",), ("",), ("\\",), ("N",)]
    path = scratch_path(spark, "csv-null")
    src.write_csv(spark.createDataFrame(rows, "a string"), path)
    assert sorted(src.read_csv(spark, path).collect(), key=str) == sorted(map(tuple, rows), key=str)


def test_files_of_other_writers(spark, small_ranges, tmp_path):
    rows = odd_values(7, 150)
    want = sorted(tuple(x or "" for x in r) for r in rows)
    for name, end in (("unix", "\n"), ("windows", "\r\n")):
        with open(tmp_path / f"{name}.csv", "w", newline="", encoding="utf-8") as f:
            w = csv.writer(f, lineterminator=end, quoting=csv.QUOTE_ALL)
            w.writerow(["a", "two\nlines", "c"])
            w.writerows([[x or "" for x in r] for r in rows])
        out = src.read_csv(spark, str(tmp_path / f"{name}.csv"))
        assert out.columns == ["a", "two\nlines", "c"]
        plain = lambda x: None if x == "\\N" else x[1:] if x.startswith("\\\\") else x
        assert sorted(out.collect(), key=str) == sorted((tuple(plain(x) for x in r) for r in want), key=str)


def test_empty_folder_and_header_only(spark):
    path = scratch_path(spark, "csv-empty")
    src.write_csv(spark.createDataFrame([], "a string, b string"), path)
    assert src.read_csv(spark, path, KPI).count() == 0


def test_positions_follow_key_order(spark):
    kpi = spark.range(500).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 86_400).alias("period_start_utc"), F.lit("EU").alias("region"),
        F.element_at(F.array(F.lit("Germany"), F.lit("France"), F.lit("Spain")), (F.col("id") % 3 + 1).cast("int")).alias("country"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in KPI.fields if f.name not in ("period_start_utc", "region", "country")])
    path = scratch_path(spark, "csv-order")
    src.write_kpi_history(kpi.repartition(5), path)
    back = src.read_csv_in_order(spark, path, KPI).collect()
    by_place = [(r.region, r.country, r.period_start_utc) for r in sorted(back, key=lambda r: r.position)]
    assert sorted(r.position for r in back) == list(range(500)) and by_place == sorted(by_place)
