import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from gridmetrics.session import build_session
    s = build_session("local[4]", app="gridmetrics-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="gm-tests-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s


def readings_rows(spark, rows, raw_ts=False):
    """rows: (ts text, country, metric, source, value, unit[, system])."""
    from pyspark.sql import functions as F
    from gridmetrics.schema import READING_COLS
    data = []
    for r in rows:
        ts, country, metric, source, value, unit = r[:6]
        system = r[6] if len(r) > 6 else "entsoe"
        data.append((ts, "hour", "EU", country, metric, source, value, unit, "ok", system))
    df = spark.createDataFrame(data, "ts_utc string, period string, region string, country string, metric string, "
                                     "energy_source string, value double, unit string, quality_flag string, "
                                     "source_system string")
    if raw_ts:
        return df.select(*READING_COLS)
    return df.withColumn("ts_utc", F.try_to_timestamp("ts_utc")).select(*READING_COLS)
