"""Property test: the Spark bucket roll-up equals a plain model of its rules
(interior gaps, Monday-ending weeks, sum/mean/count) on random input."""
import datetime as dt
import math
from collections import defaultdict

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

from conftest import readings_rows
from gridmetrics import operators as ops

BASE = dt.datetime(2024, 2, 20)                                  # spans a leap-year February
NAMES = {"DE": "Germany", "FR": "France"}

row = st.tuples(
    st.integers(min_value=0, max_value=24 * 80),                 # hour offset in ~80 days
    st.sampled_from(["DE", "FR"]),
    st.sampled_from(["generation", "price"]),
    st.one_of(st.none(), st.floats(min_value=-50, max_value=500, allow_nan=False).map(lambda x: round(x, 2))),
)


def bucket_of(t, level):
    day = t.replace(hour=0)
    if level == "hour":
        return t
    if level == "week":                                          # Tuesday to Monday, named by the Monday
        return day + dt.timedelta(days=(7 - day.weekday()) % 7)
    return day.replace(day=1) if level == "month" else day


def after(b, level):
    if level == "month":
        return (b + dt.timedelta(days=32)).replace(day=1)
    return b + {"hour": dt.timedelta(hours=1), "day": dt.timedelta(days=1), "week": dt.timedelta(days=7)}[level]


def model(rows, level):
    series = defaultdict(lambda: defaultdict(list))
    for hours, country, metric, value in rows:
        b = bucket_of(BASE + dt.timedelta(hours=hours), level)
        series[NAMES[country], metric][b] += [] if value is None else [value]
    out = {}
    for (country, metric), buckets in series.items():
        b = min(buckets)
        while b <= max(buckets):
            v = buckets.get(b, [])
            total = math.fsum(v)
            value = total if metric == "generation" else (total / len(v) if v else None)
            out[country, metric, b] = (None if value is None else round(value, 6), len(v))
            b = after(b, level)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=40), level=st.sampled_from(["hour", "day", "week", "month"]))
def test_bucket_matches_model(spark, rows, level):
    data = [((BASE + dt.timedelta(hours=h)).strftime("%Y-%m-%dT%H:%M:%SZ"), c, m, "all", v, "u", "s")
            for h, c, m, v in rows]
    cov = ops.bucket_coverage(readings_rows(spark, data), level)
    got = {(r["country"], r["metric"], r["ts_utc"]):
           (None if r["value"] is None else round(r["value"], 6), r["actual_points"]) for r in cov.collect()}
    want = model(rows, level)
    assert got.keys() == want.keys()
    for k, (v, n) in want.items():
        gv, gn = got[k]
        assert gn == n, k
        assert (gv is None and v is None) or (gv is not None and v is not None and math.isclose(gv, v, abs_tol=1e-6)), (k, gv, v)
