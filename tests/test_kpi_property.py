"""Property test: the one-pass KPI + DQ aggregate equals the join form
(KPI aggregate left-joined with the DQ roll-up) on random readings."""
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import readings_rows
from gridmetrics import operators as ops

series = st.sampled_from([
    ("generation", "renewable", "MWh", "entsoe"), ("generation", "fossil", "MWh", "ember"),
    ("generation", "nuclear", "MWh", "entsoe"), ("generation", "all", "MWh", "entsoe"),
    ("price", "all", "EUR/MWh", "entsoe"), ("price", "all", "USD/MWh", "ember"),
    ("net_import", "all", "MWh", "entsoe"), ("load", "all", "MWh", "entsoe"),
])
row = st.tuples(st.integers(0, 24 * 6), st.sampled_from(["DE", "FR", "NL"]), series,
                st.one_of(st.none(), st.sampled_from([0.0, 1.5, 10.0, 42.25, 99.99])))


def same(a, b):
    if a is None or b is None:
        return a is b
    if isinstance(a, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9)
    return a == b


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=30), level=st.sampled_from(["day", "week"]))
def test_fused_kpi_equals_join_form(spark, rows, level):
    data = [(f"2024-01-{1 + h // 24:02d}T{h % 24:02d}:00:00Z", c, m, s, v, u, sy)
            for h, c, (m, s, u, sy), v in rows]
    cov = ops.bucket_coverage(readings_rows(spark, data), level)
    fused = {(r["period_start_utc"], r["country"]): r.asDict() for r in ops.compute_kpis_with_quality(cov, level).collect()}
    joined = {(r["period_start_utc"], r["country"]): r.asDict()
              for r in ops.compute_kpis(ops.bucketed_view(cov), level, dq=ops.dq_rollup(cov)).collect()}
    assert fused.keys() == joined.keys()
    for k in fused:
        for col, v in fused[k].items():
            assert same(v, joined[k][col]), (k, col, v, joined[k][col])
