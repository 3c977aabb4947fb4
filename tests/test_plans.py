"""Plan-shape regression tests: the scale properties the design relies on."""
import re

from gridmetrics import operators as ops
from gridmetrics.plans.adapters import adapter
from gridmetrics.plans.pipeline import eu_pipeline

SF = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges_have_partial_below(plan: str) -> bool:
    """Every hash exchange's child is a partial aggregate (map-side reduction)
    or the post-window generator path (already reduced rows)."""
    lines = plan.splitlines()
    for i, ln in enumerate(lines):
        if "Exchange hashpartitioning" in ln and "Broadcast" not in ln:
            nxt = " ".join(lines[i + 1:i + 3])
            if not re.search(r"partial_|HashAggregate|SortAggregate|Project", nxt):
                return False
    return True


def test_flagship_shape(spark):
    kpi = eu_pipeline(adapter(spark, SF, "readings"), "day").kpi
    plan = physical(kpi)
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("BroadcastHashJoin") == 2                  # fixed-size dimensions only
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 3
    assert "partial_sum(value" in plan                           # raw rows reduced before the first shuffle
    assert exchanges_have_partial_below(plan)


def test_latest_pick_is_partial_aggregate(spark):
    kpi = eu_pipeline(adapter(spark, SF, "readings"), "day").kpi
    plan = physical(ops.kpi_latest_items(kpi))
    assert "partial_max_by" in plan and "Window" not in plan.split("Exchange")[0]


def test_profile_sample_limits_before_shuffle(spark):
    plan = physical(ops.table_profile(adapter(spark, SF, "readings"), ["country", "metric"]))
    assert re.search(r"WindowGroupLimit .* Partial", plan)


def test_bucket_filters_reach_scan(spark):
    b = ops.bucket_coverage(adapter(spark, SF, "readings_years"), "month")
    plan = physical(b)
    assert "PushedFilters: [IsNotNull(l_shipdate)" in plan or "IsNotNull(l_shipdate)" in plan
    scanned = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)[0]
    cols = {c.split("#")[0] for c in scanned.split(",")}
    # only the six columns the adapter and the roll-up use are read
    assert cols == {"l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"}


def test_year_compare_prunes_to_two_years(spark):
    daily = adapter(spark, SF, "daily_prices")
    plan = physical(ops.year_compare(ops.yearly_kpis(daily, years=(1995, 2000)), "avg_price", 1995, 2000))
    assert plan.count("FileScan") == 1
    assert re.search(r"PushedFilters: \[IsNotNull\(o_orderdate\), Or\(And\(GreaterThanOrEqual\(o_orderdate,1995-01-01", plan)


def test_table_profile_scans_once(spark):
    df = ops.table_profile(adapter(spark, SF, "readings"), ["country", "metric"])
    df.collect()
    final = physical(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
