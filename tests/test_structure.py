import importlib


def test_package_layout_and_imports():
    for mod in ("gridmetrics", "gridmetrics.operators", "gridmetrics.sources", "gridmetrics.functions",
                "gridmetrics.plans", "gridmetrics.streaming", "gridmetrics.cli", "__spark_entry__"):
        importlib.import_module(mod)


def test_fixed_values_are_complete():
    from gridmetrics.schema import EU27, KPI_COLS
    assert len(EU27) == 27 and len({i for i, _ in EU27}) == 27 and len({n for _, n in EU27}) == 27
    assert len(KPI_COLS) == 17


def test_no_python_udfs_in_library():
    import pathlib
    root = pathlib.Path(__file__).resolve().parents[1] / "gridmetrics"
    text = "\n".join(p.read_text() for p in root.rglob("*.py"))
    assert "@F.udf" not in text and "pandas_udf" not in text and ".rdd" not in text
