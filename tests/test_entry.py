import __spark_entry__ as E


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "avg_price" in df.columns and "dq_issue_count" in df.columns
