import pytest

from gridmetrics.llm import graph
from gridmetrics.llm.common import Scratch


def test_unsettled_components_fail(spark, monkeypatch):
    edges = spark.createDataFrame([((i * 37) % 101, ((i + 1) * 37) % 101) for i in range(100)], "a long, b long")
    scratch = Scratch(spark, "components-test")
    assert {r["comp"] for r in graph.components(scratch, edges).collect()} == {0}
    monkeypatch.setattr(graph, "MAX_ROUNDS", 1)
    with pytest.raises(RuntimeError, match="not settled"):
        graph.components(scratch, edges)
