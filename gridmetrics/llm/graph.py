"""Connected components of an edge table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

MAX_ROUNDS = 60


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least node it knows."""
    both = _both(edges)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.filter(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter(F.col("u") != F.col("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the least of them.
    ``edges`` point from the larger node ``u`` to the smaller ``v``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).filter(F.col("u") != F.col("v")))


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every node points to one root, and no root points anywhere."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("out")))
    per = ends.groupBy("x").agg(F.sum("out").alias("out"), F.count_if(F.col("out") == 0).alias("into"))
    return per.filter("out > 1 OR (out > 0 AND into > 0)").isEmpty()


def components(scratch: Scratch, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp): the least node reachable, for every node with an edge.

    Alternates large-star and small-star steps until all components are stars;
    both keep the number of edges bounded, so a hub with most edges costs one pass
    over them. Each round is a table in the shared folder.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    e = scratch.save(e, "edges")
    for _ in range(MAX_ROUNDS):
        old = e
        large = scratch.save(_large_star(old), "large")
        e = scratch.save(_small_star(large).distinct(), "edges")
        scratch.drop(old, large)
        if _is_star_forest(e):
            break
    else:
        raise RuntimeError(f"components: not settled after {MAX_ROUNDS} rounds")
    roots = e.select(F.col("v").alias("node")).distinct()
    return scratch.save(e.select(F.col("u").alias("node"), F.col("v").alias("comp"))
                        .unionByName(roots.select("node", F.col("node").alias("comp"))), "components")
