"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014), on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import written


def _counted(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Writes the edges and sees their count and a checksum on the way."""
    seen = Observation()
    out = written(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")), "links")
    return out, (seen.get["n"], seen.get["sum"])


def _toward_least(pairs: DataFrame, label: str) -> DataFrame:
    """Adds m, the least of a node u and its neighbours v. The minimum is pre-aggregated and read back from disk, so
    that the join's sides both come from plain exchanges and a node with very many links is split by AQE."""
    least = written(pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), label)
    return pairs.join(least, "u")


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of each node in a link; root is the component's least node. Links to itself are left out.

    Every round is a few shuffles of the links, written to the shared folder; rounds grow with the
    logarithm of the longest path, and only a count and a checksum come to the driver.
    """
    edges, state = _counted(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a != b").distinct())
    while state[0]:
        both = edges.selectExpr("a as u", "b as v").unionByName(edges.selectExpr("b as u", "a as v"))
        large = _toward_least(both, "large").where("v > u").selectExpr("v as u", "m as v").where("u != v")
        small = _toward_least(written(large, "down"), "small")
        turned = small.selectExpr("v as a", "m as b").unionByName(small.selectExpr("u as a", "m as b")).where("a != b").distinct()
        before = state
        edges, state = _counted(turned)
        if state == before:
            break
    roots = edges.selectExpr("a as node", "b as root")
    return roots.unionByName(edges.selectExpr("b as node", "b as root").distinct())
