"""Connected components of a graph given as links, by alternating star contractions.

Each round of joins and aggregations moves links towards the smallest node of a component, so the
number of rounds grows with the logarithm of the longest chain. A round is written to the shared
folder before the next one reads it. Nothing but two numbers per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`node` and `component`, the smallest node reachable, for every linked node but that smallest one.

    Null ends and loops are no links; the order of the ends and repeated links do not matter.
    """
    ends = links.where(f"{a} <> {b}").selectExpr(f"greatest({a}, {b}) AS node", f"least({a}, {b}) AS low")
    edges = stored(ends.distinct(), "links")
    before = None
    while True:
        # Every node tells its larger neighbours its smallest one ...
        both = edges.union(edges.select(F.col("low").alias("node"), F.col("node").alias("low")))
        smallest = both.groupBy("node").agg(F.min("low").alias("small"))
        large = (
            both.where("low > node")
            .join(smallest, "node")
            .selectExpr("low AS node", "least(small, node) AS low")
            .distinct()
        )
        # ... and then its smaller ones.
        small = large.groupBy("node").agg(F.min("low").alias("small"))
        moved = large.join(small, "node").selectExpr(
            "CASE WHEN low > small THEN low ELSE node END AS node", "small AS low"
        )
        edges = stored(moved.distinct(), "links")
        state = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("node", "low") % F.lit(1 << 40)).alias("h"),
        ).first()
        if state == before:
            return edges.groupBy("node").agg(F.min("low").alias("component"))
        before = state
