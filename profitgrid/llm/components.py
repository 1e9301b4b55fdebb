"""Connected components of a graph given by its links, as a loop of small joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profitgrid.llm.common import stored


def _state(links: DataFrame) -> tuple:
    """Number of links and an order-free digest; equal before and after a round that changed nothing."""
    digest = F.xxhash64("node", "to")
    return links.agg(F.count("*"), F.sum(digest.cast("decimal(38,0)")), F.bit_xor(digest)).first()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node of the component.

    Alternates two steps until nothing changes: every node's larger neighbours move to its smallest
    neighbour (large star), then every node and its smaller neighbours move to the smallest one (small
    star). Rounds grow with the logarithm of the longest chain. Each round is one minimum per node,
    pre-aggregated before its shuffle, and one join of links, whose hot nodes adaptive execution splits;
    it is written to the shared folder, so a lost executor costs at most one round. Only counts and a
    digest reach the driver.
    """
    a, b = F.col("a"), F.col("b")
    now = stored(
        links.where(a != b).select(F.greatest(a, b).alias("node"), F.least(a, b).alias("to")).distinct()
    )
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("to").alias("node"), F.col("node").alias("to")))
        smallest = both.groupBy("node").agg(F.least(F.col("node"), F.min("to")).alias("least"))
        larger = both.where(F.col("to") > F.col("node")).join(smallest, "node")
        large = larger.select(F.col("to").alias("node"), F.col("least").alias("to")).distinct()
        smallest = large.groupBy("node").agg(F.min("to").alias("least"))
        small = large.join(smallest, "node").select(
            F.explode(
                F.array(
                    F.struct("node", F.col("least").alias("to")),
                    F.struct(F.col("to").alias("node"), F.col("least").alias("to")),
                )
            ).alias("x")
        )
        now = stored(small.select("x.node", "x.to").where(F.col("node") > F.col("to")).distinct())
        before, state = state, _state(now)
        if before == state:
            break
    return now.select("node", F.col("to").alias("root")).union(
        now.select(F.col("to").alias("node"), F.col("to").alias("root")).distinct()
    )
