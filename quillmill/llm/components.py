"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is an aggregation of neighbours to their minimum and a join of the edges with it; no node's
neighbours are ever collected, so a hub is an ordinary skewed join. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import materialize


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked with the least of u and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of u, and u, is linked with the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``edges`` (u, v) but roots themselves; the root is the component's least node."""
    now = materialize(edges.select("u", "v").where("u <> v").distinct(), "edges")
    last = _print(now)
    for _ in range(rounds):
        if not last[0]:
            break
        now = materialize(_small(_large(now)), "edges")
        if (this := _print(now)) == last:
            break
        last = this
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
