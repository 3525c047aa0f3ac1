"""Connected components of a link table, by joins."""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from ..session import checkpoint_root


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The checkpointed edges, with their number and a digest taken on the way."""
    seen = Observation()
    kept = edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).checkpoint()
    return kept, (seen.get["n"], seen.get["s"])


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int | None = None) -> DataFrame:
    """(node, component): the least node reachable, for each node that isn't that itself.

    Alternating large-star and small-star steps: each node tells its larger neighbours, then
    its smaller ones, the least node it knows, until every edge points at its component's
    least node. A step is an aggregate by node (combined before the shuffle) and a join on
    the node. The rows of a hub stay in one task there: adaptive execution doesn't split a join whose
    stage also aggregates by the key. The edges of each round are checkpointed in the shared folder. A link with a null end, or of a node with itself, is
    no link. With `rounds`, it stops after so many: nodes of one answer are connected, but
    a component may still be in several parts."""
    checkpoint_root(links.sparkSession)
    edges, state = _settled(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(f"{a} IS NOT NULL AND {b} IS NOT NULL")
                            .filter("u > v").distinct())
    done = 0
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        before = state
        edges, state = _settled(small)
        done += 1
        if state == before or done == rounds:
            break
    if rounds is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
