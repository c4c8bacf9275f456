"""Connected components by large-star and small-star rounds, all on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (itself included)."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    least = least.select("c", F.least("c", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    moved = edges.join(least, F.col("u") == F.col("c")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v")))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node with an edge other than a root; root is the smallest node it can reach.

    ``edges`` has columns u and v of one orderable type, in any direction, repeats and loops allowed.  Each round's edges
    are written to the shared folder; rounds end when a round changes nothing (about log of the diameter)."""

    def oriented(e: DataFrame) -> DataFrame:
        return e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = stored(oriented(edges), "edges")
    seen = mark(now)
    for _ in range(rounds):
        if not seen[0]:
            break
        now = stored(oriented(_small_star(oriented(_large_star(now)))), "edges")
        after = mark(now)
        if after == seen:
            break
        seen = after
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
