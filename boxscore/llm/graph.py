"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROUNDS = 60  # far beyond what log(longest path) needs; not reaching a fixed point is an error


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node of its component.

    Each round moves every node's larger neighbours, then its smaller ones, to
    its smallest neighbour. A round writes its links to the checkpoint folder,
    so lineage stays short and a lost executor costs one round at most.
    """
    edges = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where("u <> v").distinct().checkpoint())
    before = None
    for _ in range(MAX_ROUNDS):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = (both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(lowest, "u")
        edges = (moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(lowest.select("u", F.col("m").alias("v"))).where("u <> v").distinct().checkpoint())
    else:
        raise RuntimeError("components did not settle")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(roots)
