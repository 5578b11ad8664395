"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblode.llm.common import remove, scratch_dir, stage

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for links ``(a, b)`` of long ids; the component is
    its smallest node. Nodes without a link are not in the result.

    Alternates large and small stars until the links no longer change: every
    round is a minimum by node and a join, so a node with very many links is
    summed up before the shuffle and split by adaptive execution in the join.
    Each round is written to the shared scratch folder. Null ends and links of
    a node to itself count for nothing; an empty table gives an empty result.
    """
    spark, place = links.sparkSession, scratch_dir(links.sparkSession)
    edges = stage(
        links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
        .where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        place,
    )
    before = None
    for _ in range(MAX_ROUNDS):
        last, place = place, scratch_dir(spark)
        edges = stage(_small_star(_large_star(edges)), place)
        remove(spark, last)
        now = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum((F.xxhash64("a", "b") % 1_000_003)).alias("h")
        ).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (
        both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
