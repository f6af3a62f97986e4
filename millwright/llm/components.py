"""Connected components by alternating large-star and small-star steps.

Every step is a minimum per node, summed up before the shuffle, and a join of that one row per node with
the node's edges. A hub with a third of all edges is one key of that join; adaptive execution splits it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return (
        both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(least.select("a", F.col("low").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) the rows (node, component): the smallest node that can be reached.

    Nodes may be of any type with an order. Links with a null end, loops and repeated links do no harm.
    Only nodes that have a link to another one are returned; no link gives no row.
    """
    spark = links.sparkSession
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        from millwright.session import shared_dir

        shared_dir(spark, "components")  # sets a folder where the session names none
    edges = (
        links.where("a is not null and b is not null and a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
        .checkpoint()
    )
    before = _state(edges)
    while before[0]:
        edges = _small_star(_large_star(edges)).checkpoint()
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
