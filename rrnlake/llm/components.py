"""Connected components of a graph of links, by alternating star operations (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rrnlake.plans.durable import durable


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of links (a, b): root is the least node reachable. Null ends and loops are ignored.

    Each round sends the larger neighbours of a node, then its smaller ones, to its least neighbour; a few rounds are
    enough for any graph. No group is gathered: a hot node is a skewed join against one row per node. Runs jobs.
    """
    edges = durable(
        links.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.filter("v > u").join(_least_neighbour(both.unionAll(both.select("u", F.col("u").alias("v")))), "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        large = durable(large)
        least = _least_neighbour(large)
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = durable(small.unionAll(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        seen, mark = mark, _mark(edges)
        if seen == mark:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
