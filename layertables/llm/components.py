"""Connected components of a table of links, by alternating large and small stars.

Every round is a partial aggregate and two joins; rounds are written to the
shared folder, so lineage stays short and no node's links meet in one task but
as a mergeable minimum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layertables.llm.common import written


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _both(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(u, v)``; the root is the least
    node that can be reached. Self links and repeated links do no harm."""
    edges = written(links.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links")
    state = None
    while True:
        # Large star: neighbours above a node hang under the least of its neighbourhood.
        both = _both(edges)
        large = both.filter("v > u").join(_least(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # Small star: a node and its smaller neighbours hang under the least of them.
        low = _least(large)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        small = small.filter("u <> v").distinct()
        edges = written(small.select(F.col("v").alias("u"), F.col("u").alias("v")), "stars")
        now = edges.agg(
            F.count("*"), F.count_distinct("v"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == state or now[0] == 0:
            break
        state = now
        # Stars only: no node is both a centre and a leaf, and every leaf has one centre.
        if now[0] == now[1] and edges.join(edges.select(F.col("v").alias("u")), "u", "left_semi").isEmpty():
            break
    roots = edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return roots.unionByName(roots.select("root").distinct().select(F.col("root").alias("node"), "root"))
