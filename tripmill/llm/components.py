"""Connected components of a large graph, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import written


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node of ``edges(a, b)``, a >= b, has one lower neighbour at most, and that none."""
    stars = edges.where("a > b")
    above = stars.select(F.col("a").alias("node"), "b")
    below = stars.select(F.col("b").alias("node"), F.lit(None).cast(stars.schema["b"].dataType).alias("b"))
    nodes = above.unionByName(below).groupBy("node").agg(F.min("b").alias("least"), F.max("b").alias("most"), F.count_if(F.col("b").isNull()).alias("n"))
    return nodes.where("least <> most or least is not null and n > 0").count() == 0


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges(a, b)``, the root being its least node.

    Edges may repeat, point either way or join a node to itself; rows with a null end do not
    count. Each round points every node at the least of its neighbours, first from above and
    then from below, until all are stars around their least node; the number of rounds grows
    with the logarithm of the longest path. Nothing is gathered by node, so a node may have any number of edges.
    """
    whole = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    high_low = whole.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = written(high_low.distinct(), "edges")
    while not _are_stars(now):
        stars = now.where("a > b")
        both = stars.select("a", "b").unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Both sides of a join are shuffled as they are, so that AQE splits a node with many edges.
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).repartition("a")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.repartition("a").join(lower.repartition("a"), "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        loops = now.where("a = b")
        now = written(small.unionByName(lower.withColumnRenamed("m", "b")).unionByName(loops).distinct(), "edges")
    roots = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    own = roots.select(F.col("root").alias("node"), "root")
    return roots.unionByName(own).groupBy("node").agg(F.min("root").alias("root"))
