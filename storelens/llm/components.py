"""Connected components of a graph given by its links, as label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import discard, shuffles_removed, stored


def components(links: DataFrame) -> DataFrame:
    """The smallest node reachable from each node: columns node and component; ``links`` has a and b.

    In every round each link gives way to links from its ends' least known
    neighbours, and nodes already hung on their least neighbour keep one link
    to it (large star and small star).  It ends when every node hangs directly
    on the least node of its component.  Minima are merged before they are moved, and the joins
    see plain exchanges, so that a node with very many links can be split.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: all larger neighbours of a node hang on its least neighbour or itself.
        first = stored(both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least")), "least")
        large = both.where("b > a").join(first, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = stored(large.where("a <> b").distinct(), "large")
        # Small star: a node's smaller neighbours and itself hang on the least of them.
        least = stored(large.groupBy("a").agg(F.min("b").alias("least"), F.count(F.lit(1)).alias("n")), "least")
        discard(first)
        discard(edges)
        joined = large.join(least, "a")
        small = joined.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        small = stored(small.unionAll(least.select("a", F.col("least").alias("b"))).distinct(), "small")
        discard(large)
        discard(least)
        # Done if no node hangs on two, and none that others hang on hangs itself.
        several = small.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        hanging = small.join(small.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        with shuffles_removed(links.sparkSession):
            done = several.isEmpty() and hanging.isEmpty()
        if done:
            roots = small.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return small.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
        edges = small
