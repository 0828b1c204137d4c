"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.session import checkpointed


def connected_components(links: DataFrame) -> DataFrame:
    """Component of every node that has a link: ``node`` and ``component``.

    ``links`` has two columns, ``a`` and ``b``. The component is the smallest node. Each
    round links every node to the smallest of its neighbours, first from the
    side of the larger ones, then from that of the smaller ones, and is kept by
    a reliable checkpoint. Rounds grow with the logarithm of the diameter. Only
    two numbers per round come to the driver; a node with many links is one
    group of a partial aggregate and a side that a skewed join may split.
    """
    edges = checkpointed(_larger_first(links.select("a", "b")))
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        stars = _larger_first(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = stars.groupBy("a").agg(F.min("b").alias("m"))
        # The larger end a is linked to its least m; so is each other smaller neighbour.
        down = stars.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = checkpointed(_larger_first(least.select("a", F.col("m").alias("b")).unionByName(down)))
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))


def _larger_first(links: DataFrame) -> DataFrame:
    return links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
