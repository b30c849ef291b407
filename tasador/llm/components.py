"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), root being the smallest
    node reachable. Large-star and small-star steps alternate until the table of
    links no longer changes; each round is written to the shared folder, so a lost
    executor costs one round. Joins are on plain tables, which lets Spark split a
    node with very many links."""
    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(ends.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "least")
        # large star: every larger neighbour of a node links to its least neighbour
        large = ends.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = written(large, "large")
        # small star: the node and its smaller neighbours link to the least of them
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").filter("a <> b").distinct()
        new = written(small, "links")
        same = [x.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() for x in (edges, new)]
        if same[0] == same[1]:
            break
        edges = new
    # every link now goes to its component's root
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
