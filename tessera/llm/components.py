"""Connected components of a graph of any size, by alternating star contractions.

Each round links every node to the smallest node it knows of, so that trees
become stars in a number of rounds that grows with the logarithm of their
size. Rounds are written to the shared folder: lineage stays short and a lost
executor costs no more than the running round. It is done when no node is both
a centre and linked to another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import forget, written


def contracted(links: DataFrame) -> DataFrame:
    """One round: larger neighbours to the smallest neighbour, then smaller ones to it."""
    both = links.union(links.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    ends = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))
    return large.join(least, "u").select(F.explode(ends).alias("e")).select("e.u", "e.v").filter("u > v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with an edge to another, from a written table of edges; component is the smallest node reachable."""
    # A row is two numbers: fewer files than there are partitions hold them.
    files = max(1, int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    links, table = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct(), None
    while True:
        links, old = written(contracted(links).coalesce(files), "links"), table
        if old is not None:
            forget(old)
        table = links
        centres = links.select(F.col("v").alias("u")).distinct()
        if links.select("u").join(centres, "u", "left_semi").isEmpty() and links.groupBy("u").count().filter("count > 1").isEmpty():
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(links.select("v", "v").distinct())
