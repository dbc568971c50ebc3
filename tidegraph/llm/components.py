"""Connected components over a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def components(links: DataFrame) -> DataFrame:
    """(id, label) for every end of links (a, b): the label is the smallest id reachable.

    Each round hangs every neighbour of a node on the smallest node of its
    neighbourhood.  The minima are partial aggregates and the rest are joins, so
    no node's neighbours meet in one task; rounds grow with the logarithm of the
    longest chain.  Each round is a written table.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, "edges")
    before = None
    while True:
        # large star: each larger neighbour of u goes to the smallest of u and its neighbours
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, edges = edges, written(least.select("u", F.col("m").alias("v")).union(moved).distinct(), "edges")
        state = edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        # equal sums are a hint; the end is that no edge is new
        if state == before and edges.join(last, ["u", "v"], "left_anti").isEmpty():
            return edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("label")).union(edges.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct())
        before = state
