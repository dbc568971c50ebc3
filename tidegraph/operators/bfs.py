"""Breadth-first discovery from one anchor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..store import fresh, settled


def hops(edges: DataFrame, anchor, most: int = 10_000) -> DataFrame:
    """(node, hop) of everything reachable from the anchor over edges (src, dst).

    Edges that lead somewhere are written once, sorted by src, and each level joins the
    newest nodes with them, drops those seen, and is written once; what was seen is the
    levels' files together, which are united when they have become many.  So the plan
    stays short, and a lost executor loses one level at most.
    """
    spark = edges.sparkSession
    steps = settled(edges.where("src <> dst").select("src", "dst").distinct().sortWithinPartitions("src"), "edges")
    home = fresh(spark, "levels")
    start = spark.createDataFrame([(anchor, 0)], f"node {edges.schema['src'].dataType.simpleString()}, hop int")
    start.write.parquet(f"{home}/0")
    seen_at, front_at = [f"{home}/0"], f"{home}/0"
    for hop in range(1, most + 1):
        seen, front = spark.read.schema(start.schema).parquet(*seen_at), spark.read.schema(start.schema).parquet(front_at)
        reached = steps.join(front.select(F.col("node").alias("src")), "src", "left_semi").select(F.col("dst").alias("node")).distinct()
        front_at = f"{home}/{hop}"
        reached.join(seen, "node", "left_anti").select("node", F.lit(hop).alias("hop")).write.parquet(front_at)
        if spark.read.schema(start.schema).parquet(front_at).isEmpty():
            return seen
        seen_at.append(front_at)
        if len(seen_at) > UNITE:
            spark.read.schema(start.schema).parquet(*seen_at).write.parquet(f"{home}/to-{hop}")
            seen_at = [f"{home}/to-{hop}"]
    raise RuntimeError(f"not done after {most} levels")


#: Levels whose files are read one by one, at most.
UNITE = 24
