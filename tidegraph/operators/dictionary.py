"""Surrogate ids: stable, gapless from the last one, safe under task retries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..store import settled


def checked_keys(keys: DataFrame, name: str = "pubkey") -> DataFrame:
    """keys; fails on one that isn't 32 bytes long, and says how long it is."""
    bad = F.raise_error(F.concat(F.lit("key has "), F.octet_length(name).cast("string"), F.lit(" bytes, not 32")))
    return keys.withColumn(name, F.when(F.octet_length(name) == 32, F.col(name)).otherwise(bad.cast("binary")))


def numbered(keys: DataFrame, name: str, after: int = 0, parts: int | None = None) -> DataFrame:
    """(id, key) of the distinct keys in their order, ids from after + 1.

    A global row_number would sort in one task.  Instead keys are range-partitioned and
    sorted, and written with their partition and place; ids are places lifted by the
    sizes of the partitions before, which are all that crosses to one task.  Places and
    sizes come from the one written table, so they fit however often tasks run.
    """
    parts = parts or int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.select(name).where(F.col(name).isNotNull()).distinct().repartitionByRange(parts, name).sortWithinPartitions(name)
    # partition << 33 | place
    placed = settled(dealt.withColumn("__at", F.monotonically_increasing_id()), "numbered").select(name, F.shiftright("__at", 33).alias("__part"), F.col("__at").bitwiseAND((1 << 33) - 1).alias("__place"))
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    bases = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__base"))
    return placed.join(F.broadcast(bases), "__part").select((F.col("__place") + F.col("__base") + F.lit(after + 1)).cast("long").alias("id"), name)


def get_or_create(dictionary: DataFrame, keys: DataFrame, name: str = "pubkey") -> DataFrame:
    """The dictionary (id, key) with ids for keys that it lacked; existing ids never change."""
    new = keys.select(name).join(dictionary, name, "left_anti")
    last = dictionary.agg(F.max("id")).first()[0] or 0
    return dictionary.select("id", name).unionByName(numbered(new, name, last))


def resolved(edges: DataFrame, dictionary: DataFrame, name: str = "pubkey") -> DataFrame:
    """(follower_id, followee_id) of edges (author, followee); Spark handles a celebrity's skew as it joins."""
    d = dictionary.select("id", F.col(name).alias("__key"))
    left = edges.join(d, F.col("author") == F.col("__key")).select(F.col("id").alias("follower_id"), "followee")
    return left.join(d, F.col("followee") == F.col("__key")).select("follower_id", F.col("id").alias("followee_id"))
