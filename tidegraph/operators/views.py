"""The public read contract: three views and the queries consumers run on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..store import Snapshot

CONTRACT = {
    "follow_edges": ("Directed follow edges by surrogate id.", {"follower_id": "Id of the one who follows.", "followee_id": "Id of the one followed."}),
    "pubkey_lookup": ("Surrogate id to key; join it last.", {"id": "Surrogate id.", "pubkey": "The 32-byte key."}),
    "pubkey_freshness": ("How fresh the knowledge of each key is.", {"id": "Surrogate id.", "status": "discovered, fetched, not_found or failed.", "last_fetched_at": "Time of the last fetch; null before the first."}),
}


def follow_edges(follows: DataFrame) -> DataFrame:
    return follows.select("follower_id", "followee_id")


def pubkey_lookup(pubkeys: DataFrame) -> DataFrame:
    return pubkeys.select("id", "pubkey")


def pubkey_freshness(pubkeys: DataFrame) -> DataFrame:
    """A claim in progress is still discovered to consumers."""
    return pubkeys.select("id", F.when(F.col("status") == "in_progress", "discovered").otherwise(F.col("status")).alias("status"), "last_fetched_at")


def register(snapshot: Snapshot) -> None:
    """Temporary views of one version, for spark.sql."""
    follow_edges(snapshot.follows).createOrReplaceTempView("follow_edges")
    pubkey_lookup(snapshot.pubkeys).createOrReplaceTempView("pubkey_lookup")
    pubkey_freshness(snapshot.pubkeys).createOrReplaceTempView("pubkey_freshness")


def create_views(spark: SparkSession, pubkeys: str, follows: str) -> None:
    """Catalog views with comments over the tables of these names."""
    body = {
        "follow_edges": f"SELECT follower_id, followee_id FROM {follows}",
        "pubkey_lookup": f"SELECT id, pubkey FROM {pubkeys}",
        "pubkey_freshness": f"SELECT id, CASE status WHEN 'in_progress' THEN 'discovered' ELSE status END AS status, last_fetched_at FROM {pubkeys}",
    }
    for name, (about, columns) in CONTRACT.items():
        named = ", ".join(f"{c} COMMENT 'PUBLIC CONTRACT: {text}'" for c, text in columns.items())
        spark.sql(f"CREATE OR REPLACE VIEW {name} ({named}) COMMENT 'PUBLIC CONTRACT: {about}' AS {body[name]}")


def followees_of(edges: DataFrame, node) -> DataFrame:
    return edges.where(F.col("follower_id") == node).select("followee_id")


def in_degree(edges: DataFrame) -> DataFrame:
    return edges.groupBy("followee_id").agg(F.count(F.lit(1)).alias("in_degree"))


def out_degree(edges: DataFrame) -> DataFrame:
    return edges.groupBy("follower_id").agg(F.count(F.lit(1)).alias("out_degree"))


def most_followed(edges: DataFrame, lookup: DataFrame, k: int) -> DataFrame:
    """(id, pubkey, in_degree) of the k most followed: keys are joined after the top-k."""
    top = in_degree(edges).orderBy(F.desc("in_degree"), "followee_id").limit(k)
    return top.join(lookup, top["followee_id"] == lookup["id"]).select("id", "pubkey", "in_degree")


def resolve_ids(lookup: DataFrame, ids: DataFrame) -> DataFrame:
    return lookup.join(ids.select("id").distinct(), "id", "left_semi")


def stale_since(freshness: DataFrame, before) -> DataFrame:
    return freshness.where((F.col("status") == "fetched") & (F.col("last_fetched_at") < before))


def unfetched(freshness: DataFrame) -> DataFrame:
    return freshness.where("status = 'discovered'").select("id")
