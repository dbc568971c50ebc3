"""From scanned events to lists, and from lists to what changes in the store's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import edge_diff, gate, tags
from ..operators.dictionary import checked_keys, get_or_create, resolved
from ..schemas import KIND_FOLLOWS, KIND_RELAYS
from ..store import Snapshot, settled


def _winners(scan: DataFrame, requested: DataFrame, kind: int, as_of: int, clamp: int, trusted: bool) -> DataFrame:
    events = scan.withColumnRenamed("pubkey", "author")
    resolve = gate.resolve if trusted else gate.resolve_unverified
    return resolve(events, requested, kind, as_of, clamp)


def follow_winners(scan: DataFrame, requested: DataFrame, as_of: int, clamp: int = gate.FUTURE_CLAMP, trusted: bool = False) -> DataFrame:
    """(author, id, created_at, followees): the newest valid list of each requested author, of any length."""
    return _winners(scan, requested, KIND_FOLLOWS, as_of, clamp, trusted).select("author", "id", "created_at", tags.followees(F.col("tags"), F.col("author")).alias("followees"))


def follow_lists(scan: DataFrame, requested: DataFrame, as_of: int, clamp: int = gate.FUTURE_CLAMP, cap: int = tags.FOLLOW_CAP, trusted: bool = False) -> DataFrame:
    """(author, id, created_at, followees): the newest valid list of each requested author that has one within the cap."""
    return tags.within_cap(follow_winners(scan, requested, as_of, clamp, trusted), cap)


def relay_lists(scan: DataFrame, requested: DataFrame, as_of: int, clamp: int = gate.FUTURE_CLAMP, trusted: bool = False) -> DataFrame:
    """(author, id, created_at, relays): the newest valid relay list of each requested author."""
    lists = _winners(scan, requested, KIND_RELAYS, as_of, clamp, trusted)
    return lists.select("author", "id", "created_at", tags.relay_pairs(F.col("tags")).alias("relays"))


def new_vertices(pubkeys: DataFrame, keys: DataFrame) -> DataFrame:
    """Vertex rows, as discovered, of the keys that the vertex table lacks."""
    known = pubkeys.select("id", "pubkey")
    new = get_or_create(known, checked_keys(keys.select("pubkey").distinct())).join(known, "id", "left_anti")
    zero = {"status": F.lit("discovered"), "fetch_count": F.lit(0), "change_count": F.lit(0), "fetch_attempts": F.lit(0)}
    return new.select(*[F.col(f.name) if f.name in ("id", "pubkey") else zero.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in pubkeys.schema.fields])


def with_keys(pubkeys: DataFrame, keys: DataFrame) -> DataFrame:
    """The vertex table with rows for keys that it lacked."""
    return pubkeys.unionByName(new_vertices(pubkeys, keys))


def list_changes(base: Snapshot, lists: DataFrame, as_of: int, guard_stale: bool = False) -> dict:
    """What lists (author, id, created_at, followees) change: their keys become vertices, their edges the graph.

    Of the vertex table only keys and ids are scanned whole; states and edges are read
    and written for the lists' authors alone.
    """
    lists = settled(lists, "lists")
    pairs = lists.select("author", F.explode("followees").alias("followee"))
    keys = settled(lists.select(F.col("author").alias("pubkey")).union(pairs.select("followee")).distinct(), "keys")
    fresh = settled(new_vertices(base.pubkeys, keys), "new-vertices")
    dictionary = settled(base.pubkeys.select("id", "pubkey").join(keys, "pubkey", "left_semi").select("id", "pubkey").unionByName(fresh.select("id", "pubkey")), "dictionary")
    edges = resolved(pairs, dictionary).groupBy(F.col("follower_id").alias("id")).agg(F.collect_set("followee_id").alias("followee_ids"))
    heads = lists.select(F.col("author").alias("pubkey"), F.col("id").alias("event_id"), F.timestamp_seconds("created_at").alias("created_at"))
    by_id = heads.join(dictionary, "pubkey").join(edges, "id", "left").withColumn("followee_ids", F.coalesce("followee_ids", F.array().cast("array<long>")))
    by_id = settled(by_id.drop("pubkey"), "by-id")
    state = base.of_keys("pubkeys", by_id.select("id")).unionByName(fresh.join(by_id.select("id"), "id", "left_semi"))
    rows, new, touched = edge_diff.changes(settled(state, "authors"), lambda who: base.of_keys("follows", who), by_id, F.timestamp_seconds(F.lit(as_of)), guard_stale)
    rows = settled(rows, "changed")
    return {"pubkeys": rows.unionByName(fresh.join(rows.select("id"), "id", "left_anti").select(*rows.columns)), "follows": (new, touched)}


def relay_changes(base: Snapshot, lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, keys): the relay table's rows of the authors of lists (author, created_at, relays), which replace theirs whole.

    A row is as old as the list that names it; a list that names no relay leaves its author none.
    """
    owners = settled(lists.select(F.col("author").alias("pubkey"), "created_at", "relays").join(base.pubkeys.select(F.col("id").alias("pubkey_id"), "pubkey"), "pubkey"), "relay-owners")
    rows = owners.select("pubkey_id", "created_at", F.explode("relays").alias("r"))
    new = rows.select("pubkey_id", F.col("r.pos").alias("pos"), F.col("r.url").alias("url"), F.col("r.marker").alias("marker"), F.timestamp_seconds("created_at").alias("seen_at"))
    return tags.first_markers(new, "pubkey_id").drop("pos"), owners.select("pubkey_id")
