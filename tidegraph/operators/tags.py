"""Tag lists to followees and relay pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import marker, relay_url

#: Followees that a list may have (a fixed value).
FOLLOW_CAP = 10_000


def followees(tags: Column, author: Column) -> Column:
    """Distinct keys (64 lower-case hex digits) of the p tags, in order, without the author; malformed tags are skipped."""
    good = F.filter(tags, lambda t: (F.get(t, F.lit(0)) == "p") & F.coalesce(F.get(t, F.lit(1)).rlike("^[0-9a-f]{64}$"), F.lit(False)))
    return F.array_distinct(F.filter(F.transform(good, lambda t: F.unhex(t[1])), lambda k: k != author))


def relay_pairs(tags: Column) -> Column:
    """(pos, url, marker) of the r tags in order; tags without a ws address or with an unknown marker are skipped."""
    rows = F.transform(tags, lambda t, i: F.struct(i.alias("pos"), F.get(t, F.lit(0)).alias("name"), relay_url(F.get(t, F.lit(1))).alias("url"), marker(F.get(t, F.lit(2))).alias("marker")))
    good = F.filter(rows, lambda r: (r["name"] == "r") & F.coalesce(r["url"].rlike("^wss?://."), F.lit(False)) & r["marker"].isNotNull())
    return F.transform(good, lambda r: F.struct(r["pos"].alias("pos"), r["url"].alias("url"), r["marker"].alias("marker")))


def within_cap(lists: DataFrame, cap: int = FOLLOW_CAP, name: str = "followees") -> DataFrame:
    """Lists of at most `cap` followees.  A larger winner drops its author: no older list stands in."""
    return lists.where(F.size(name) <= cap)


def oversized(lists: DataFrame, cap: int = FOLLOW_CAP, name: str = "followees") -> DataFrame:
    return lists.where(F.size(name) > cap)


def edges(lists: DataFrame) -> DataFrame:
    """(author, followee) of lists (author, followees), without self follows, distinct within a list."""
    return lists.select("author", F.explode(F.array_distinct("followees")).alias("followee")).where("author <> followee")


def first_markers(pairs: DataFrame, *key: str) -> DataFrame:
    """Of each key and url the first marker (pairs: key, pos, url, marker)."""
    w = Window.partitionBy(*key, "url").orderBy("pos")
    return pairs.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def write_relays(pairs: DataFrame) -> DataFrame:
    """Pairs that can be written to; a bare tag counts."""
    return pairs.where(F.col("marker").isin("write", "both"))


def replace_relays(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """The relay table after the lists of some keys (pubkey_id, pos, url, marker, seen_at) replaced theirs whole."""
    keys = incoming.select("pubkey_id").distinct()
    new = first_markers(incoming, "pubkey_id").select(*current.columns)
    return current.join(keys, "pubkey_id", "left_anti").select(*current.columns).unionByName(new)
