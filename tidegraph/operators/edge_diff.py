"""New lists applied as minimal edge diffs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def diff(new: DataFrame, current: DataFrame) -> DataFrame:
    """(follower_id, followee_id, op): edges to add and to remove.  One full join does both differences in one shuffle."""
    key = ["follower_id", "followee_id"]
    a = new.where("follower_id <> followee_id").select(*key).distinct().withColumn("__new", F.lit(1))
    b = current.select(*key).withColumn("__old", F.lit(1))
    return a.join(b, key, "full").where("__new is null or __old is null").select(*key, F.when(F.col("__old").isNull(), "added").otherwise("removed").alias("op"))


def diff_by_lists(lists: DataFrame) -> DataFrame:
    """(author, followee, op) between each list (author, created_at, id, followees) and the one before it, rank by rank."""
    w = Window.partitionBy("author").orderBy("created_at", "id")
    before = F.coalesce(F.lag("followees").over(w), F.array().cast("array<long>"))
    pairs = lists.withColumn("__before", before)
    added = pairs.select("author", "id", F.explode(F.array_except("followees", "__before")).alias("followee"), F.lit("added").alias("op"))
    removed = pairs.select("author", "id", F.explode(F.array_except("__before", "followees")).alias("followee"), F.lit("removed").alias("op"))
    return added.unionByName(removed)


def churn(lists: DataFrame) -> DataFrame:
    """author, fetch_count, change_count, last_changed_at, applied_id after its lists were applied in order.

    Every list counts as a fetch; a change counts only if the set differs from the one
    before (the first from the empty one).  A list with the id applied just before only
    confirms.
    """
    w = Window.partitionBy("author").orderBy("created_at", "id")
    now = F.array_sort(F.array_distinct("followees"))
    marked = lists.withColumn("__now", now).withColumn("__before", F.lag(now).over(w))
    changed = F.coalesce(~F.col("__now").eqNullSafe(F.col("__before")), F.lit(True)) & ~(F.col("__before").isNull() & (F.size("__now") == 0))
    marked = marked.withColumn("__changed", changed)
    return marked.groupBy("author").agg(
        F.count(F.lit(1)).alias("fetch_count"),
        F.count_if("__changed").alias("change_count"),
        F.max(F.when(F.col("__changed"), F.col("created_at"))).alias("last_changed_at"),
        F.max(F.struct("created_at", "id")).getField("id").alias("applied_id"),
    )


def changes(state: DataFrame, edges_of: Callable[[DataFrame], DataFrame], lists: DataFrame, as_of, guard_stale: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What at most one list (id, event_id, created_at, followee_ids) per follower changes: (state rows, new edges, touched followers).

    `edges_of` gives the present edges of some followers (follower_id), so that no others
    are read.  A touched follower's edges become the new ones.  A list whose event is
    applied already only confirms, and so is dropped before its tags are exploded.  An
    older event with another id replaces newer edges, unless guard_stale asks that it
    only confirm as well.
    """
    now = F.lit(as_of)
    heads = lists.select("id", F.col("event_id").alias("__event"), F.col("created_at").alias("__created"))
    known = state.join(heads, "id")
    same = F.col("applied_event_id").eqNullSafe(F.col("__event"))
    if guard_stale:
        same = same | F.coalesce(F.col("applied_created_at") > F.col("__created"), F.lit(False))
    known = known.withColumn("__apply", ~same)
    touched = known.where("__apply").select(F.col("id").alias("follower_id"))
    fresh = lists.join(touched, lists["id"] == touched["follower_id"], "left_semi")
    new = fresh.select(F.col("id").alias("follower_id"), F.explode("followee_ids").alias("followee_id")).where("follower_id <> followee_id").distinct()
    moved_ids = diff(new, edges_of(touched)).select(F.col("follower_id").alias("id")).distinct().withColumn("__moved", F.lit(True))
    s = known.join(moved_ids, "id", "left")
    moved = F.coalesce("__moved", F.lit(False))
    out = {
        "status": F.lit("fetched"),
        "last_fetched_at": now,
        "last_confirmed_at": now,
        "last_changed_at": F.when(moved, now).otherwise(F.col("last_changed_at")),
        "fetch_count": F.col("fetch_count") + 1,
        "change_count": F.col("change_count") + moved.cast("long"),
        "applied_event_id": F.when(F.col("__apply"), F.col("__event")).otherwise(F.col("applied_event_id")),
        "applied_created_at": F.when(F.col("__apply"), F.col("__created")).otherwise(F.col("applied_created_at")),
    }
    return s.select(*[out.get(c, F.col(c)).cast(state.schema[c].dataType).alias(c) for c in state.columns]), new, touched


def apply_lists(state: DataFrame, follows: DataFrame, lists: DataFrame, as_of, guard_stale: bool = False) -> tuple[DataFrame, DataFrame]:
    """(state, follows) whole, after `changes`."""
    rows, new, touched = changes(state, lambda who: follows.join(who, "follower_id", "left_semi"), lists, as_of, guard_stale)
    rest = state.join(lists.select("id"), "id", "left_anti").select(*state.columns)
    return rest.unionByName(rows), follows.join(touched, "follower_id", "left_anti").select("follower_id", "followee_id").unionByName(new)
