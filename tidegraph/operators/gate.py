"""From untrusted events to the newest valid list of each author.

The order is part of the meaning: verify, then kind and author, then one copy of an
id, then the clamp, then newest wins.  Were ids made distinct first, a forged copy
could stand for the genuine event.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..deploy import ship
from ..functions.scalars import saturating_add
from ..functions.schnorr import valid_events
from ..store import settled

#: Seconds that an event may lie in the future (a fixed value).
FUTURE_CLAMP = 3600


def with_signature_check(events: DataFrame, name: str = "valid") -> DataFrame:
    """events and whether id and signature hold.

    The only Python in the pipeline, signatures in batches.  Equal rows (one event from
    many relays) are verified once: grouping by all columns but the relay is safe before verification,
    and each copy comes back with the verdict.
    """
    ship(events.sparkSession)
    columns, own = events.columns, [c for c in events.columns if c != "relay_url"]
    if "relay_url" in columns:
        # structs, as a list of the relays alone would lose the null ones
        events = events.groupBy(*own).agg(F.collect_list(F.struct("relay_url")).getField("relay_url").alias("__relays"))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            events = b[own].to_dict("records")
            b[name] = valid_events(events)
            yield b

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in events.schema.fields)
    # few bytes are much work here: dealt over all cores, not by size
    checked = events.repartition(events.sparkSession.sparkContext.defaultParallelism).mapInPandas(check, f"{fields}, `{name}` boolean")
    if "relay_url" in columns:
        checked = checked.withColumn("relay_url", F.explode("__relays")).select(*columns, name)
    return checked


def verified(events: DataFrame) -> DataFrame:
    return with_signature_check(events).where("valid").drop("valid")


def solicited(events: DataFrame, requested: DataFrame, kind) -> DataFrame:
    """Events of this kind by a requested author (requested: author).  Spark broadcasts the authors only if they are small."""
    return events.where(F.col("kind") == kind).join(requested.select("author").distinct(), "author", "left_semi")


def distinct_ids(events: DataFrame) -> DataFrame:
    """One copy of each id; only after verification."""
    return events.dropDuplicates(["id"])


def not_future(events: DataFrame, as_of: int, clamp: int = FUTURE_CLAMP) -> DataFrame:
    """Events dated at most `clamp` seconds after as_of, which itself may be any second."""
    return events.where(F.col("created_at") <= saturating_add(F.lit(as_of).cast("long"), F.lit(clamp).cast("long")))


def newest_wins(events: DataFrame, *by: str) -> DataFrame:
    """Of each author the newest event, of equally new ones the smallest id.

    A ranking filtered to 1 keeps one row per author and map task before the shuffle
    (a group limit in the plan), so a very active author doesn't meet in one task.
    """
    w = Window.partitionBy(*(by or ("author",))).orderBy(F.desc("created_at"), F.asc("id"))
    return events.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def resolve(events: DataFrame, requested: DataFrame, kind, as_of: int, clamp: int = FUTURE_CLAMP) -> DataFrame:
    """The winner of each requested author among verified events.

    Distinct ids need no shuffle of their own here: copies of one event tie in every
    ordering column, and the ranking keeps one of them.
    """
    return newest_wins(not_future(solicited(events, requested, kind), as_of, clamp))


def resolve_unverified(events: DataFrame, requested: DataFrame, kind, as_of: int, clamp: int = FUTURE_CLAMP, tally: Callable[[str, int], None] | None = None) -> DataFrame:
    """The winner of each requested author among events (author, ..., sig) whose signatures aren't checked yet.

    Signatures are the dear part, so what can't win isn't verified: unsolicited and future
    events go first, equal events of many relays are one, and of each author the newest is
    checked.  Only where that fails are the author's other events.  `tally` gets how many
    events were rejected and why; an unsolicited one counts as that, forged or not.
    """
    wanted = not_future(solicited(events, requested, kind), as_of, clamp)
    if tally:
        counts = reject_counts(events.withColumn("valid", F.lit(True)), requested, kind, as_of, clamp).where("reason <> 'accepted'").collect()  # at most two rows
        for r in counts:
            tally(r["reason"], r["n"])
    own = [c for c in events.columns if c != "relay_url"]
    w = Window.partitionBy("author").orderBy(F.desc("created_at"), F.asc("id"))
    ranked = wanted.select(*own).distinct().withColumn("__rank", F.row_number().over(w))

    def checked(rows: DataFrame) -> DataFrame:
        return with_signature_check(rows.withColumnRenamed("author", "pubkey")).withColumnRenamed("pubkey", "author")

    first = settled(checked(ranked.where("__rank = 1")), "newest")
    bad = first.where("not valid").select("author")
    found = first.where("valid").select(*own)
    if not bad.isEmpty():
        rest = settled(checked(ranked.where("__rank > 1").join(bad, "author", "left_semi")), "older")
        found = found.unionByName(newest_wins(rest.where("valid").select(*own)))
        if tally:
            tally("invalid_signature", bad.count() + rest.where("not valid").count())
    return found


def reject_reason(valid: Column, wanted: Column, as_of: int, clamp: int = FUTURE_CLAMP) -> Column:
    """Why an event is rejected, null if it isn't; a forged and unsolicited one counts as forged."""
    limit = saturating_add(F.lit(as_of).cast("long"), F.lit(clamp).cast("long"))
    return F.when(~valid, "invalid_signature").when(~wanted, "unsolicited").when(F.col("created_at") > limit, "future_dated")


def reject_counts(events: DataFrame, requested: DataFrame, kind, as_of: int, clamp: int = FUTURE_CLAMP) -> DataFrame:
    """reason and n over all events (columns valid, kind, author, created_at); accepted ones count too."""
    marked = events.join(requested.select("author").distinct().withColumn("__asked", F.lit(True)), "author", "left")
    wanted = (F.col("kind") == kind) & F.coalesce("__asked", F.lit(False))
    reason = F.coalesce(reject_reason(F.col("valid"), wanted, as_of, clamp), F.lit("accepted"))
    return marked.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))
