"""The crawl: claim, scan, resolve, apply, until nothing is left to claim.

A wave is one job over all claimed authors.  The order inside a wave doesn't matter, as
each author's list depends on its own events only; so waves can be as wide as the
cluster allows.  What fails is smaller: a wave's authors are in batches, and a source
that fails costs the batches it was asked for.  A wave commits only the rows it changes.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import fallback as fb
from ..operators import frontier, gate, tags
from ..operators.metrics import Registry
from ..schemas import KIND_FOLLOWS, KIND_RELAYS
from ..sources import relay as R
from ..store import Snapshot, Store, settled
from .fleet import Fleet
from .ingest import list_changes, new_vertices, relay_changes, relay_lists

log = logging.getLogger(__name__)

#: Scans authors (author, batch) and returns events, or SCANNED rows that say how each fetch went; raises SourceError if all failed.
Scan = Callable[[DataFrame], DataFrame]
#: Authors that are claimed at once, and authors of a batch (the latter a fixed value).
WAVE, BATCH = 65_536, 64


class SourceError(RuntimeError):
    """A scan failed for all it was asked."""


@dataclass
class Stats:
    reclaimed: int = 0
    claimed: int = 0
    waves: int = 0
    batches: int = 0


@dataclass(frozen=True)
class Sources:
    """`lists` scans follow lists; the others serve the fallback, if it is on.

    `write_relays` scans (author, url) pairs, `relay_lists` scans relay lists of authors;
    `scores` gives (source, score); `record` takes the fetches of `lists`.
    """

    lists: Scan
    write_relays: Scan | None = None
    relay_lists: Scan | None = None
    scores: Callable[[], DataFrame] | None = None
    record: Callable[[DataFrame], None] | None = None


def sources_of(fleet: Fleet, clock: Callable[[], float] = time.time) -> Sources:
    """A fleet's relays as sources.  The fallback's scans ask all of them and write relays, and aren't recorded."""

    def write_relays(asked: DataFrame) -> DataFrame:
        known = {r.url: r.max_limit for r in fleet.relays.values()}
        limits = F.create_map(*[F.lit(x) for pair in known.items() for x in pair]) if known else F.create_map().cast("map<string,int>")
        return R.scan(asked.withColumn("max_limit", F.try_element_at(limits, F.col("url"))), fleet.connect, KIND_FOLLOWS, int(clock()), fleet.timeout)

    return Sources(lambda authors: fleet.scan(authors, KIND_FOLLOWS, clock()), write_relays, lambda authors: fleet.scan(authors, KIND_RELAYS, clock(), every=True), fleet.scores, fleet.record)


def _scanned(scan: Scan, asked: DataFrame, name: str) -> tuple[DataFrame, DataFrame | None]:
    """(events, fetches) of a scan, which runs once; fetches only if it tells."""
    found = settled(scan(asked), name)
    if "status" not in found.columns:
        return found, None
    events = [f.split()[0] for f in R.SCANNED.split(", ")[:8]]
    return found.where("status is null").select(*events, "batch"), found.where("status is not null").select("relay_url", "batch", "chunk", "status", "began", "seconds", "notices")


def _failed(fetches: DataFrame | None, asked: DataFrame) -> DataFrame:
    """(author) of the batches that a source failed."""
    if fetches is None:
        return asked.select("author").limit(0)
    return asked.join(fetches.where("status <> 'success'").select("batch").distinct(), "batch", "left_semi").select("author")


def batched(authors: DataFrame, size: int = BATCH) -> DataFrame:
    """A wave's authors (id, author) with their batch, runs of `size` by id; a wave is bounded, so one task can number it."""
    return authors.withColumn("batch", F.floor((F.row_number().over(Window.orderBy("id")) - 1) / size).cast("long"))


def seed(store: Store, anchor: bytes) -> Snapshot:
    """The store with the anchor as a vertex; nothing is written if it is one."""
    store.bootstrap()

    def missing(base: Snapshot) -> dict:
        if not base.pubkeys.where(F.col("pubkey") == F.lit(anchor)).isEmpty():
            return {}
        return {"pubkeys": new_vertices(base.pubkeys, store.spark.createDataFrame([(anchor,)], "pubkey binary"))}

    return store.update(missing)


def recovered(base: Snapshot, missed: DataFrame, sources: Sources, as_of: int, cap: int, k: int) -> tuple[DataFrame, tuple[DataFrame, DataFrame] | None]:
    """Lists of missed authors (id, author) from their write relays, and what new relay lists change.

    Authors without a known write relay are looked up first.  A scan that fails counts as
    a miss and costs no attempt.
    """
    spark = missed.sparkSession
    none, table = spark.createDataFrame([], "author binary, id binary, created_at long, followees array<binary>"), None
    relays = base.of_keys("pubkey_relays", missed.select("id"))
    known = tags.write_relays(relays).select(F.col("pubkey_id").alias("id")).distinct()
    unknown = settled(missed.join(known, "id", "left_anti").select("author", F.col("id").alias("batch")), "unknown")
    try:
        if sources.relay_lists and not unknown.isEmpty():
            events, fetches = _scanned(sources.relay_lists, unknown, "relay-list-events")
            heard = unknown.join(_failed(fetches, unknown), "author", "left_anti")
            found = settled(relay_lists(events, heard, as_of), "relay-lists")
            if not found.isEmpty():
                rows, keys = relay_changes(base, found)
                table = settled(rows, "relays"), settled(keys, "relay-keys")
                relays = relays.join(table[1], "pubkey_id", "left_anti").select(*relays.columns).unionByName(table[0])
        named = relays.join(missed, relays["pubkey_id"] == missed["id"]).select("author", "url", "marker")
        scores = sources.scores() if sources.scores else spark.createDataFrame([], "source string, score double")
        best = fb.best_relays(named, scores, k).join(missed, "author").select("author", "url", F.col("id").alias("batch"))
        asked = settled(best, "asked")
        if asked.isEmpty():
            return none, table
        events, fetches = _scanned(sources.write_relays, asked, "recovered-events")
        heard = missed.join(_failed(fetches, asked), "author", "left_anti").select("author")
        return settled(gated(events, heard, as_of, cap=cap), "recovered"), table
    except SourceError as e:
        log.warning("fallback: %s", e)
        return none, table


def gated(events: DataFrame, authors: DataFrame, as_of: int, clamp: int = gate.FUTURE_CLAMP, cap: int = tags.FOLLOW_CAP, metrics: Registry | None = None) -> DataFrame:
    """(author, id, created_at, followees) of authors with a valid list within the cap; what was rejected is counted."""
    tally = (lambda reason, n: metrics.count(f"ingest_{reason}", n)) if metrics else None
    rows = gate.resolve_unverified(events.drop("batch").withColumnRenamed("pubkey", "author"), authors, KIND_FOLLOWS, as_of, clamp, tally)
    winners = rows.select("author", "id", "created_at", tags.followees(F.col("tags"), F.col("author")).alias("followees"))
    if metrics:
        winners = settled(winners, "winners")
        metrics.count("ingest_oversized_follow_list", tags.oversized(winners, cap).count())
    return tags.within_cap(winners, cap)


def wave(store: Store, claimed: DataFrame, sources: Sources, as_of: int, cap: int = tags.FOLLOW_CAP, most: int = frontier.MAX_ATTEMPTS, k: int = fb.MAX_WRITE_RELAYS, clamp: int = gate.FUTURE_CLAMP, metrics: Registry | None = None) -> Snapshot:
    """Resolves the claimed authors (id, author, batch) and commits what came of it, on top of whatever was committed meanwhile."""
    now = F.timestamp_seconds(F.lit(as_of))
    asked = claimed.select("author", "batch")
    try:
        events, fetches = _scanned(sources.lists, asked, "events")
        if fetches is not None and sources.record:
            sources.record(fetches)
        failed = settled(claimed.join(_failed(fetches, asked), "author", "left_semi").select("id", "author"), "failed")
    except SourceError as e:
        log.warning("scan: %s", e)
        events, failed = None, claimed.select("id", "author")
    found = None
    if events is not None:
        heard = settled(claimed.select("id", "author").join(failed, "id", "left_anti"), "heard")
        found = settled(gated(events, heard, as_of, clamp, cap, metrics), "lists")
        missed = settled(heard.join(found.select("author"), "author", "left_anti").select("id", "author"), "missed")

    def resolved(base: Snapshot) -> dict:
        mine = settled(base.of_keys("pubkeys", claimed.select("id")), "claimed-rows")
        changed, changes = [frontier.requeue_or_fail(mine, failed, now, most, only=True)], {}
        if found is not None:
            lists = found
            if sources.write_relays and not missed.isEmpty():
                more, relays = recovered(base, missed, sources, as_of, cap, k)
                if relays:
                    changes["pubkey_relays"] = relays
                if metrics:
                    metrics.count("nip65_recovered", more.count())
                lists = settled(lists.unionByName(more), "lists")
            if not lists.isEmpty():
                of_lists = list_changes(base, lists, as_of)
                changes["follows"] = of_lists["follows"]
                changed.append(of_lists["pubkeys"])
            absent = missed.join(lists.select("author"), "author", "left_anti").select("id", F.lit("not_found").alias("status"))
            changed.append(frontier.set_status(mine, absent, now, only=True))
        return changes | {"pubkeys": reduce(DataFrame.unionByName, changed)}

    return store.update(resolved)


def reclaimed_at_start(store: Store) -> int:
    """Puts back what an earlier run had claimed; how many."""
    n = store.current().pubkeys.where("status = 'in_progress'").count()
    if n:
        store.update(lambda base: {"pubkeys": frontier.reclaim_at_start(base.pubkeys, only=True)})
    return n


def claim_wave(store: Store, n: int, size: int, now: int) -> DataFrame | None:
    """(id, author, batch) of up to n authors that this call claimed, none of them another's; None if there is nothing to claim."""
    mine: list[DataFrame] = []

    def take(base: Snapshot) -> dict:
        mine[:] = [settled(batched(frontier.claimable(base.pubkeys, n).select("id", F.col("pubkey").alias("author")), size), "claimed")]
        if mine[0].isEmpty():
            return {}
        rows = base.pubkeys.join(mine[0].select("id"), "id", "left_semi").withColumns({"status": F.lit("in_progress"), "claimed_at": F.timestamp_seconds(F.lit(now))})
        return {"pubkeys": rows}

    store.update(take)
    return None if mine[0].isEmpty() else mine[0]


def crawl(store: Store, anchor: bytes, sources: Sources, clock: Callable[[], int] = lambda: int(time.time()), width: int = WAVE, batch: int = BATCH, stop: Callable[[], bool] = lambda: False, reclaim: bool = True, **options) -> Stats:
    """Crawls everything reachable from the anchor.  Claims left by an earlier run are put back first; `stop` is heeded between waves."""
    stats = Stats()
    seed(store, anchor)
    if reclaim:
        stats.reclaimed = reclaimed_at_start(store)
    while not stop():
        now = clock()
        claimed = claim_wave(store, width, batch, now)
        if claimed is None:
            break
        wave(store, claimed, sources, now, **options)
        n = claimed.count()
        stats.claimed += n
        stats.waves += 1
        stats.batches += -(-n // batch)
    return stats


def reenqueue_stale(store: Store, as_of: int, ttl_seconds: int) -> int:
    """Puts back what was fetched too long ago; how many."""
    now = F.timestamp_seconds(F.lit(as_of))
    return _put_back(store, lambda base: frontier.reclaim_by_ttl(base.pubkeys, now, ttl_seconds, only=True))


def reclaim_leases(store: Store, as_of: int, lease_seconds: int) -> int:
    """Puts back what was claimed too long ago; how many."""
    now = F.timestamp_seconds(F.lit(as_of))
    return _put_back(store, lambda base: frontier.reclaim_expired(base.pubkeys, now, lease_seconds, only=True))


def _put_back(store: Store, rows_of: Callable[[Snapshot], DataFrame]) -> int:
    n = 0

    def change(base: Snapshot) -> dict:
        nonlocal n
        rows = settled(rows_of(base), "put-back")
        n = rows.count()
        return {"pubkeys": rows} if n else {}

    store.update(change)
    return n
