"""Paging of newest-first sources: pages, chunks, and when a scan must fail."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGES = 10_000
AUTHORS_PER_REQUEST = 500


class Stalled(RuntimeError):
    """A second holds as many events as a page, so older ones can't be reached."""


def page(events: DataFrame, until, cap: int) -> DataFrame:
    """The newest `cap` events at or before `until`."""
    return events.where(F.col("created_at") <= until).orderBy(F.desc("created_at"), "id").limit(cap)


def progress(pages: DataFrame) -> DataFrame:
    """(page, returned, distinct_ids, oldest) of pages (page, id, created_at)."""
    return pages.groupBy("page").agg(F.count("id").alias("returned"), F.countDistinct("id").alias("distinct_ids"), F.min("created_at").alias("oldest"))


def chunks(authors: DataFrame, size: int = AUTHORS_PER_REQUEST) -> DataFrame:
    """(author, chunk): runs of at most `size` authors in their order, numbered without a global sort in one task."""
    from .dictionary import numbered

    return numbered(authors, "author").select("author", F.floor((F.col("id") - 1) / size).cast("long").alias("chunk"))


def stalls(events: DataFrame, cap: int) -> DataFrame:
    """(chunk, status, events): a chunk's scan is requeued if one second holds `cap` or more events, else complete.

    The closed form of the paging loop below: two partial aggregates, no paging.
    """
    seconds = events.groupBy("chunk", "created_at").agg(F.count(F.lit(1)).alias("__n"))
    return seconds.groupBy("chunk").agg(F.when(F.max("__n") >= cap, "requeue").otherwise("complete").alias("status"), F.sum("__n").alias("events"))


def scanned(fetch: Callable[[int], list[tuple[int, object, object]]], start: int, cap: int, most: int = PAGES) -> Iterable[object]:
    """Distinct events of one source; fetch(until) gives a page of (created_at, id, event), newest first.

    A full page means that older events may follow, from its oldest second on (which
    comes again, as it may be cut).  A full page without a new id can't go on.
    """
    seen: set[object] = set()
    until = start
    for _ in range(most):
        rows = fetch(until)
        new = [r for r in rows if r[1] not in seen]
        for r in new:
            if r[1] not in seen:
                seen.add(r[1])
                yield r[2]
        if len(rows) < cap or not rows:
            return
        oldest = min(r[0] for r in rows)
        if not new:
            raise Stalled(f"{len(rows)} events at second {oldest}")
        until = oldest
    raise Stalled(f"more than {most} pages")
