"""Streams: newest-wins upserts of event batches, and per-source health with bounded state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.scalars import notice_class
from ..operators.signals import ALPHA, routed
from ..operators.tags import FOLLOW_CAP
from ..plans.ingest import follow_lists, list_changes
from ..store import Store, settled

_STATE = "score double, n long"


def stream_health(samples: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """(source, score, n) after each micro-batch's samples (source, ts, seq, sample); the state is two numbers a source."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        score, n = state.get if state.exists else (1.0, 0)
        rows = pd.concat(list(batches)).sort_values(["ts", "seq"])
        for x in rows["sample"].tolist():
            score = score * (1.0 - alpha) + alpha * x
            n += 1
        state.update((score, n))
        yield pd.DataFrame({"source": [key[0]], "score": [score], "n": [n]})

    health = f"source {samples.schema['source'].dataType.simpleString()}, score double, n long"
    return samples.groupBy("source").applyInPandasWithState(update, health, _STATE, "update", GroupStateTimeout.NoTimeout)


def ingest_batch(store: Store, events: DataFrame, requested: DataFrame, as_of: int, cap: int = FOLLOW_CAP) -> None:
    """One micro-batch of signed events into the store's next version."""
    lists = settled(follow_lists(events, requested, as_of, cap=cap), "lists")
    if not lists.isEmpty():
        store.update(lambda base: list_changes(base, lists, as_of))


def stream_notices(notices: DataFrame) -> DataFrame:
    """A stream of relays' notices (relay_url, ts, seq, message) as samples and failures, for `stream_health` and the counters."""
    return routed(notices.select(F.col("relay_url").alias("source"), "ts", "seq", notice_class(F.col("message")).alias("kind")))


def run(events: DataFrame, store: Store, requested: DataFrame, checkpoint: str, clock: Callable[[], int], **trigger) -> StreamingQuery:
    """Applies a stream of signed events batch by batch.

    Within a batch the newest list wins; an event that was applied before only confirms,
    so a batch that is run again after a failure changes nothing.
    """

    def apply(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            ingest_batch(store, batch, requested, clock())

    return events.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
