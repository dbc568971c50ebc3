"""The crawl frontier as a status column: claims, leases, retries, freshness, and its monitoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import age_seconds
from ..schemas import STATUSES, TERMINAL

MAX_ATTEMPTS = 3
#: Upper bounds in seconds of the histograms' buckets (fixed values).
FETCH_BUCKETS = (0.1, 0.25, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0)
AGE_BUCKETS = (300.0, 900.0, 3600.0, 21600.0, 43200.0, 86400.0, 172800.0, 259200.0, 604800.0)


def _changed(state: DataFrame, where: Column, only: bool = False, **to: Column) -> DataFrame:
    rows = state.where(where) if only else state
    return rows.select(*[F.when(where, to[c]).otherwise(F.col(c)).cast(state.schema[c].dataType).alias(c) if c in to else F.col(c) for c in state.columns])


# Transitions give the whole state, or with `only` just the rows that change, as a store's commit wants them.


def claimable(state: DataFrame, n: int) -> DataFrame:
    """The n discovered rows of smallest id, as a top-k (no full sort)."""
    return state.where("status = 'discovered'").orderBy("id").limit(n)


def claim(state: DataFrame, n: int, now: Column, only: bool = False) -> DataFrame:
    """state after n rows were claimed."""
    ids = claimable(state, n).select("id", F.lit(True).alias("__mine"))
    mine = F.coalesce(F.col("__mine"), F.lit(False))
    return _changed(state.join(ids, "id", "left"), mine, only, status=F.lit("in_progress"), claimed_at=now).select(*state.columns)


def set_status(state: DataFrame, outcomes: DataFrame, now: Column, only: bool = False) -> DataFrame:
    """state with the status of outcomes (id, status) and a stamp; leases and attempts stay."""
    got = outcomes.select("id", F.col("status").alias("__to"))
    return _changed(state.join(got, "id", "left"), F.col("__to").isNotNull(), only, status=F.col("__to"), last_fetched_at=now).select(*state.columns)


def _reclaimed(state: DataFrame, where: Column, only: bool) -> DataFrame:
    return _changed(state, F.coalesce(where, F.lit(False)), only, status=F.lit("discovered"), claimed_at=F.lit(None), fetch_attempts=F.lit(0))


def reclaim_at_start(state: DataFrame, only: bool = False) -> DataFrame:
    return _reclaimed(state, F.col("status") == "in_progress", only)


def stale(as_of: Column, ttl_seconds: int) -> Column:
    """Terminal rows last fetched before as_of - ttl; a missing stamp never counts."""
    return F.col("status").isin(*TERMINAL) & (F.col("last_fetched_at") < as_of - F.make_interval(secs=F.lit(ttl_seconds)))


def reclaim_by_ttl(state: DataFrame, as_of: Column, ttl_seconds: int, only: bool = False) -> DataFrame:
    return _reclaimed(state, stale(as_of, ttl_seconds), only)


def expired_lease(as_of: Column, age_seconds_: int) -> Column:
    return (F.col("status") == "in_progress") & (F.col("claimed_at") < as_of - F.make_interval(secs=F.lit(age_seconds_)))


def reclaim_expired(state: DataFrame, as_of: Column, age_seconds_: int, only: bool = False) -> DataFrame:
    return _reclaimed(state, expired_lease(as_of, age_seconds_), only)


def requeue_or_fail(state: DataFrame, ids: DataFrame, now: Column, most: int = MAX_ATTEMPTS, only: bool = False) -> DataFrame:
    """state after the fetch of these ids failed once more: at `most` attempts they fail and are stamped, else they wait."""
    hit = ids.select("id").distinct().withColumn("__hit", F.lit(True))
    attempts = F.col("fetch_attempts") + 1
    over = attempts >= most
    to = {"status": F.when(over, "failed").otherwise("discovered"), "last_fetched_at": F.when(over, now).otherwise(F.col("last_fetched_at")), "claimed_at": F.lit(None), "fetch_attempts": attempts}
    return _changed(state.join(hit, "id", "left"), F.coalesce("__hit", F.lit(False)), only, **to).select(*state.columns)


def affected(before: DataFrame, after: DataFrame) -> DataFrame:
    """How many rows a transition changed."""
    a = before.select("id", F.struct(*[c for c in before.columns if c != "id"]).alias("__a"))
    b = after.select("id", F.struct(*[c for c in before.columns if c != "id"]).alias("__b"))
    return a.join(b, "id", "full").agg(F.count_if(~F.col("__a").eqNullSafe(F.col("__b"))).alias("affected"))


def counts(state: DataFrame) -> DataFrame:
    """One row: rows by status, their total (with unknown statuses) and the fetched share, 0 if there are none."""
    total = F.count(F.lit(1))
    fetched = F.count_if(F.col("status") == "fetched")
    coverage = F.when(total == 0, F.lit(0.0)).otherwise(fetched / total).alias("coverage")
    return state.agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATUSES], total.alias("total"), coverage)


def stalest(state: DataFrame, as_of: Column, n: int = 1000) -> DataFrame:
    """(id, age) of the n terminal rows fetched longest ago."""
    rows = state.where(F.col("status").isin(*TERMINAL) & F.col("last_fetched_at").isNotNull())
    return rows.orderBy("last_fetched_at", "id").limit(n).select("id", age_seconds(as_of, F.col("last_fetched_at")).alias("age"))


def histogram(values: DataFrame, name: str, bounds: tuple[float, ...] = AGE_BUCKETS, *by: str) -> DataFrame:
    """(by, le, n): cumulative counts, one pass; the last bound is infinity."""
    parts = [F.struct(F.lit(float(b)).alias("le"), F.count_if(F.col(name) <= float(b)).alias("n")) for b in bounds]
    parts.append(F.struct(F.lit(float("inf")).alias("le"), F.count(name).alias("n")))
    return values.groupBy(*by).agg(F.array(*parts).alias("__b")).select(*by, F.explode("__b").alias("__b")).select(*by, "__b.le", "__b.n")
