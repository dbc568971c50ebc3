"""Per-source signals: health, quota, backoff, probing, admission.

Each is an ordered fold over one source's samples.  A long history is cut by time into
chunks of about `CHUNK` rows, over all sources, so that no source's rows meet in one task:
chunks are folded side by side, and what they come to is put together in their order.
Only probing, whose steps hang on each other, folds a source whole; for histories without
a bound it has the streaming form, whose state is a few numbers a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import backoff
from ..store import settled

#: Defaults (fixed values): weight of a new sample, routing threshold, seconds between probes, fetches at once.
ALPHA, THRESHOLD, PROBE_SECONDS, PER_SOURCE = 0.3, 0.25, 60, 4
REQUESTS_PER_SECOND = 4


#: Rows of a chunk.
CHUNK = 200_000


def _chunked(rows: DataFrame, order: str = "ts") -> tuple[DataFrame, int]:
    """rows with the chunk of each (numbered by time, equal times together), and how many chunks there are at most."""
    parts = -(-rows.count() // CHUNK)
    if parts <= 1:
        return rows.withColumn("__chunk", F.lit(0)), 1
    return settled(rows.repartitionByRange(parts, order).withColumn("__chunk", F.spark_partition_id()), "chunks"), parts


def _ordered(*value: str) -> Column:
    return F.array_sort(F.collect_list(F.struct("ts", "seq", *value)))


def health(samples: DataFrame, alpha: float = ALPHA, before: DataFrame | None = None) -> DataFrame:
    """(source, score, n): exponentially weighted mean of samples (source, ts, seq, sample), from 1 or from the score of `before`."""
    keep = 1.0 - alpha
    chunked, _ = _chunked(samples)
    rows = chunked.groupBy("source", "__chunk").agg(_ordered("sample").alias("__s"))
    start = F.lit(1.0)
    if before is not None:
        rows, start = rows.join(before.select("source", F.col("score").alias("__start")), "source", "left"), F.coalesce("__start", F.lit(1.0))

    def fold(first: Column) -> Column:
        return F.aggregate(F.transform("__s", lambda e: e["sample"]), first, lambda a, x: a * F.lit(keep) + F.lit(alpha) * x)

    # the first chunk from the start; what a later one leaves of the score before it, and what it adds
    part = F.struct("__chunk", fold(start).alias("first"), F.pow(F.lit(keep), F.size("__s")).alias("left"), fold(F.lit(0.0)).alias("more"), F.size("__s").cast("long").alias("n"))
    parts = rows.groupBy("source").agg(F.array_sort(F.collect_list(part)).alias("__p"))  # one entry a chunk
    later = F.aggregate(F.slice("__p", 2, F.size("__p")), F.get("__p", F.lit(0))["first"], lambda a, c: a * c["left"] + c["more"])
    return parts.select("source", later.alias("score"), F.aggregate("__p", F.lit(0).cast("long"), lambda a, c: a + c["n"]).alias("n"))


def quota(requests: DataFrame, per_second: int = REQUESTS_PER_SECOND, burst: int | None = None, step: int | None = None) -> DataFrame:
    """(source, admitted, waited_us, n): a generic cell rate limiter over requests (source, ts in microseconds, seq).

    A request comes due `step` microseconds after the one before; `burst` of them may come early.
    """
    step = step or 1_000_000 // per_second
    room = step * (burst or per_second)
    zero = F.struct(F.lit(0).cast("long").alias("tat"), F.lit(0).cast("long").alias("admitted"), F.lit(0).cast("long").alias("waited"))

    def one(a: Column, t: Column) -> Column:
        early = a["tat"] - F.lit(room) - t
        return F.struct(
            (F.greatest(a["tat"], t) + F.lit(step)).alias("tat"),
            (a["admitted"] + F.when(early <= 0, F.lit(1)).otherwise(F.lit(0))).cast("long").alias("admitted"),
            (a["waited"] + F.greatest(F.lit(0).cast("long"), early)).alias("waited"),
        )

    times = F.transform("__s", lambda e: e["ts"])
    chunked, parts = _chunked(requests)
    rows = chunked.groupBy("source", "__chunk").agg(_ordered().alias("__s"))
    if parts == 1:
        found = rows.select("source", F.aggregate(times, zero, one).alias("q"), F.size("__s").cast("long").alias("n"))
    else:
        # when a chunk's requests come due, told from the last due time before it: first without it, then with it
        rows = settled(rows, "requests")
        alone = rows.select("source", F.struct("__chunk", F.aggregate(times, F.lit(0).cast("long"), lambda a, t: F.greatest(a, t) + F.lit(step)).alias("tat"), F.size("__s").cast("long").alias("n")).alias("c"))
        last = lambda a: F.coalesce(F.try_element_at(a, F.lit(-1))["next"], F.lit(0).cast("long"))
        none = F.array().cast("array<struct<chunk:int,tat:long,next:long>>")
        steps = F.aggregate("__p", none, lambda a, c: F.concat(a, F.array(F.struct(c["__chunk"].alias("chunk"), last(a).alias("tat"), F.greatest(last(a) + c["n"] * step, c["tat"]).alias("next")))))
        due = alone.groupBy("source").agg(F.array_sort(F.collect_list("c")).alias("__p")).select("source", F.explode(steps).alias("c")).select("source", F.col("c.chunk").alias("__chunk"), F.col("c.tat").alias("__tat"))
        start = F.struct(F.col("__tat").alias("tat"), F.lit(0).cast("long").alias("admitted"), F.lit(0).cast("long").alias("waited"))
        each = rows.join(due, ["source", "__chunk"]).select("source", F.aggregate(times, start, one).alias("q"), F.size("__s").cast("long").alias("n"))
        found = each.groupBy("source").agg(F.struct(F.sum("q.admitted").alias("admitted"), F.sum("q.waited").alias("waited")).alias("q"), F.sum("n").alias("n"))
    return found.select("source", F.col("q.admitted").alias("admitted"), F.col("q.waited").alias("waited_us"), "n")


def failures(signals: DataFrame) -> DataFrame:
    """signals (source, ts, seq, failed, reset) and how many failures came since the last reset, this one included."""
    chunked, parts = _chunked(signals)
    order = Window.partitionBy("source", "__chunk").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    island = chunked.withColumn("__island", F.sum(F.col("reset").cast("int")).over(order))
    within = Window.partitionBy("source", "__chunk", "__island").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    counted = island.withColumn("failures", F.sum(F.col("failed").cast("long")).over(within))
    if parts > 1:  # failures that stand when a chunk begins: those of the chunks since one with a reset
        ends = counted.groupBy("source", "__chunk").agg(F.max(F.struct("__island", "failures")).alias("e"))
        at = Window.partitionBy("source").orderBy("__chunk")  # one row a chunk
        ends = ends.withColumn("__since", F.sum((F.col("e.__island") > 0).cast("int")).over(at.rowsBetween(Window.unboundedPreceding, 0)))
        stand = F.sum("e.failures").over(Window.partitionBy("source", "__since").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, 0))
        carried = ends.withColumn("__stand", stand).select("source", "__chunk", F.coalesce(F.lag("__stand").over(at), F.lit(0)).alias("__carry"))
        counted = counted.join(carried, ["source", "__chunk"]).withColumn("failures", F.col("failures") + F.when(F.col("__island") == 0, F.col("__carry")).otherwise(0))
    return counted.select(*signals.columns, "failures")


def failures_after(signals: DataFrame, before: DataFrame) -> DataFrame:
    """(source, failures): how many came since the last reset of signals (source, ts, seq, failed, reset), or on top of `before`'s.

    Two partial aggregates, without a window.
    """
    at = F.struct("ts", "seq")
    last = signals.groupBy("source").agg(F.max(F.when(F.col("reset"), at)).alias("__last"))
    since = signals.join(last, "source").groupBy("source").agg(F.count_if(F.col("failed") & (F.col("__last").isNull() | (at >= F.col("__last")))).alias("__n"), F.first("__last").alias("__last"))
    known = since.join(before.select("source", F.col("failures").alias("__before")), "source", "left")
    return known.select("source", (F.col("__n") + F.when(F.col("__last").isNull(), F.coalesce("__before", F.lit(0))).otherwise(0)).cast("long").alias("failures"))


def backoff_schedule(signals: DataFrame, base: float = 1.0, cap: float = 300.0) -> DataFrame:
    """The failures with the wait that follows each."""
    return failures(signals).where("failed").withColumn("delay", backoff(F.col("failures") - 1, base, cap))


def probes(attempts: DataFrame, threshold: float = THRESHOLD, every_seconds: int = PROBE_SECONDS) -> DataFrame:
    """(source, allowed, probed, n) over attempts (source, ts in microseconds, seq, score at that time).

    A healthy source is always routed to.  One below the threshold is, if it was never
    attempted or its last allowed attempt lies `every_seconds` back; each allowed attempt
    marks the time.
    """
    gap = every_seconds * 1_000_000
    none = F.lit(-(1 << 62)).cast("long")
    zero = F.struct(none.alias("last"), F.lit(0).cast("long").alias("allowed"), F.lit(0).cast("long").alias("probed"))

    def one(a: Column, e: Column) -> Column:
        healthy = e["score"] >= F.lit(threshold)
        go = healthy | (e["ts"] - a["last"] >= F.lit(gap))
        return F.struct(
            F.when(go, e["ts"]).otherwise(a["last"]).alias("last"),
            (a["allowed"] + F.when(go, F.lit(1)).otherwise(F.lit(0))).cast("long").alias("allowed"),
            (a["probed"] + F.when(go & ~healthy, F.lit(1)).otherwise(F.lit(0))).cast("long").alias("probed"),
        )

    rows = attempts.groupBy("source").agg(_ordered("score").alias("__s")).select("source", F.aggregate("__s", zero, one).alias("p"), F.size("__s").cast("long").alias("n"))
    return rows.select("source", F.col("p.allowed").alias("allowed"), F.col("p.probed").alias("probed"), "n")


def in_use(fetches: DataFrame) -> DataFrame:
    """(source, most): the most fetches (source, seq, start, end) of a source that ran at once; an end comes before a start of its time."""
    ends = F.explode(F.array(F.struct(F.col("start").alias("t"), F.lit(1).alias("d")), F.struct(F.col("end").alias("t"), F.lit(-1).alias("d")))).alias("e")
    steps = fetches.select("source", "seq", ends).select("source", "seq", "e.t", "e.d")
    chunked, _ = _chunked(steps, "t")
    running = F.sum("d").over(Window.partitionBy("source", "__chunk").orderBy("t", "d", "seq").rowsBetween(Window.unboundedPreceding, 0))
    parts = chunked.withColumn("__n", running).groupBy("source", "__chunk").agg(F.max("__n").alias("most"), F.sum("d").alias("d"))
    before = F.coalesce(F.sum("d").over(Window.partitionBy("source").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a chunk
    return parts.withColumn("most", F.col("most") + before).groupBy("source").agg(F.max("most").alias("most"))


def routed(notices: DataFrame) -> DataFrame:
    """notices (source, ts, seq, kind) as samples and failures: a rate limit is both, a block only a sample, others nothing."""
    return notices.where("kind <> 'other'").select("source", "ts", "seq", F.when(F.col("kind") == "rate_limited", 0.2).otherwise(0.0).alias("sample"), (F.col("kind") == "rate_limited").alias("failed"))


def with_scores(relays: DataFrame, scores: DataFrame) -> DataFrame:
    """relays (url) with their score; unknown ones are healthy."""
    s = scores.select(F.col("source").alias("url"), F.col("score").alias("__score"))
    return relays.join(s, "url", "left").withColumn("score", F.coalesce("__score", F.lit(1.0))).drop("__score")
