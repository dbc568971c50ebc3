"""The curated relays: whom to ask now, how many requests at once, and what the answers say about them.

The relays are the few that the settings name, so their state (a score, a counter and a
time each) is kept by the driver; what a wave's fetches and notices add is folded by
Spark and comes back as one row a relay.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import frontier, signals
from ..operators.metrics import Registry
from ..sources import relay as R


@dataclass(frozen=True)
class Relay:
    url: str
    max_limit: int = S.MAX_LIMIT
    score: float = 1.0
    attempted: float | None = None
    failures: int = 0


class Fleet:
    def __init__(self, spark: SparkSession, urls, connect: Callable[[str], R.Connection], threshold: float = signals.THRESHOLD, alpha: float = signals.ALPHA, at_once: int = signals.PER_SOURCE, rate: float = signals.REQUESTS_PER_SECOND, timeout: float = R.TIMEOUT, metrics: Registry | None = None):
        self.spark, self.connect, self.metrics = spark, connect, metrics or Registry()
        self.threshold, self.alpha, self.at_once, self.rate, self.timeout = threshold, alpha, at_once, rate, timeout
        self.relays = {u: Relay(u) for u in urls}
        self.in_use: dict[str, int] = {}

    def limit(self, limits: DataFrame) -> None:
        """Takes over what the relays' limits documents (url, max_limit) say."""
        for r in limits.where(F.col("url").isin(list(self.relays))).collect():  # the curated ones
            self.relays[r["url"]] = replace(self.relays[r["url"]], max_limit=r["max_limit"])

    def routed(self, now: float) -> list[Relay]:
        """Relays to ask: healthy ones, and of the others those whose last attempt is long enough ago; their attempts are marked."""
        out = []
        for url, r in self.relays.items():
            if r.score >= self.threshold or r.attempted is None or now - r.attempted >= signals.PROBE_SECONDS:
                self.relays[url] = replace(r, attempted=now)
                out.append(self.relays[url])
        return out

    def permits(self, r: Relay) -> int:
        return max(1, int(self.at_once * r.score + 0.5))

    def scan(self, authors: DataFrame, kind: int, now: float, every: bool = False) -> DataFrame:
        """SCANNED rows of the routed relays (or of all) for authors (author, batch); no rows if none is routed."""
        asked = list(self.relays.values()) if every else self.routed(now)
        if not asked:
            return self.spark.createDataFrame([], R.SCANNED)
        relay = [F.struct(F.lit(r.url).alias("url"), F.lit(r.max_limit).alias("max_limit"), F.lit(self.permits(r)).alias("at_once")) for r in asked]
        requests = authors.withColumn("r", F.explode(F.array(*relay))).select("author", "batch", "r.*", F.lit(float(self.rate)).alias("rate"))  # each author once for each of the few relays
        return R.scan(requests, self.connect, kind, int(now), self.timeout)

    def scores(self) -> DataFrame:
        return self.spark.createDataFrame([(r.url, r.score) for r in self.relays.values()], "source string, score double")

    def record(self, fetches: DataFrame) -> None:
        """Takes over a wave's fetches (relay_url, batch, chunk, status, began, seconds, notices).

        A relay's fetch for a batch is one sample, failed if any of its chunks did; notices
        are samples of their own, before it.  A fetch that succeeds ends a relay's failures.
        """
        worst = F.max_by("status", F.when(F.col("status") == "success", 0).when(F.col("status") == "timeout", 1).otherwise(2))
        runs = fetches.groupBy(F.col("relay_url").alias("source"), "batch").agg(worst.alias("status"), F.sum("seconds").alias("seconds"), F.min("began").alias("began"))
        done = runs.select("source", F.col("batch").alias("ts"), F.lit(1 << 40).alias("seq"), S.outcome_sample(F.col("status"), F.col("seconds")).alias("sample"), F.lit(False).alias("failed"), (F.col("status") == "success").alias("reset"))
        texts = fetches.select(F.col("relay_url").alias("source"), F.col("batch").alias("ts"), "chunk", F.posexplode("notices").alias("pos", "text"))
        noted = texts.select("source", "ts", (F.col("chunk") * (1 << 20) + F.col("pos")).alias("seq"), S.notice_class(F.col("text")).alias("kind"))
        routed = signals.routed(noted).withColumn("reset", F.lit(False))
        samples = done.unionByName(routed)
        before = self.spark.createDataFrame([(r.url, r.score, r.failures) for r in self.relays.values()], "source string, score double, failures long")
        found = signals.health(samples, self.alpha, before).join(signals.failures_after(samples, before), "source")
        kinds = noted.groupBy("source").agg(F.count_if(F.col("kind") == "rate_limited").alias("rate_limited"), F.count_if(F.col("kind") == "blocked").alias("blocked"))
        most = signals.in_use(fetches.select(F.col("relay_url").alias("source"), F.monotonically_increasing_id().alias("seq"), F.col("began").alias("start"), (F.col("began") + F.col("seconds")).alias("end")))
        for r in found.join(kinds, "source", "left").join(most, "source", "left").collect():  # one row a relay
            if r["source"] in self.relays:
                self.relays[r["source"]] = replace(self.relays[r["source"]], score=r["score"], failures=r["failures"])
                self.in_use[r["source"]] = r["most"] or 0
                for name in ("rate_limited", "blocked"):
                    if r[name]:
                        self.metrics.count(f"relay_{name}", r[name], relay=r["source"])
        buckets = frontier.histogram(fetches, "seconds", frontier.FETCH_BUCKETS).collect()
        total = fetches.agg(F.sum("seconds")).first()[0] or 0.0
        self.metrics.observe("fetch_duration_seconds", [(b["le"], b["n"]) for b in buckets], total)

    def sample(self) -> None:
        """The relays' gauges."""
        self.metrics.set("relay_active_count", sum(r.attempted is not None for r in self.relays.values()))
        self.metrics.set("relay_consecutive_failures", max([r.failures for r in self.relays.values()], default=0))
        for r in self.relays.values():
            self.metrics.set("relay_health", r.score, relay=r.url)
            self.metrics.set("relay_concurrency_in_use", self.in_use.get(r.url, 0), relay=r.url)
