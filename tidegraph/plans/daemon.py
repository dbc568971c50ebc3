"""The continuous crawl: waves while there is work, idle polls, timed refreshes, metrics over HTTP."""

from __future__ import annotations

import json
import logging
import threading
import time
import urllib.request
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config, public_key
from ..functions.scalars import http_url
from ..operators import frontier, metrics
from ..operators.limits import LARGEST_DOCUMENT, parsed
from ..sources.relay import Connection
from ..store import Store, settled
from .crawl import Sources, Stats, crawl, reclaim_leases, reenqueue_stale, sources_of
from .fleet import Fleet

log = logging.getLogger(__name__)

#: Seconds for a relay's whole answer, and the media type of limits documents (fixed values).
LIMITS_TIMEOUT, LIMITS_TYPE = 10, "application/nostr+json"
#: Seconds in which a store that is ready answers (a fixed value).
READY_SECONDS = 0.5


class JsonLines(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        return json.dumps({"time": self.formatTime(record), "level": record.levelname, "target": record.name, "message": record.getMessage()})


def start_logging(level: str, style: str) -> None:
    handler = logging.StreamHandler()
    if style == "json":
        handler.setFormatter(JsonLines())
    logging.basicConfig(level=level.upper(), handlers=[handler], force=True)


def limits_documents(spark: SparkSession, relays: list[tuple[str, str]], fetch: Callable[[str], bytes] | None = None) -> DataFrame:
    """(url, limits) of the configured relays (url, http url); one that can't be had or is too large gives the defaults."""

    def get(url: str) -> bytes:
        request = urllib.request.Request(url, headers={"Accept": LIMITS_TYPE})
        with urllib.request.urlopen(request, timeout=LIMITS_TIMEOUT) as answer:
            return answer.read(LARGEST_DOCUMENT + 1)

    rows = []
    for url, http in relays:  # the few configured ones
        try:
            body = (fetch or get)(http)
            rows.append((url, body.decode(errors="replace") if len(body) <= LARGEST_DOCUMENT else None))
        except OSError as e:
            log.warning("limits of %s: %s", url, e)
            rows.append((url, None))
    return parsed(spark.createDataFrame(rows, "url string, body string"))


def sample(store: Store, registry: metrics.Registry, as_of: int) -> None:
    """The frontier's gauges and the ages of the stalest vertices, from the store's newest version."""
    state = store.current().pubkeys
    counts = frontier.counts(state).first()
    ages = settled(frontier.stalest(state, F.timestamp_seconds(F.lit(as_of))), "ages")
    buckets = [(b["le"], b["n"]) for b in frontier.histogram(ages, "age").collect()]
    # all at once, when all is known
    registry.observe("staleness_age_seconds", buckets, ages.agg(F.sum("age")).first()[0] or 0.0)
    registry.set("frontier_depth", counts["discovered"])
    registry.set("crawl_coverage_ratio", counts["coverage"])


class Daemon:
    """Runs until `stop` is set; a wave that has begun is finished."""

    def __init__(self, store: Store, config: Config, sources: Sources, clock: Callable[[], float] = time.time, fleet: Fleet | None = None):
        self.store, self.config, self.sources, self.clock, self.fleet = store, config, sources, clock, fleet
        self.stop, self.alive = threading.Event(), False
        self.stats = Stats()
        self.metrics = fleet.metrics if fleet else metrics.Registry()
        self.pool = ThreadPoolExecutor(1)

    @property
    def text(self) -> str:
        return self.metrics.text()

    def due(self, last: dict[str, float], name: str, every: float) -> bool:
        if self.clock() - last.get(name, float("-inf")) < every:
            return False
        last[name] = self.clock()
        return True

    def run(self) -> Stats:
        c, last = self.config, {}
        sources = self.sources if c.nip65_fallback_enabled else Sources(self.sources.lists, record=self.sources.record)
        self.alive, first = True, True
        try:
            while not self.stop.is_set():
                done = crawl(
                    self.store, public_key(c.anchor_pubkey), sources, lambda: int(self.clock()), width=c.batch_size * c.concurrency, batch=c.batch_size, stop=self.stop.is_set, reclaim=first, most=c.max_attempts, k=c.nip65_max_write_relays, metrics=self.metrics
                )
                first = False
                self.stats = Stats(*(a + b for a, b in zip(astuple(self.stats), astuple(done), strict=True)))
                if self.due(last, "staleness", c.staleness_scan_interval):
                    self.metrics.count("staleness_reenqueued", reenqueue_stale(self.store, int(self.clock()), int(c.ttl)))
                if self.due(last, "leases", c.reclaim_interval):
                    self.metrics.count("in_run_reclaimed", reclaim_leases(self.store, int(self.clock()), int(c.reclaim_age)))
                if self.due(last, "progress", c.progress_interval):
                    sample(self.store, self.metrics, int(self.clock()))
                    if self.fleet:
                        self.fleet.sample()
                    log.info("claimed %d in %d waves of %d batches", self.stats.claimed, self.stats.waves, self.stats.batches)
                self.stop.wait(c.idle_poll_interval)
        finally:
            self.alive = False
        return self.stats

    def ready(self) -> bool:
        """The loop runs, and the store answers within READY_SECONDS."""
        try:
            return self.alive and self.pool.submit(lambda: self.store.current().version).result(READY_SECONDS) >= 0
        except Exception as e:
            log.warning("the store doesn't answer: %r", e)
            return False


def assembled(spark: SparkSession, config: Config, root: str, connect: Callable[[str], Connection], fetch: Callable[[str], bytes] | None = None, clock: Callable[[], float] = time.time) -> Daemon:
    """A daemon over the settings' relays, each asked within the limits that it tells."""
    fleet = Fleet(spark, config.relays, connect, config.relay_health_threshold, config.health_alpha, config.per_relay_concurrency, config.reqs_per_second, config.fetch_timeout)
    http = spark.createDataFrame([(u,) for u in config.relays], "url string").select("url", http_url(F.col("url")).alias("http")).collect()
    fleet.limit(limits_documents(spark, [(r["url"], r["http"]) for r in http], fetch))
    return Daemon(Store(spark, root), config, sources_of(fleet, clock), clock, fleet)


def serve(daemon: Daemon, address: str) -> ThreadingHTTPServer:
    """/metrics, /health/live and /health/ready, on a thread of its own."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            ready = self.path != "/health/ready" or daemon.ready()
            body = {"/metrics": daemon.text, "/health/live": "ok", "/health/ready": "ready" if ready else "not ready"}.get(self.path)
            self.send_response(404 if body is None else 200 if ready else 503)
            self.send_header("Content-Type", "text/plain; charset=utf-8")
            self.end_headers()
            self.wfile.write((body or "").encode())

        def log_message(self, *args: object) -> None:
            pass

    host, _, port = address.rpartition(":")
    server = ThreadingHTTPServer((host, int(port)), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server
