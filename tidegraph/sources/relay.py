"""Scans of relays: of a table of requests, and as a Spark data source.

`scan` takes requests (author, url) as a DataFrame, so that nobody collects authors.  All
requests of a relay meet in one task, as its quota has a single writer; there they are
cut into chunks, and as many are under way at once as the relay is permitted.  What a
fetch finds comes back as rows, and so does how it went: a relay that fails costs the
batches it was asked for, not the job.

A transport connects to a relay by its url: `Replay` reads recorded events from folders
of any store that all executors reach, `websocket.connect` speaks the live protocol.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from itertools import groupby
from typing import Protocol
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..deploy import ship
from ..operators.pagination import AUTHORS_PER_REQUEST, PAGES, Stalled, scanned

NAME = "relay_events"
#: Seconds between two attempts to connect, at most.
RECONNECT_CAP = 300.0


class FetchTimeout(RuntimeError):
    """A window took as long as its deadline or longer."""


class Chunk(InputPartition):
    def __init__(self, relay: str, authors: list[str]):
        self.relay, self.authors = relay, authors


class RelayError(RuntimeError):
    """A relay refused or broke off."""


class Connection(Protocol):
    notices: list[str]

    def page(self, authors: list[str], kind: int, until: int, limit: int, deadline: float) -> list[dict]:
        """The newest `limit` events of this kind by these authors at or before `until`; raises FetchTimeout after `deadline` seconds."""


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


class Replay:
    """Recorded events of a relay: JSON lines in the files of a folder, answered newest first.

    A file `relay.json` beside them may hold `notices` that each connection brings, and an
    `error` (connect, timeout or refused) with which requests fail, or those for some `kinds`.
    """

    def __init__(self, relay: str, name: str = ""):
        files, root = _store(relay)
        root = f"{root}/{name}" if name else root  # a name isn't part of a URI: its escapes stay
        self.events, self.error, self.kinds, self.notices = [], None, None, []
        found = files.get_file_info(fs.FileSelector(root))  # an OSError if there is no such relay
        for info in sorted(found, key=lambda i: i.base_name):
            if info.base_name.endswith(".jsonl"):
                with files.open_input_file(info.path) as f:
                    self.events += [json.loads(line) for line in f.read().decode().splitlines() if line.strip()]
            elif info.base_name == "relay.json":
                with files.open_input_file(info.path) as f:
                    about = json.loads(f.read())
                self.error, self.kinds, self.notices = about.get("error"), about.get("kinds"), list(about.get("notices", []))
        if self.error == "connect":
            raise ConnectionError(relay)
        self.events.sort(key=lambda e: (-e["created_at"], e["id"]))

    def page(self, authors, kind: int, until: int, limit: int, deadline: float = 30.0) -> list[dict]:
        if self.error and kind in (self.kinds or [kind]):
            raise FetchTimeout("recorded") if self.error == "timeout" else RelayError("refused")
        wanted = set(authors)
        return [e for e in self.events if e["created_at"] <= until and e["kind"] == kind and e["pubkey"] in wanted][:limit]


def recorded(root: str) -> Callable[[str], Replay]:
    """A transport that finds each relay's folder in `root` under its quoted url."""
    return lambda url: Replay(root, quote(url, safe=""))


class Throttle:
    """A token for each request, `per_second` of them; a partition's own share of a relay's quota."""

    def __init__(self, per_second: float, burst: int = 1):
        self.step, self.room, self.next = 1 / per_second, (burst - 1) / per_second, 0.0
        self.lock = threading.Lock()

    def wait(self) -> None:
        with self.lock:
            now = time.monotonic()
            pause = max(0.0, self.next - self.room - now)
            self.next = max(self.next, now) + self.step
        if pause:
            time.sleep(pause)


def reconnecting(connect: Callable[[], Replay], retries: int, seconds: float, sleep: Callable[[float], None] = time.sleep) -> Replay:
    """connect(), tried again after a wait that doubles each time, up to `retries` times."""
    for n in range(retries + 1):
        try:
            return connect()
        except OSError:
            if n == retries:
                raise
            sleep(min(seconds * 2**n, RECONNECT_CAP))
    raise AssertionError


#: What a scan gives: events, and for each fetch a row without id that says how it went.
SCANNED = "id binary, pubkey binary, created_at long, kind int, tags array<array<string>>, content string, sig binary, relay_url string, batch long, chunk long, status string, began double, seconds double, notices array<string>"
_LIST = pa.list_(pa.string())
_SCANNED = pa.schema(
    [("id", pa.binary()), ("pubkey", pa.binary()), ("created_at", pa.int64()), ("kind", pa.int32()), ("tags", pa.list_(_LIST)), ("content", pa.string()), ("sig", pa.binary()), ("relay_url", pa.string())]
    + [("batch", pa.int64()), ("chunk", pa.int64()), ("status", pa.string()), ("began", pa.float64()), ("seconds", pa.float64()), ("notices", _LIST)]
)
#: Seconds a window may take, requests a second and at once, and rows of an answer, where a request doesn't say.
TIMEOUT, RATE, AT_ONCE, MAX_LIMIT = 30.0, 4.0, 4, 500
#: A second later than any event's.
FOREVER = 1 << 62


def row_of(event: dict, relay: str) -> dict | None:
    """An event as a row; None if it isn't one."""
    try:
        made = {"created_at": int(event["created_at"]), "kind": int(event["kind"]), "tags": [[str(x) for x in t] for t in event["tags"]], "content": str(event["content"]), "relay_url": relay}
        return made | {k: bytes.fromhex(event[k]) for k in ("id", "pubkey", "sig")} if -(1 << 63) <= made["created_at"] < 1 << 63 and 0 <= made["kind"] < 1 << 31 else None
    except (KeyError, TypeError, ValueError):
        return None


def fetched(connect: Callable[[str], Connection], url: str, authors: list[str], kind: int, until: int, limit: int, timeout: float, throttle: Throttle | None, held: threading.local) -> tuple[str, list[dict], list[str]]:
    """(status, rows, notices) of one chunk of a relay's authors; a thread keeps its connection."""
    notices: list[str] = []
    try:
        if getattr(held, "connection", None) is None:
            held.connection = connect(url)
        source = held.connection

        def window(to: int) -> list[tuple]:
            if throttle:
                throttle.wait()
            began = time.monotonic()
            rows = source.page(authors, kind, to, limit, timeout)
            if time.monotonic() - began >= timeout:
                raise FetchTimeout(url)
            return [(e["created_at"], e["id"], e) for e in rows]

        rows = [r for e in scanned(window, until, limit, PAGES) if (r := row_of(e, url))]
        status = "success"
    except FetchTimeout:
        status, rows = "timeout", []
    except OSError:
        status, rows = "connect_failure", []
    except (RelayError, Stalled, KeyError, TypeError, ValueError):
        status, rows = "error", []
    source = getattr(held, "connection", None)
    if source is not None:
        notices, source.notices = source.notices, []
        if status != "success":
            held.connection = None
    return status, rows, notices


def scan(requests: DataFrame, connect: Callable[[str], Connection], kind: int, until: int = FOREVER, timeout: float = TIMEOUT) -> DataFrame:
    """SCANNED rows of requests (url, batch, author; max_limit, max_authors, at_once and rate if they differ from the defaults).

    Authors of a batch share requests, of at most `max_authors` each.
    """
    defaults = {"max_limit": (MAX_LIMIT, "int"), "max_authors": (AUTHORS_PER_REQUEST, "int"), "at_once": (AT_ONCE, "int"), "rate": (RATE, "double")}
    rows = requests.select("url", F.col("batch").cast("long").alias("batch"), "author", *[(F.coalesce(F.col(n), F.lit(v)) if n in requests.columns else F.lit(v)).cast(t).alias(n) for n, (v, t) in defaults.items()])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = (r for b in batches for r in b.to_pylist())
        for url, of_relay in groupby(asked, key=lambda r: r["url"]):
            yield from _asked(url, of_relay, connect, kind, until, timeout)

    ship(requests.sparkSession)
    # the relay is the limit, not the cores: its requests are in one task, in order
    return rows.repartition("url").sortWithinPartitions("url", "batch", "author").mapInArrow(ask, SCANNED)


def _asked(url: str, rows: Iterator[dict], connect, kind: int, until: int, timeout: float) -> Iterator[pa.RecordBatch]:
    """The answers of one relay; a few fetches are under way at once, and no more are held than these."""
    held, pool, throttle, running = threading.local(), None, None, {}

    def answer(futures) -> Iterator[pa.RecordBatch]:
        for f in futures:
            batch, chunk = running.pop(f)
            began, seconds, (status, events, notices) = f.result()
            at = {"batch": batch, "chunk": chunk}
            about = {"relay_url": url, "status": status, "began": began, "seconds": seconds, "notices": notices}
            yield pa.RecordBatch.from_pylist([e | at for e in events] + [about | at], schema=_SCANNED)

    def timed(*of) -> tuple:
        began, start = time.time(), time.monotonic()
        found = fetched(connect, url, *of, throttle, held)
        return began, time.monotonic() - start, found

    try:
        for batch, of_batch in groupby(rows, key=lambda r: r["batch"]):
            chunk, more = 0, True
            while more:
                authors, first = [], None
                for r in of_batch:
                    first = first or r
                    authors.append(r["author"].hex())
                    if len(authors) >= max(1, first["max_authors"]):
                        break
                else:
                    more = False
                if not first:
                    break
                if pool is None:
                    pool = ThreadPoolExecutor(max(1, first["at_once"]))
                    throttle = Throttle(first["rate"], max(1, int(first["rate"]))) if first["rate"] > 0 else None
                running[pool.submit(timed, authors, kind, until, first["max_limit"], timeout)] = (batch, chunk)
                chunk += 1
                if len(running) >= 2 * pool._max_workers:
                    yield from answer(wait(running, return_when=FIRST_COMPLETED).done)
        yield from answer(list(running))
    finally:
        if pool:
            pool.shutdown(cancel_futures=True)


class RelayReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.relays = [r for r in options["relays"].split(",") if r]
        self.authors = [a for a in options.get("authors", "").split(",") if a]
        self.kind = int(options.get("kind", "3"))
        self.until = int(options.get("until", str(1 << 62)))
        self.limit = int(options.get("limit", "500"))
        self.per_request = max(1, int(options.get("max_authors", "500")))
        self.timeout = float(options.get("timeout", "30"))
        self.rate = float(options.get("requests_per_second", "0"))
        self.retries = int(options.get("retries", "0"))
        self.retry_seconds = float(options.get("retry_seconds", "10"))

    def partitions(self) -> list[Chunk]:
        chunks = [self.authors[i : i + self.per_request] for i in range(0, len(self.authors), self.per_request)]
        return [Chunk(r, c) for r in self.relays for c in chunks]

    def read(self, partition: Chunk) -> Iterator[tuple]:
        source = reconnecting(lambda: Replay(partition.relay), self.retries, self.retry_seconds)
        wanted = set(partition.authors)
        # the quota of a relay is shared by its partitions, which may all run at once
        shares = -(-len(self.authors) // self.per_request)
        throttle = Throttle(self.rate / shares) if self.rate else None

        def fetch(until: int) -> list[tuple]:
            if throttle:
                throttle.wait()
            began = time.monotonic()
            rows = source.page(wanted, self.kind, until, self.limit, self.timeout)
            if time.monotonic() - began >= self.timeout:
                raise FetchTimeout(partition.relay)
            return [(e["created_at"], e["id"], e) for e in rows]

        for e in scanned(fetch, self.until, self.limit, PAGES):
            yield bytes.fromhex(e["id"]), bytes.fromhex(e["pubkey"]), e["created_at"], e["kind"], e["tags"], e["content"], bytes.fromhex(e["sig"]), partition.relay


class RelayEvents(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "id binary, pubkey binary, created_at bigint, kind int, tags array<array<string>>, content string, sig binary, relay_url string"

    def reader(self, schema) -> RelayReader:
        return RelayReader(self.options)


def register(spark: SparkSession) -> None:
    """Makes `spark.read.format("relay_events")` known."""
    ship(spark)
    spark.dataSource.register(RelayEvents)
