"""From settings to tables: recorded and live relays, routing by health, notices, batches that fail, all metric families."""

from __future__ import annotations

import base64
import hashlib
import json
import socket
import struct
import threading
import time
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from tidegraph.config import Config
from tidegraph.functions import schnorr
from tidegraph.operators import gate
from tidegraph.operators.metrics import COUNTERS, GAUGES, HISTOGRAMS, Registry
from tidegraph.plans import crawl as C
from tidegraph.plans import daemon as D
from tidegraph.plans.fleet import Fleet
from tidegraph.sources import relay as R
from tidegraph.sources import websocket as W
from tidegraph.store import Store
from tidegraph.streaming import live

from .fixtures import authors, event, follows, frame, key

NOW = 1_700_000_000


def plain(e: dict) -> dict:
    return {k: v.hex() if isinstance(v, bytes) else v for k, v in e.items() if k != "relay_url"}


def record(root, url: str, events, **about) -> None:
    folder = root / quote(url, safe="")
    folder.mkdir(parents=True)
    (folder / "0.jsonl").write_text("".join(json.dumps(plain(e)) + "\n" for e in events))
    if about:
        (folder / "relay.json").write_text(json.dumps(about))


def status(store):
    return {bytes(r.pubkey): (r.status, r.fetch_attempts) for r in store.current().pubkeys.collect()}


def graph(store):
    now = store.current()
    of = {r.id: bytes(r.pubkey) for r in now.pubkeys.collect()}
    return {(of[r.follower_id], of[r.followee_id]) for r in now.follows.collect()}


def test_a_crawl_over_recorded_relays(spark, tmp_path):
    """Lists are spread over relays; one relay fails until it is below the threshold and skipped, then the rest goes through."""
    a, b, bad, write = "wss://a.example", "wss://b.example/x", "wss://bad.example", "wss://write.example"
    relay_list = event(4, NOW - 5, [["r", write, "write"], ["r", "wss://r.example", "read"]], kind=10002)
    record(tmp_path / "relays", a, [follows(1, NOW - 9, 2), follows(2, NOW - 3, 5), relay_list, follows(6, NOW + 9_999, 1)], notices=["rate-limited: slow down", "hello: rate-limited"])
    record(tmp_path / "relays", b, [follows(1, NOW - 1, 2, 3), follows(2, NOW - 8, 9), follows(3, NOW - 2, 4) | {"content": "forged"}, follows(3, NOW - 4, 4, 6), follows(1, NOW - 1, 2, 3)])
    record(tmp_path / "relays", bad, [], error="timeout", kinds=[3], notices=["blocked: no"])
    record(tmp_path / "relays", write, [follows(4, NOW - 7, 1)])
    clock = [float(NOW)]
    fleet = Fleet(spark, [a, b, bad], R.recorded(f"file://{tmp_path}/relays"))
    store = Store(spark, f"file://{tmp_path}/store")
    stats = C.crawl(store, key(1), C.sources_of(fleet, lambda: clock[0]), clock=lambda: int(clock[0]), most=9, metrics=fleet.metrics)
    # a timeout and a block notice a wave: 0.49, 0.2401; below 0.25 the relay isn't asked any more
    assert fleet.relays[bad].score == pytest.approx(0.7**4) and fleet.relays[bad].attempted == NOW
    found = status(store)
    assert {k: v[0] for k, v in found.items()} == {key(1): "fetched", key(2): "fetched", key(3): "fetched", key(4): "fetched", key(5): "not_found", key(6): "not_found"}
    assert found[key(1)][1] == 2 and found[key(3)][1] == 0  # two waves failed for the anchor, none after that
    assert graph(store) == {(key(1), key(2)), (key(1), key(3)), (key(2), key(5)), (key(3), key(4)), (key(3), key(6)), (key(4), key(1))}
    relays = store.current().pubkey_relays.select("url", "marker", F.unix_seconds("seen_at")).collect()
    assert {tuple(r) for r in relays} == {(write, "write", NOW - 5), ("wss://r.example", "read", NOW - 5)}
    assert stats.claimed == 8 and stats.waves == 5
    values = {(n, labels.get("relay")): v for n, labels, v in fleet.metrics.samples()}
    # a relay hides events after the second it is asked for, so none is counted as future
    assert values["ingest_invalid_signature", None] == 1 and values["ingest_future_dated", None] == 0 and values["nip65_recovered", None] == 1
    assert values["relay_blocked", bad] == 2 and values["relay_rate_limited", a] >= 1 and values["fetch_duration_seconds_count", None] >= 9
    assert fleet.relays[a].failures == 0  # each success ends them
    # when the minute is over the skipped relay is asked once
    clock[0] += 61
    assert [r.url for r in fleet.routed(clock[0])] == [a, b, bad] and [r.url for r in fleet.routed(clock[0] + 1)] == [a, b]


def test_all_relays_skipped_is_an_empty_union(spark, tmp_path):
    fleet = Fleet(spark, ["wss://x"], R.recorded(f"file://{tmp_path}"), threshold=1.0)
    fleet.relays["wss://x"] = R_skipped = fleet.relays["wss://x"].__class__("wss://x", score=0.1, attempted=float(NOW))
    store = Store(spark, f"file://{tmp_path}/store")
    C.crawl(store, key(1), C.Sources(lambda asked: fleet.scan(asked, 3, NOW + 1), record=fleet.record), clock=lambda: NOW)
    assert status(store) == {key(1): ("not_found", 0)} and fleet.relays["wss://x"] == R_skipped


def test_only_the_batches_that_failed_are_put_back(spark, tmp_path):
    """Two authors a batch; a relay that fails when asked for one of them costs that author's batch alone."""
    store = Store(spark, f"file://{tmp_path}/store")
    C.seed(store, key(1))
    everything = frame(spark, [follows(1, NOW, 2, 3, 4, 5, 6), *[follows(i, NOW) for i in range(2, 7)]])
    seen = []

    def scan(asked):
        events = everything.join(asked.select(F.col("author").alias("pubkey"), "batch"), "pubkey")
        seen.append(asked.groupBy("batch").count().count())
        bad = asked.where(F.col("author") == F.lit(key(4))).select("batch").distinct()
        fetch = asked.select("batch").distinct().join(bad.withColumn("bad", F.lit(True)), "batch", "left")
        rows = events.select("id", "pubkey", "created_at", "kind", "tags", "content", "sig", "relay_url", "batch")
        return rows.unionByName(fetch.select("batch", F.lit("wss://a").alias("relay_url"), F.lit(0).cast("long").alias("chunk"), F.when(F.col("bad"), "error").otherwise("success").alias("status"), F.lit(0.0).alias("began"), F.lit(0.0).alias("seconds"), F.array().cast("array<string>").alias("notices")), allowMissingColumns=True)

    stats = C.crawl(store, key(1), C.Sources(scan), clock=lambda: NOW, batch=2, most=2)
    ids = {bytes(r.pubkey): r.id for r in store.current().pubkeys.collect()}
    order = sorted((i, k) for k, i in ids.items() if k != key(1))
    at = [k for _, k in order].index(key(4)) // 2
    together = {k for _, k in order[2 * at : 2 * at + 2]}
    assert {k for k, v in status(store).items() if v[0] == "failed"} == together
    assert all(v[0] == "fetched" for k, v in status(store).items() if k not in together)
    assert stats.waves == 3 and stats.batches == 1 + 3 + 1 and seen == [1, 3, 1]


def test_requests_are_cut_by_limits_and_errors_become_rows(spark, tmp_path):
    events = [follows(a, NOW - i, 90) for a in (1, 2, 3) for i in range(4)]
    record(tmp_path, "wss://a", [*events, {**follows(1, NOW, 5), "sig": b""}], notices=["rate-limited: x"])
    (tmp_path / quote("wss://a", safe="") / "1.jsonl").write_text(json.dumps({"id": "zz", "pubkey": key(1).hex(), "created_at": NOW, "kind": 3, "tags": [["p", 5]], "content": None, "sig": "00"}) + "\n")
    record(tmp_path, "wss://down", [], error="connect")
    record(tmp_path, "wss://no", [], error="refused")
    asked = authors(spark, 1, 2, 3).withColumn("batch", F.lit(7)).withColumn("url", F.explode(F.array(*map(F.lit, ("wss://a", "wss://down", "wss://no", "wss://gone")))))
    found = R.scan(asked.withColumn("max_authors", F.lit(2)).withColumn("max_limit", F.lit(5)).withColumn("at_once", F.lit(2)).withColumn("rate", F.lit(1000.0)), R.recorded(f"file://{tmp_path}"), 3).collect()
    fetches = {(r.relay_url, r.chunk): r for r in found if r.status}
    assert len(fetches) == 8 and all(r.batch == 7 for r in found)
    assert {u: {r.status for (x, _), r in fetches.items() if x == u} for u, _ in fetches} == {"wss://a": {"success"}, "wss://down": {"connect_failure"}, "wss://no": {"error"}, "wss://gone": {"connect_failure"}}
    assert [n for r in fetches.values() for n in r.notices].count("rate-limited: x") >= 1
    got = [bytes(r.id) for r in found if r.status is None]
    assert set(got) >= {e["id"] for e in events}


def test_a_relay_is_asked_by_one_task_and_no_faster_than_its_quota(spark, tmp_path):
    record(tmp_path, "wss://a", [follows(a, NOW, 9) for a in range(1, 7)])
    asked = authors(spark, *range(1, 7)).repartition(3).select("author", F.lit(0).alias("batch"), F.lit("wss://a").alias("url"), F.lit(1).alias("max_authors"), F.lit(4.0).alias("rate"), F.lit(4).alias("at_once"))
    start = time.monotonic()
    rows = R.scan(asked, R.recorded(f"file://{tmp_path}"), 3).where("status is not null").collect()
    assert len(rows) == 6 and time.monotonic() - start >= 0.5  # four at once, then one each quarter of a second


# the live protocol


class Stub(threading.Thread):
    """A relay on a local port: answers requests from a list of events."""

    def __init__(self, events, greeting=(), silent=False):
        super().__init__(daemon=True)
        self.events, self.greeting, self.silent = [plain(e) for e in events], greeting, silent
        self.server = socket.create_server(("127.0.0.1", 0))
        self.url = f"ws://127.0.0.1:{self.server.getsockname()[1]}/path?x=1"
        self.asked = []
        self.start()

    def run(self):
        while True:
            try:
                one, _ = self.server.accept()
            except OSError:
                return
            threading.Thread(target=self.serve, args=(one,), daemon=True).start()

    def serve(self, one):
        f = one.makefile("rb")
        lines = []
        while (line := f.readline().strip()):
            lines.append(line)
        k = next(x.split(b": ")[1] for x in lines if x.lower().startswith(b"sec-websocket-key"))
        one.sendall(b"HTTP/1.1 101 Switching Protocols\r\nUpgrade: websocket\r\nConnection: Upgrade\r\nSec-WebSocket-Accept: " + base64.b64encode(hashlib.sha1(k + W.GUID).digest()) + b"\r\n\r\n")

        def send(data: bytes, first: int = 0x81):
            n = len(data)
            one.sendall(bytes([first]) + (bytes([n]) if n < 126 else struct.pack("!BH", 126, n) if n < 65_536 else struct.pack("!BQ", 127, n)) + data)

        for text in self.greeting:
            send(json.dumps(["NOTICE", text]).encode())
        while True:
            head = f.read(2)
            if len(head) < 2:
                return
            n = head[1] & 0x7F
            n = int.from_bytes(f.read(2 if n == 126 else 8), "big") if n >= 126 else n
            mask = f.read(4)
            data = bytes(b ^ mask[i % 4] for i, b in enumerate(f.read(n)))
            if head[0] & 0x0F != 1:
                continue
            message = json.loads(data)
            if message[0] != "REQ" or self.silent:
                continue
            self.asked.append(message[2])
            if message[2]["kinds"] == [666]:
                send(json.dumps(["CLOSED", message[1], "restricted: no"]).encode())
                continue
            send(b"are you there", 0x89)
            hits = [e for e in self.events if e["pubkey"] in message[2]["authors"] and e["created_at"] <= message[2]["until"] and e["kind"] in message[2]["kinds"]]
            for e in sorted(hits, key=lambda e: -e["created_at"])[: message[2]["limit"]]:
                whole = json.dumps(["EVENT", message[1], e]).encode()
                send(whole[:40], 0x01)  # in two frames
                send(whole[40:], 0x80)
            send(json.dumps(["EOSE", message[1]]).encode())


def test_live_relays(spark):
    stub = Stub([follows(a, NOW - i, *range(20, 20 + a)) for a in (1, 2) for i in range(5)], ["rate-limited: easy"])
    found = R.scan(authors(spark, 1, 2).select("author", F.lit(1).alias("batch"), F.lit(stub.url).alias("url"), F.lit(3).alias("max_limit")), W.connect, 3, NOW).collect()
    fetch = [r for r in found if r.status]
    assert [(r.status, r.notices) for r in fetch] == [("success", ["rate-limited: easy"])]
    events = [r for r in found if r.status is None]
    assert len(events) == 10 and all(schnorr.valid_event(r.asDict()) for r in events)
    assert len(stub.asked) > 3 and {x["limit"] for x in stub.asked} == {3} and stub.asked[0]["until"] == NOW
    closed = R.scan(authors(spark, 1).select("author", F.lit(1).alias("batch"), F.lit(stub.url).alias("url")), W.connect, 666, NOW).collect()
    assert [(r.status, r.notices[-1]) for r in closed] == [("error", "restricted: no")]
    silent = Stub([], silent=True)
    late = R.scan(authors(spark, 1).select("author", F.lit(1).alias("batch"), F.lit(silent.url).alias("url")), W.connect, 3, NOW, timeout=0.3).collect()
    assert [r.status for r in late] == ["timeout"]
    gone = R.scan(authors(spark, 1).select("author", F.lit(1).alias("batch"), F.lit("ws://127.0.0.1:1").alias("url")), W.connect, 3, NOW).collect()
    assert [r.status for r in gone] == ["connect_failure"]
    for s in (stub, silent):
        s.server.close()


def test_a_daemon_from_settings_emits_all_families(spark, tmp_path):
    record(tmp_path / "relays", "wss://a", [follows(1, NOW, 2)], notices=["restricted: x"])
    config = Config(key(1).hex(), ("wss://a",), "x://y", 3600.0, "127.0.0.1:0", idle_poll_interval=0.05, progress_interval=0.0, per_relay_concurrency=2, reqs_per_second=50).validate()
    d = D.assembled(spark, config, f"file://{tmp_path}/store", R.recorded(f"file://{tmp_path}/relays"), fetch=lambda url: b'{"limitation":{"max_limit":123}}', clock=lambda: float(NOW))
    assert d.fleet.relays["wss://a"].max_limit == 123 and (d.fleet.at_once, d.fleet.rate) == (2, 50)
    thread = threading.Thread(target=d.run)
    thread.start()
    for _ in range(1200):
        if "crawl_coverage_ratio 0.5" in d.text:
            break
        assert thread.is_alive()
        time.sleep(0.1)
    assert d.ready()
    d.stop.set()
    thread.join(120)
    names = {line.split("{")[0].split(" ")[0] for line in d.text.splitlines()}
    labelled = {"relay_rate_limited", "relay_blocked"}
    assert {n for n in (*COUNTERS, *GAUGES)} - labelled <= names and {f"{h}_{x}" for h in HISTOGRAMS for x in ("bucket", "sum", "count")} <= names
    assert 'relay_blocked{relay="wss://a"} ' in d.text and 'fetch_duration_seconds_bucket{le="30.0"}' in d.text


def test_registry_text():
    r = Registry()
    r.count("relay_blocked", relay='wss://"x"')
    r.observe("staleness_age_seconds", [(1.0, 2), (float("inf"), 3)], 7.5)
    assert 'relay_blocked{relay="wss://\\"x\\""} 1.0' in r.text() and 'staleness_age_seconds_bucket{le="+Inf"} 3.0' in r.text() and "staleness_age_seconds_sum 7.5" in r.text()


# verification


def test_only_what_can_win_is_verified(spark, monkeypatch):
    good = [follows(a, NOW - i, 9) for a in (1, 2, 3) for i in range(5)]
    forged = follows(2, NOW + 1, 9) | {"content": "x"}
    other = [follows(7, NOW, 9), event(1, NOW, [], kind=1), follows(3, NOW + 9_999, 9)]
    events = frame(spark, [*good, *[e | {"relay_url": "wss://b"} for e in good], forged, *other]).withColumnRenamed("pubkey", "author")
    checked, counted = [], {}
    real = gate.with_signature_check

    def check(rows, name="valid"):
        checked.append(rows.count())
        return real(rows, name)

    monkeypatch.setattr(gate, "with_signature_check", check)
    winners = gate.resolve_unverified(events, authors(spark, 1, 2, 3), 3, NOW, tally=lambda reason, n: counted.update({reason: counted.get(reason, 0) + n}))
    assert {bytes(r.author): r.created_at for r in winners.collect()} == {key(a): NOW for a in (1, 2, 3)}
    assert checked == [3, 5]  # one an author, then the rest of the author whose newest is forged
    assert counted == {"unsolicited": 2, "future_dated": 1, "invalid_signature": 1}


def test_batches_of_signatures():
    signed = [(schnorr.event_id(key(i), i, 1, [], ""), key(i)) for i in range(1, 40)]
    signed = [(m, k, schnorr.sign(m, (i + 1).to_bytes(2, "big") * 16)) for i, (m, k) in enumerate(signed)]
    assert schnorr.verify_all(signed) == [True] * 39 and schnorr.verify_all([]) == []
    for bad in ([0], [3, 17, 38], list(range(39))):
        mixed = [(m, k, s[:-1] + bytes([s[-1] ^ 1])) if i in bad else (m, k, s) for i, (m, k, s) in enumerate(signed)]
        assert schnorr.verify_all(mixed) == [i not in bad for i in range(39)] == [schnorr.verify(*x) for x in mixed]
    # errors that would cancel out in a plain sum of the equations
    s0, s1 = (int.from_bytes(signed[i][2][32:], "big") for i in (0, 1))
    swapped = [(signed[i][0], signed[i][1], signed[i][2][:32] + ((s + d) % schnorr.N).to_bytes(32, "big")) for i, s, d in ((0, s0, 5), (1, s1, -5))]
    assert schnorr.verify_all(swapped) == [False, False]


def test_a_stream_of_notices(spark, tmp_path):
    rows = spark.createDataFrame([("wss://a", 1, 1, "rate-limited: x"), ("wss://a", 2, 1, "hello"), ("wss://b", 1, 1, "blocked")], "relay_url string, ts long, seq long, message string")
    rows.coalesce(1).write.parquet(f"{tmp_path}/n")
    samples = live.stream_notices(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/n"))
    q = live.stream_health(samples).writeStream.outputMode("update").format("memory").queryName("noticed").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/cp").start()
    q.awaitTermination()
    assert {r.source: (round(r.score, 9), r.n) for r in spark.table("noticed").collect()} == {"wss://a": (0.76, 1), "wss://b": (0.7, 1)}
