from __future__ import annotations

import datetime
import itertools
import json

import pytest
from pyspark.sql import functions as F

from tidegraph.operators import edge_diff, frontier, views
from tidegraph.plans import crawl as C
from tidegraph.plans.ingest import with_keys
from tidegraph.schemas import PUBKEYS
from tidegraph.sources import relay as relay_source
from tidegraph.store import Store, settled

from .fixtures import authors, event, follows, frame, key

NOW = 1_700_000_000


def at(seconds: float) -> datetime.datetime:
    return datetime.datetime.fromtimestamp(NOW + seconds, datetime.UTC).replace(tzinfo=None)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/store")


def graph(store):
    now = store.current()
    of = {r.id: bytes(r.pubkey) for r in now.pubkeys.collect()}
    return {(of[r.follower_id], of[r.followee_id]) for r in now.follows.collect()}


def status(store):
    return {bytes(r.pubkey): r.status for r in store.current().pubkeys.collect()}


def scan_of(spark, events):
    everything = frame(spark, events)
    return lambda asked: everything.join(asked.select(F.col("author").alias("pubkey")), "pubkey", "left_semi").select(everything.columns)


def test_crawl_reaches_what_is_reachable(spark, store):
    lists = {1: (2, 3), 2: (4,), 3: (4, 5), 4: (), 5: (), 99: (1,)}
    stats = C.crawl(store, key(1), C.Sources(scan_of(spark, [follows(a, NOW, *f) for a, f in lists.items()])), clock=lambda: NOW)
    assert graph(store) == {(key(a), key(b)) for a, f in lists.items() if a != 99 for b in f}
    assert status(store) == {key(a): "fetched" for a in (1, 2, 3, 4, 5)}
    assert (stats.claimed, stats.waves) == (5, 3)
    again = C.crawl(store, key(1), C.Sources(scan_of(spark, [])), clock=lambda: NOW)
    assert again.claimed == 0


def test_a_failed_scan_costs_attempts_until_failed(spark, store):
    def broken(asked):
        raise C.SourceError("no answer")

    stats = C.crawl(store, key(1), C.Sources(broken), clock=lambda: NOW)
    row = store.current().pubkeys.collect()[0]
    assert (stats.waves, row.status, row.fetch_attempts, row.claimed_at, row.last_fetched_at) == (3, "failed", 3, None, at(0))


def test_claims_of_a_dead_run_are_put_back(spark, store):
    base = C.seed(store, key(1))
    store.commit(base, pubkeys=settled(frontier.claim(base.pubkeys, 9, F.timestamp_seconds(F.lit(NOW))), "p"))
    stats = C.crawl(store, key(1), C.Sources(scan_of(spark, [follows(1, NOW)])), clock=lambda: NOW)
    assert (stats.reclaimed, stats.claimed) == (1, 1)


def test_fallback_finds_missed_authors(spark, store):
    relay_list = event(2, NOW, [["r", "wss://w.example"], ["r", "wss://r.example", "read"]], kind=10002)
    asked_urls = []

    def write_scan(asked):
        asked_urls.extend(r.url for r in asked.collect())
        return frame(spark, [follows(2, NOW, 3)])

    sources = C.Sources(scan_of(spark, [follows(1, NOW, 2, 4)]), write_scan, scan_of(spark, [relay_list]))
    C.crawl(store, key(1), sources, clock=lambda: NOW)
    assert status(store) == {key(1): "fetched", key(2): "fetched", key(4): "not_found", key(3): "not_found"}
    assert graph(store) == {(key(1), key(2)), (key(1), key(4)), (key(2), key(3))}
    assert set(asked_urls) == {"wss://w.example"}
    assert {(r.url, r.marker) for r in store.current().pubkey_relays.collect()} == {("wss://w.example", "both"), ("wss://r.example", "read")}
    assert all(r.fetch_attempts == 0 for r in store.current().pubkeys.collect())


# the edge diff


def state_of(spark, *ids):
    rows = [(i, key(i), "discovered", None, None, None, 0, 0, None, None, None, 0) for i in ids]
    return spark.createDataFrame(rows, PUBKEYS)


def list_of(spark, event_id: bytes, created: int, *followees):
    return spark.createDataFrame([(1, event_id, at(created), list(followees))], "id long, event_id binary, created_at timestamp, followee_ids array<long>")


def test_edge_diff_sequence(spark):
    state, edges = state_of(spark, 1, 2, 3, 4), spark.createDataFrame([], "follower_id long, followee_id long")
    seen = []
    for event_id, created, followees in ((b"a", 0, (2, 3, 1)), (b"b", 5, (3, 4)), (b"b", 5, (3, 4)), (b"c", 6, (3, 4))):
        state, edges = edge_diff.apply_lists(state, edges, list_of(spark, event_id, created, *followees), at(created))
        state, edges = settled(state, "s"), settled(edges, "e")
        row = state.where("id = 1").first()
        seen.append((sorted(r.followee_id for r in edges.collect()), row.fetch_count, row.change_count, bytes(row.applied_event_id), row.last_changed_at))
    assert seen == [([2, 3], 1, 1, b"a", at(0)), ([3, 4], 2, 2, b"b", at(5)), ([3, 4], 3, 2, b"b", at(5)), ([3, 4], 4, 2, b"c", at(5))]
    assert state.where("id = 2").first().status == "discovered"


@pytest.mark.parametrize("guard", [False, True])
def test_an_older_event_in_a_later_batch(spark, guard):
    state, edges = state_of(spark, 1, 2, 3), spark.createDataFrame([], "follower_id long, followee_id long")
    for event_id, created, followees in ((b"n", 10, (2,)), (b"o", 3, (3,))):
        state, edges = (settled(x, "x") for x in edge_diff.apply_lists(state, edges, list_of(spark, event_id, created, *followees), at(20), guard))
    assert [r.followee_id for r in edges.collect()] == ([2] if guard else [3])


# the frontier


def test_transitions(spark):
    rows = [
        (1, "in_progress", None, at(-360), 1), (2, "in_progress", None, at(0), 2), (3, "fetched", at(-72 * 3600), None, 2), (4, "failed", at(-24 * 3600), None, 3),
        (5, "not_found", at(-24 * 3600 - 1), at(-9), 0), (6, "discovered", None, None, 0), (7, "fetched", None, None, 0),
    ]
    state = spark.createDataFrame(rows, "id long, status string, last_fetched_at timestamp, claimed_at timestamp, fetch_attempts short")
    now = F.lit(at(0))

    def changed(after):
        return {r.id: tuple(r)[1:] for r in after.collect() if tuple(r) not in set(rows)}

    assert changed(frontier.reclaim_expired(state, now, 300)) == {1: ("discovered", None, None, 0)}
    assert changed(frontier.reclaim_expired(state, now, 360)) == {}
    assert changed(frontier.reclaim_by_ttl(state, now, 86_400)) == {3: ("discovered", at(-72 * 3600), None, 0), 5: ("discovered", at(-24 * 3600 - 1), None, 0)}
    assert set(changed(frontier.reclaim_at_start(state))) == {1, 2}
    bumped = changed(frontier.requeue_or_fail(state, state.where("status = 'in_progress'"), now))
    assert bumped == {1: ("discovered", None, None, 2), 2: ("failed", at(0), None, 3)}
    assert frontier.affected(state, frontier.reclaim_at_start(state)).first().affected == 2
    counts = frontier.counts(state).first()
    assert (counts.total, counts.in_progress, counts.coverage) == (7, 2, 2 / 7)
    assert frontier.counts(state.limit(0)).first().coverage == 0.0


def test_claims_are_disjoint(spark, store):
    store.bootstrap()
    base = store.current()
    store.commit(base, pubkeys=settled(with_keys(base.pubkeys, spark.createDataFrame([(key(i),) for i in range(1, 41)], "pubkey binary")), "p"))
    taken = []
    for _ in range(2):
        base = store.current()
        taken.append({r.id for r in frontier.claimable(base.pubkeys, 25).collect()})
        store.commit(base, pubkeys=settled(frontier.claim(base.pubkeys, 25, F.lit(at(0))), "p"))
    assert taken[0] == set(range(1, 26)) and taken[1] == set(range(26, 41))


# the store


def test_readers_keep_their_version(spark, store):
    old = store.bootstrap()
    assert store.bootstrap().version == old.version
    C.crawl(store, key(1), C.Sources(scan_of(spark, [follows(1, NOW, 2)])), clock=lambda: NOW)
    assert old.pubkeys.count() == 0 and old.follows.count() == 0
    assert store.current().follows.count() == 1
    with pytest.raises(RuntimeError):
        store.commit(old, pubkeys=old.pubkeys)


def test_contract_views(spark, store):
    C.crawl(store, key(1), C.Sources(scan_of(spark, [follows(1, NOW, 2, 3), follows(2, NOW, 3)])), clock=lambda: NOW)
    views.register(store.current())
    assert spark.sql("SELECT count(*) AS n FROM follow_edges e JOIN pubkey_lookup l ON l.id = e.followee_id").first().n == 3
    assert spark.table("pubkey_freshness").columns == ["id", "status", "last_fetched_at"]
    spark.catalog.dropTempView("follow_edges"), spark.catalog.dropTempView("pubkey_lookup"), spark.catalog.dropTempView("pubkey_freshness")
    store.current().pubkeys.write.mode("overwrite").saveAsTable("base_pubkeys")
    store.current().follows.write.mode("overwrite").saveAsTable("base_follows")
    views.create_views(spark, "base_pubkeys", "base_follows")
    about = spark.sql("DESCRIBE TABLE EXTENDED pubkey_freshness").collect()
    assert any("PUBLIC CONTRACT" in (r.comment or "") for r in about) and any("PUBLIC CONTRACT" in (r.data_type or "") for r in about)


# the relay source


def test_relay_source(spark, tmp_path):
    relay_source.register(spark)
    events = [follows(a, NOW - i, 2, 3) for a, i in itertools.product((1, 2), range(7))] + [follows(9, NOW, 1)]
    for n, relay in enumerate(("a", "b")):
        (tmp_path / relay).mkdir()
        with (tmp_path / relay / "0.jsonl").open("w") as f:
            for e in events[n:]:
                f.write(json.dumps({k: v.hex() if isinstance(v, bytes) else v for k, v in e.items() if k != "relay_url"}) + "\n")
    asked = ",".join(key(a).hex() for a in (1, 2))
    read = spark.read.format("relay_events").option("relays", f"{tmp_path}/a,{tmp_path}/b").option("authors", asked).option("limit", "3")
    rows = read.option("max_authors", "1").option("until", str(NOW)).load()
    assert rows.count() == 14 + 13 and rows.select("id").distinct().count() == 14
    assert read.option("until", str(NOW - 3)).load().where("created_at > %d" % (NOW - 3)).count() == 0
    with pytest.raises(Exception, match="at second"):  # two authors' events share each second
        read.option("max_authors", "2").option("limit", "2").load().count()


def test_reconnects_with_growing_waits():
    waits, tries = [], []

    def connect():
        tries.append(1)
        if len(tries) < 4:
            raise ConnectionError("refused")
        return "there"

    assert relay_source.reconnecting(connect, 3, 10, waits.append) == "there" and waits == [10, 20, 40]
    tries.clear()
    with pytest.raises(ConnectionError):
        relay_source.reconnecting(connect, 2, 200, waits.append)
    assert waits[3:] == [200, 300.0]


# streams


def test_stream_of_lists_and_of_health(spark, store, tmp_path):
    from tidegraph.streaming import live

    store.bootstrap()
    source = tmp_path / "in"
    frame(spark, [follows(1, NOW, 2), follows(1, NOW - 5, 7)]).coalesce(1).write.mode("append").parquet(str(source))
    requested = authors(spark, 1, 2)

    def go():
        live.run(spark.readStream.schema(frame(spark, []).schema).parquet(str(source)), store, requested, f"{tmp_path}/cp", lambda: NOW).awaitTermination()

    go()
    assert graph(store) == {(key(1), key(2))}
    frame(spark, [follows(1, NOW + 1, 2, 3), follows(2, NOW, 1)]).coalesce(1).write.mode("append").parquet(str(source))
    go()
    assert graph(store) == {(key(1), key(2)), (key(1), key(3)), (key(2), key(1))}

    samples = spark.createDataFrame([(1, 1, 1, 0.0), (1, 2, 2, 1.0), (2, 1, 3, 0.5)], "source long, ts long, seq long, sample double")
    samples.coalesce(1).write.parquet(f"{tmp_path}/samples")
    q = live.stream_health(spark.readStream.schema(samples.schema).parquet(f"{tmp_path}/samples")).writeStream.outputMode("update").format("memory").queryName("health").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/cp2").start()
    q.awaitTermination()
    assert {r.source: (round(r.score, 9), r.n) for r in spark.table("health").collect()} == {1: (0.79, 2), 2: (0.85, 1)}
