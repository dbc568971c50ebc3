"""The store: what a commit writes, concurrent writers, retention, older schemas."""

from __future__ import annotations

import json
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidegraph import store as S
from tidegraph.operators import dictionary, frontier
from tidegraph.plans import crawl as C
from tidegraph.plans.ingest import new_vertices
from tidegraph.store import Conflict, Store, Table

from .fixtures import key

NOW = 1_700_000_000


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/store")
    s.bootstrap()
    return s


def pairs(df):
    return {(r.follower_id, r.followee_id) for r in df.collect()}


def edges(spark, rows):
    return spark.createDataFrame(rows, "follower_id long, followee_id long")


def owners(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "follower_id long")


def files(root: Path) -> dict[str, int]:
    return {str(f): f.stat().st_size for f in root.rglob("*.parquet")}


def test_a_small_wave_writes_little_of_a_large_store(spark, store, tmp_path):
    many = spark.range(1_000_000).select((F.col("id") % 50_000).alias("follower_id"), (F.col("id") * 7919 % 1_000_003 + 50_000).alias("followee_id"))
    base = store.commit(store.current(), follows=many)
    assert not base.tables["follows"].layers and base.tables["follows"].rows == 1_000_000  # folded into the base at once
    before = files(tmp_path)
    wave = list(range(0, 50_000, 5_000))
    after = store.commit(base, follows=(edges(spark, [(i, 1) for i in wave[:9]] + [(0, 2)]), owners(spark, wave)))
    new = {f: n for f, n in files(tmp_path).items() if f not in before}
    assert len(new) <= 16 and sum(new.values()) < sum(before.values()) / 100
    assert after.follows.count() == 1_000_000 - 10 * 20 + 10
    assert pairs(after.of_keys("follows", owners(spark, [0, 45_000, 1]).withColumnRenamed("follower_id", "x")).where("follower_id <> 1")) == {(0, 1), (0, 2)}
    assert base.follows.count() == 1_000_000


def test_layers_fold_into_the_buckets_they_touch(spark, store, monkeypatch):
    monkeypatch.setattr(S, "LAYERS", 2)
    first = store.commit(store.current(), follows=edges(spark, [(i, i + 1) for i in range(200)]))
    expected = {(i, i + 1) for i in range(200)}
    state = first
    for n in range(1, 9):  # the newest layer wins, also over one that was folded
        state = store.commit(state, follows=(edges(spark, [(7, 100 + n), (8, n)] if n % 2 else [(7, 100 + n)]), owners(spark, [7, 8])))
        expected = {e for e in expected if e[0] not in (7, 8)} | {(7, 100 + n)} | ({(8, n)} if n % 2 else set())
        assert pairs(state.follows) == expected and len(state.tables["follows"].layers) <= 2
        if not state.tables["follows"].layers and first.tables["follows"].layers:
            first = state
    before, after = first.tables["follows"].base, state.tables["follows"].base
    assert before and 0 < sum(before.get(b) != after.get(b) for b in {*before, *after}) <= 2
    assert state.tables["follows"].rows + sum(x["rows"] for x in state.tables["follows"].layers) >= len(expected)


def test_buckets_follow_the_table(spark, store, monkeypatch):
    monkeypatch.setattr(S, "BUCKET_ROWS", 10)
    monkeypatch.setattr(S, "FEW", 5)
    state = store.commit(store.current(), follows=edges(spark, [(i, j) for i in range(100) for j in range(1000, 1020)]))
    assert state.tables["follows"].buckets >= 100 and len(state.tables["follows"].base) > 40
    state = store.commit(state, follows=edges(spark, [(3, 1), (200, 2)]))
    assert state.follows.count() == 2000 - 20 + 2 and pairs(state.of_keys("follows", owners(spark, [3, 200]))) == {(3, 1), (200, 2)}


def test_of_two_commits_one_fails_and_nothing_is_lost(spark, store):
    base = store.current()
    barrier, outcomes = threading.Barrier(2), []
    monkey = store._create

    def together(version, tables):
        barrier.wait(60)  # both have written their files and found the same version
        monkey(version, tables)

    def commit(n):
        s = Store(spark, store.root)
        s._create = together
        try:
            s.commit(base, follows=edges(spark, [(n, 5)]))
            outcomes.append("done")
        except Conflict:
            outcomes.append("conflict")

    threads = [threading.Thread(target=commit, args=(n,)) for n in (1, 2)]
    [t.start() for t in threads]
    [t.join(120) for t in threads]
    assert sorted(outcomes) == ["conflict", "done"] and store.current().follows.count() == 1
    with pytest.raises(Conflict):
        store.commit(base, follows=edges(spark, [(9, 9)]))


def test_concurrent_claims_are_disjoint(spark, store):
    store.commit(store.current(), pubkeys=new_vertices(store.current().pubkeys, spark.createDataFrame([(key(i),) for i in range(1, 41)], "pubkey binary")))
    taken: list[set] = []

    def claim():
        while (got := C.claim_wave(Store(spark, store.root), 15, 4, NOW)) is not None:
            taken.append({r.id for r in got.collect()})

    threads = [threading.Thread(target=claim) for _ in range(2)]
    [t.start() for t in threads]
    [t.join(240) for t in threads]
    assert sorted(i for t in taken for i in t) == list(range(1, 41))
    assert store.current().pubkeys.where("status = 'in_progress' and claimed_at is not null").count() == 40


def test_nothing_to_change_writes_nothing(spark, store):
    C.seed(store, key(1))
    version = store.current().version
    C.seed(store, key(1))
    assert C.reenqueue_stale(store, NOW, 60) == 0 and C.claim_wave(store, 0, 4, NOW) is None
    assert store.current().version == version


def test_old_versions_go_with_their_files(spark, store, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "RETAINED", 3)
    monkeypatch.setattr(S, "LAYERS", 1)
    state = store.current()
    for n in range(9):
        state = store.commit(state, follows=edges(spark, [(1, n), (100 + n, 1)]))
    assert len(store._versions()) == 3
    assert pairs(store.current().follows) == {(1, 8)} | {(100 + n, 1) for n in range(9)}
    kept = {f.removeprefix("file://").removeprefix("file:") for v in store._versions() for t in store._load(v)[1].values() for f in t.folders()}
    assert all(any(str(f).startswith(k) for k in kept) for f in tmp_path.rglob("*.parquet"))


def test_an_older_schema_is_made_new(spark, store, tmp_path):
    home = tmp_path / "old"
    old = spark.createDataFrame([(1, key(1), "fetched")], "id long, pubkey binary, status string")
    old.write.parquet(f"file://{home}/b")
    s = Store(spark, f"file://{tmp_path}/aged")
    tables = {"pubkeys": Table(1, 1, {"0": f"file://{home}/b"}).__dict__ | {"layers": []}, "follows": Table().__dict__ | {"layers": []}}
    (tmp_path / "aged" / "versions").mkdir(parents=True)
    (tmp_path / "aged" / "versions" / f"{4:012d}.json").write_text(json.dumps({"schema": 1, "tables": tables}))
    with pytest.raises(ValueError, match="bootstrap"):
        s.current()
    now = s.bootstrap()
    assert now.version == 5 and s.bootstrap().version == 5 and now.pubkey_relays.count() == 0
    row = now.pubkeys.first()
    assert (row.id, row.status, row.claimed_at) == (1, "fetched", None)
    put = s.commit(now, pubkeys=frontier.reclaim_at_start(now.pubkeys.withColumn("status", F.lit("in_progress")), only=True))
    assert put.pubkeys.first().status == "discovered" and put.pubkeys.first().fetch_attempts == 0
    (tmp_path / "aged" / "versions" / f"{7:012d}.json").write_text(json.dumps({"schema": 99, "tables": {}}))
    with pytest.raises(ValueError, match="newer"):
        s.current()


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_ids_are_gapless_whatever_is_reused(spark, reuse):
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        keys = spark.range(400_000).select(F.sha2(F.col("id").cast("string"), 256).alias("pubkey"))
        found = dictionary.numbered(keys.unionByName(keys.limit(1000)), "pubkey", after=10, parts=7)
        r = found.agg(F.count("id"), F.countDistinct("id"), F.min("id"), F.max("id")).first()
        assert tuple(r) == (400_000, 400_000, 11, 400_010)
        again = found.withColumn("before", F.expr("lag(pubkey) over (order by id)"))
        assert again.where("before >= pubkey").count() == 0
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
