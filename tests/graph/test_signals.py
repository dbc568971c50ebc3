from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegraph import config
from tidegraph.functions import scalars as S
from tidegraph.operators import dictionary, limits, metrics, pagination, signals


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_scalars(spark):
    assert [one(spark, S.backoff(F.lit(n), 1.0, 300.0)) for n in (0, 1, 3, 9, 63, 64, 1000)] == [1.0, 2.0, 8.0, 300.0, 300.0, 300.0, 300.0]
    assert [one(spark, S.permits(4, F.lit(x))) for x in (1.0, 0.0, 0.625, 0.6, 0.374)] == [4, 1, 3, 2, 1]
    assert [one(spark, S.http_url(F.lit(u))) for u in ("wss://a/b", "ws://c", "ftp://d")] == ["https://a/b", "http://c", "ftp://d"]
    assert [one(spark, S.notice_class(F.lit(m))) for m in ("rate-limited: x", "blocked", " restricted : y", "Rate-limited: no", "", "a: blocked")] == ["rate_limited", "blocked", "blocked", "other", "other", "other"]
    assert [one(spark, S.clamped(F.lit(v).cast("int"), 500, 5000)) for v in (None, 0, -4, 7, 9000)] == [500, 500, 500, 7, 5000]
    assert one(spark, F.unix_seconds(S.epoch_timestamp(F.lit((1 << 63) - 1)))) == 0
    assert one(spark, S.latency_sample(F.lit(3.0))) == 0.5
    delays = [r.x for r in spark.range(200).select(S.jittered(F.lit(8.0), 1).alias("x")).collect()]
    assert 4 <= min(delays) < 5 < 7 < max(delays) <= 8


def test_limits(spark):
    docs = [("a", '{"limitation":{"max_limit":9000,"max_filters":0}}'), ("b", "{}"), ("c", "nonsense"), ("d", '{"limitation":{"max_limit":1}}' + " " * 70_000), ("e", None)]
    found = {r.url: tuple(r)[1:] for r in limits.parsed(spark.createDataFrame(docs, "url string, body string")).collect()}
    assert found == {"a": (5000, 20, 10), "b": (500, 20, 10), "c": (500, 20, 10), "d": (500, 20, 10), "e": (500, 20, 10)}


def test_health_and_probes(spark):
    rows = [("r", i, i, x) for i, x in enumerate((0.0, 0.0, 0.0, 0.0, 0.0, 1.0))]
    score = signals.health(spark.createDataFrame(rows, "source string, ts long, seq long, sample double")).first().score
    expected = 1.0
    for *_, x in rows:
        expected = 0.7 * expected + 0.3 * x
    assert score == pytest.approx(expected, abs=1e-15)
    attempts = [("r", t * 1_000_000, i, s) for i, (t, s) in enumerate(((0, 0.1), (30, 0.1), (59, 0.1), (60, 0.1), (61, 0.9), (62, 0.2), (121, 0.2)))]
    got = signals.probes(spark.createDataFrame(attempts, "source string, ts long, seq long, score double")).first()
    assert (got.allowed, got.probed, got.n) == (4, 3, 7)


def test_quota_equals_a_simulation(spark):
    rng = random.Random(4)
    rows = [("r", t, i) for i, t in enumerate(sorted(rng.randrange(5_000_000) for _ in range(80)))]
    tat, admitted, waited = 0, 0, 0
    for _, t, _ in rows:
        early = tat - 1_000_000 - t
        admitted += early <= 0
        waited += max(0, early)
        tat = max(tat, t) + 250_000
    got = signals.quota(spark.createDataFrame(rows, "source string, ts long, seq long")).first()
    assert (got.admitted, got.waited_us) == (admitted, waited)


def test_failures_restart_after_a_success(spark):
    rows = [("r", i, i, k == "f", k == "s") for i, k in enumerate("ffsfoffsf")]
    got = signals.failures(spark.createDataFrame(rows, "source string, ts long, seq long, failed boolean, reset boolean")).orderBy("seq").collect()
    assert [r.failures for r in got] == [1, 2, 0, 1, 1, 2, 3, 0, 1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 12), max_size=30), st.integers(1, 4), st.integers(0, 13))
def test_paging_has_its_closed_form(seconds, cap, start):
    """A scan fails if and only if a second up to its start holds `cap` events; else it gives all of them."""
    events = sorted(((s, i) for i, s in enumerate(seconds)), key=lambda e: (-e[0], e[1]))
    visible = [e for e in events if e[0] <= start]
    full = any(sum(s == x for s, _ in visible) >= cap for x in set(seconds))

    def fetch(until):
        return [(s, i, i) for s, i in events if s <= until][:cap]

    try:
        got = list(pagination.scanned(fetch, start, cap))
        assert not full and sorted(got) == sorted(i for _, i in visible)
    except pagination.Stalled:
        assert full


def test_stalls(spark):
    e = spark.createDataFrame([(0, 5), (0, 5), (0, 4), (1, 5), (1, 4)], "chunk long, created_at long")
    assert {r.chunk: (r.status, r.events) for r in pagination.stalls(e, 2).collect()} == {0: ("requeue", 3), 1: ("complete", 2)}


def test_ids_are_gapless_and_stable(spark):
    keys = spark.createDataFrame([(f"k{i % 300:04d}",) for i in range(1000)], "pubkey string").repartition(5)
    first = dictionary.numbered(keys, "pubkey")
    assert [tuple(r) for r in first.orderBy("id").collect()] == [(i + 1, f"k{i:04d}") for i in range(300)]
    grown = dictionary.get_or_create(first, spark.createDataFrame([("k0007",), ("a",), ("zz",), ("a",)], "pubkey string"))
    found = {r.pubkey: r.id for r in grown.collect()}
    assert found["k0007"] == 8 and (found["a"], found["zz"]) == (301, 302) and len(found) == 302
    with pytest.raises(Exception, match="key has 3 bytes"):
        dictionary.checked_keys(spark.createDataFrame([(b"abc",)], "pubkey binary")).collect()


def test_quantile_of_buckets(spark):
    b = spark.createDataFrame([("x", 1.0, 10), ("x", 2.0, 20), ("x", float("inf"), 20), ("y", 1.0, 0), ("y", 2.0, 1), ("y", float("inf"), 10)], "k string, le double, n long")
    assert {r.k: r.quantile for r in metrics.bucket_quantile(b, 0.75, "k").collect()} == {"x": 1.5, "y": 2.0}


def test_exposition(spark):
    s = spark.createDataFrame([("a", {}, 1.5), ("b", {"z": 'q"', "c": "d"}, 2.0)], "name string, labels map<string,string>, value double")
    assert [r.line for r in metrics.exposition(s).collect()] == ["a 1.5", 'b{c="d",z="q\\""} 2.0']


def test_counter_rate_counts_resets_from_zero(spark):
    s = spark.sql("SELECT timestamp_seconds(t) AS ts, v AS value FROM VALUES (0, 10D), (60, 40D), (120, 5D), (180, 15D) AS x(t, v)")
    assert metrics.counter_rate(s).first().rate == (30 + 5 + 10) / 300


SETTINGS = {"anchor_pubkey": "ab" * 32, "relays": ["wss://a"], "database_url": "x://secret", "ttl": "1d 12h", "metrics_addr": "0.0.0.0:1"}


def toml(tmp_path, **more):
    path = tmp_path / "c.toml"
    path.write_text("\n".join(f"{k} = {str(v).lower() if isinstance(v, bool) else v!r}" for k, v in (SETTINGS | more).items() if v is not None))
    return str(path)


def test_config(tmp_path):
    c = config.load(toml(tmp_path), "APP", {"APP__BATCH_SIZE": "7", "APP__NIP65_FALLBACK_ENABLED": "false", "APP__RELAYS": "wss://x, wss://y"}).validate()
    assert (c.ttl, c.concurrency, c.batch_size, c.nip65_fallback_enabled, c.relays) == (129_600, 8, 7, False, ("wss://x", "wss://y"))
    assert "secret" not in repr(c)
    with pytest.raises(ValueError, match="missing settings: ttl"):
        config.load(toml(tmp_path, ttl=None), "APP", {})


@pytest.mark.parametrize(
    "wrong", [{"anchor_pubkey": "xyz"}, {"relays": []}, {"ttl": "0s"}, {"database_url": "nothing"}, {"concurrency": 0}, {"batch_size": -1}, {"reqs_per_second": 0}, {"nip65_max_write_relays": 0}, {"per_relay_concurrency": 0}, {"relay_health_threshold": 1.5}, {"health_alpha": 0.0}]
)
def test_config_rejects(tmp_path, wrong):
    with pytest.raises(ValueError):
        config.load(toml(tmp_path, **wrong), "APP", {}).validate()


def test_bech32_key():
    assert config.public_key("npub10elfcs4fr0l0r8af98jlmgdh9c8tcxjvz9qkw038js35mp4dma8qzvjptg").hex() == "7e7e9c42a91bfef19fa929e5fda1b72e0ebc1a4c1141673e2794234d86addf4e"
    with pytest.raises(ValueError):
        config.public_key("npub10elfcs4fr0l0r8af98jlmgdh9c8tcxjvz9qkw038js35mp4dma8qzvjptq")
