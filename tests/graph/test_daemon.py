from __future__ import annotations

import threading
import urllib.error
import urllib.request

import pytest
from pyspark.sql import functions as F

from tidegraph.config import Config
from tidegraph.plans import daemon as D
from tidegraph.plans.crawl import Sources
from tidegraph.store import Store

from .fixtures import follows, frame, key

NOW = 1_700_000_000


def get(server, path):
    try:
        with urllib.request.urlopen(f"http://127.0.0.1:{server.server_address[1]}{path}", timeout=30) as r:
            return r.status, r.read().decode()
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode()


def test_the_loop_refreshes_and_answers(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    everything = frame(spark, [follows(1, NOW, 2)])
    clock = [float(NOW)]
    asked = []

    def scan(authors):
        asked.append(authors.count())
        return everything.join(authors.select(F.col("author").alias("pubkey")), "pubkey", "left_semi").select(everything.columns)

    config = Config(key(1).hex(), ("wss://a",), "x://y", 3600.0, "127.0.0.1:0", idle_poll_interval=0.05, staleness_scan_interval=10.0, reclaim_interval=10.0, progress_interval=0.0).validate()
    d = D.Daemon(store, config, Sources(scan), lambda: clock[0])
    server = D.serve(d, config.metrics_addr)
    assert get(server, "/health/ready")[0] == 503 and get(server, "/health/live") == (200, "ok") and get(server, "/nothing")[0] == 404
    thread = threading.Thread(target=d.run)
    thread.start()

    def until(what):
        for _ in range(1200):
            if what():
                return
            assert thread.is_alive()
            threading.Event().wait(0.1)
        pytest.fail("too slow")

    until(lambda: len(asked) >= 2 and "crawl_coverage_ratio 0.5" in get(server, "/metrics")[1])
    assert get(server, "/health/ready")[0] == 200 and 'staleness_age_seconds_bucket{le="+Inf"} 2.0' in get(server, "/metrics")[1]
    clock[0] += 3700  # both are stale now
    until(lambda: sum(asked) >= 4)
    d.stop.set()
    thread.join(120)
    assert not thread.is_alive() and not d.ready()
    assert store.current().pubkeys.where("status = 'in_progress'").count() == 0
    server.shutdown()


def test_limits_of_relays(spark):
    answers = {"http://a": b'{"limitation":{"max_limit":7}}', "http://b": b" " * 70_000, "http://d": b"\xff{"}

    def fetch(url):
        if url not in answers:
            raise OSError("no route")
        return answers[url]

    found = {r.url: r.max_limit for r in D.limits_documents(spark, [(f"ws://{x}", f"http://{x}") for x in "abcd"], fetch).collect()}
    assert found == {"ws://a": 7, "ws://b": 500, "ws://c": 500, "ws://d": 500}


def test_json_logs(capsys):
    D.start_logging("info", "json")
    D.log.info("hello %d", 1)
    assert '"message": "hello 1"' in capsys.readouterr().err
    D.start_logging("warning", "human")
