"""The daemon's setting turns the fallback off."""

from __future__ import annotations

import pytest

from tidegraph.config import Config
from tidegraph.plans import daemon as D
from tidegraph.plans.crawl import Sources, Stats

from .fixtures import key


@pytest.mark.parametrize("enabled", [True, False])
def test_fallback_can_be_turned_off(monkeypatch, enabled):
    config = Config(key(1).hex(), ("wss://a",), "x://y", 3600.0, "127.0.0.1:0", idle_poll_interval=0.01, progress_interval=1e9, nip65_fallback_enabled=enabled)
    daemon, seen = D.Daemon(None, config, Sources("lists", "write", "relay"), lambda: 0.0), []
    monkeypatch.setattr(D, "crawl", lambda store, anchor, sources, *a, **b: seen.append(sources) or daemon.stop.set() or Stats(0, 0, 0))
    monkeypatch.setattr(daemon, "due", lambda *a: False)
    daemon.run()
    assert seen == [Sources("lists", "write", "relay") if enabled else Sources("lists")]
