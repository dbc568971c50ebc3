"""Equal events of many relays are verified once."""

from __future__ import annotations

from collections import Counter

from tidegraph.operators import gate

from .fixtures import follows, frame

NOW = 1_700_000_000


def test_copies_are_verified_once(spark):
    good = follows(1, NOW, 2)
    forged = good | {"content": "changed"}
    rows = [good | {"relay_url": f"wss://{i}"} for i in range(6)] + [good | {"relay_url": None}, good | {"relay_url": "wss://0"}, forged | {"relay_url": "wss://0"}]
    events = frame(spark, rows).repartition(4)
    checked = gate.with_signature_check(events)
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("MapInPandas") < plan.index("Aggregate")  # grouped, then verified, then given back
    assert checked.columns == [*events.columns, "valid"]
    assert Counter((r.relay_url, r.content, r.valid) for r in checked.collect()) == Counter((x["relay_url"], x["content"], x["content"] != "changed") for x in rows)
