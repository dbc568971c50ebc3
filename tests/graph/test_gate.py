from __future__ import annotations

import pytest

from tidegraph.functions import schnorr
from tidegraph.operators import gate
from tidegraph.plans.ingest import follow_lists, relay_lists

from .fixtures import authors, event, follows, frame, key

NOW = 1_700_000_000
#: Published BIP-340 vectors: secret (or none), key, auxiliary, message, signature, whether it holds.
VECTORS = [
    ("0000000000000000000000000000000000000000000000000000000000000003", "F9308A019258C31049344F85F89D5229B531C845836F99B08601F113BCE036F9", "0" * 64, "0" * 64, "E907831F80848D1069A5371B402410364BDF1C5F8307B0084C55F1CE2DCA821525F66A4A85EA8B71E482A74F382D2CE5EBEEE8FDB2172F477DF4900D310536C0", True),
    ("B7E151628AED2A6ABF7158809CF4F3C762E7160F38B4DA56A784D9045190CFEF", "DFF1D77F2A671C5F36183726DB2341BE58FEAE1DA2DECED843240F7B502BA659", "0" * 63 + "1", "243F6A8885A308D313198A2E03707344A4093822299F31D0082EFA98EC4E6C89", "6896BD60EEAE296DB48A229FF71DFE071BDE413E6D43F917DC8DCF8C78DE33418906D11AC976ABCCB20B091292BFF4EA897EFCB639EA871CFA95F6DE339E4B0A", True),
    (None, "DFF1D77F2A671C5F36183726DB2341BE58FEAE1DA2DECED843240F7B502BA659", None, "243F6A8885A308D313198A2E03707344A4093822299F31D0082EFA98EC4E6C89", "FFF97BD5755EEEA420453A14355235D382F6472F8568A18B2F057A14602975563CC27944640AC607CD107AE10923D9EF7A73C643E166BE5EBEAFA34B1AC553E2", False),
]


@pytest.mark.parametrize(("secret", "public", "auxiliary", "message", "signature", "holds"), VECTORS)
def test_published_vectors(secret, public, auxiliary, message, signature, holds):
    if secret:
        assert schnorr.public_key(bytes.fromhex(secret)) == bytes.fromhex(public)
        assert schnorr.sign(bytes.fromhex(message), bytes.fromhex(secret), bytes.fromhex(auxiliary)) == bytes.fromhex(signature)
    assert schnorr.verify(bytes.fromhex(message), bytes.fromhex(public), bytes.fromhex(signature)) is holds


def lists(spark, events, *seeds, **options):
    return {bytes(r.author): (bytes(r.id), {bytes(f) for f in r.followees}) for r in follow_lists(frame(spark, events), authors(spark, *seeds), NOW, **options).collect()}


def test_forged_unsolicited_and_wrong_kind(spark):
    good = follows(1, NOW, 2)
    forged = good | {"content": "changed"}
    assert lists(spark, [good, forged, follows(9, NOW, 2), follows(1, NOW + 5, 3, kind=1)], 1) == {key(1): (good["id"], {key(2)})}
    assert lists(spark, [forged], 1) == {}


def test_a_forged_copy_does_not_take_the_id(spark):
    good = follows(1, NOW, 2, 3)
    squat = good | {"tags": [["p", key(4).hex()]]}
    assert lists(spark, [squat, squat, good, good | {"relay_url": "wss://b"}], 1) == {key(1): (good["id"], {key(2), key(3)})}


def test_newest_wins_with_clamp_and_ties(spark):
    old, new, edge, future = follows(1, NOW - 10, 2), follows(1, NOW, 3), follows(1, NOW + 3600, 5), follows(1, NOW + 3601, 4)
    assert lists(spark, [old, new, future], 1)[key(1)][0] == new["id"]
    assert lists(spark, [edge, old, new], 1)[key(1)][0] == edge["id"]
    assert lists(spark, [future], 1) == {}
    twins = [follows(1, NOW, 2), follows(1, NOW, 3), follows(1, NOW, 4)]
    for order in (twins, twins[::-1]):
        assert lists(spark, order, 1)[key(1)][0] == min(t["id"] for t in twins)


def test_clamp_saturates(spark):
    rows = spark.createDataFrame([((1 << 63) - 1,)], "created_at long")
    assert gate.not_future(rows, (1 << 63) - 10, 3600).count() == 1


def test_tags(spark):
    tags = [["p", "zz"], ["t", "x"], ["p"], [], ["p", key(2).hex(), "wss://r"], ["p", key(2).hex()], ["p", key(1).hex()], ["p", key(3).hex().upper()]]
    assert lists(spark, [event(1, NOW, tags)], 1)[key(1)][1] == {key(2)}


def test_the_cap_drops_the_author(spark):
    wide, old = follows(1, NOW, *range(2, 8)), follows(1, NOW - 1, 2)
    assert lists(spark, [wide, old], 1, cap=5) == {}
    assert len(lists(spark, [wide, old], 1, cap=6)[key(1)][1]) == 6


def test_relay_lists(spark):
    tags = [["r", "wss://x.example/"], ["r", "wss://y.example", "read"], ["r", "wss://z.example", "write"], ["r", "http://no"], ["r", "wss://w", "odd"], ["p", "wss://q"], ["r"]]
    found = relay_lists(frame(spark, [event(1, NOW, tags, kind=10002), event(1, NOW - 5, [], kind=10002)]), authors(spark, 1), NOW).collect()
    assert [(r.url, r.marker) for r in found[0].relays] == [("wss://x.example", "both"), ("wss://y.example", "read"), ("wss://z.example", "write")]


def test_reject_reasons(spark):
    rows = [(1, 1, 10, 3, True), (2, 1, 10, 3, False), (3, 9, 10, 3, False), (4, 9, 10, 3, True), (5, 1, 10, 4, True), (6, 1, 5000, 3, True)]
    e = spark.createDataFrame(rows, "id long, author long, created_at long, kind int, valid boolean")
    found = {r.reason: r.n for r in gate.reject_counts(e, spark.createDataFrame([(1,)], "author long"), 3, 10, 100).collect()}
    assert found == {"accepted": 1, "invalid_signature": 2, "unsolicited": 2, "future_dated": 1}


def test_one_row_per_author_leaves_each_task(spark, medium):
    from tidegraph.plans import catalog

    plan = catalog.newest_wins_lists(spark, medium)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan
