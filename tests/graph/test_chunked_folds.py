"""Folds in chunks by time give what folds of whole histories give."""

from __future__ import annotations

import random

import pytest

from tidegraph.operators import signals as S


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    out = [(rng.choice(["hot", "hot", "hot", "a", "b"]), rng.randrange(0, 400) * 100_000, i, rng.random(), rng.random() < 0.5, rng.random() < 0.06) for i in range(600)]
    return spark.createDataFrame(out, "source string, ts long, seq long, sample double, failed boolean, reset boolean").cache()


def both(make, monkeypatch):
    whole = {tuple(r) for r in make().collect()}
    monkeypatch.setattr(S, "CHUNK", 40)
    return whole, {tuple(r) for r in make().collect()}


def test_health(rows, monkeypatch):
    whole, parts = both(lambda: S.health(rows), monkeypatch)
    assert {(s, round(x, 12), n) for s, x, n in whole} == {(s, round(x, 12), n) for s, x, n in parts} and len(parts) == 3


def test_health_from_a_score(spark, rows, monkeypatch):
    before = spark.createDataFrame([("a", 0.25)], "source string, score double")
    few = rows.where("source = 'a' and seq < 60")
    whole, parts = both(lambda: S.health(few, before=before), monkeypatch)
    assert whole == parts
    score = 0.25
    for r in few.orderBy("ts", "seq").collect():
        score = score * 0.7 + 0.3 * r.sample
    assert abs(next(iter(whole))[1] - score) < 1e-12


def test_quota(rows, monkeypatch):
    whole, parts = both(lambda: S.quota(rows.select("source", "ts", "seq"), step=250_000, burst=4), monkeypatch)
    assert whole == parts and any(w for _, _, w, _ in whole)


def test_failures(rows, monkeypatch):
    whole, parts = both(lambda: S.failures(rows).select("source", "seq", "failures"), monkeypatch)
    assert whole == parts and max(f for *_, f in whole) > 5


def test_failures_after_a_known_number(spark, rows):
    before = spark.createDataFrame([("a", 7), ("b", 0), ("hot", 2)], "source string, failures long")
    last = {}
    for r in S.failures(rows).orderBy("ts", "seq").collect():
        last[r.source] = r.failures
    assert {r.source: r.failures for r in S.failures_after(rows, before).collect()} == last
    none = rows.where("not reset and source = 'a'")
    assert S.failures_after(none, before).first().failures == 7 + none.where("failed").count()


def test_in_use(rows, monkeypatch):
    fetches = rows.selectExpr("source", "seq", "ts as start", "ts + 1500000 + seq % 7 * 100000 as end")
    whole, parts = both(lambda: S.in_use(fetches), monkeypatch)
    assert whole == parts and max(m for _, m in whole) > 10
