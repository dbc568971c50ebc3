"""The breadth-first search over whole tables and odd shapes, against a plain one."""

from __future__ import annotations

from collections import defaultdict

import duckdb

from tidegraph.operators import bfs
from tidegraph.plans import catalog


def plain(edges, anchor) -> dict:
    of = defaultdict(list)
    for a, b in edges:
        of[a].append(b)
    hop, front = {anchor: 0}, [anchor]
    while front:
        front = [b for a in front for b in of[a] if b not in hop and not hop.update({b: hop[a] + 1})]
    return hop


def test_query_searches_whole_tables(spark, small):
    edges = set()
    for c, s, flag in duckdb.sql(f"SELECT o_custkey, l_suppkey, l_returnflag FROM '{small}/orders.parquet' JOIN '{small}/lineitem.parquet' ON l_orderkey = o_orderkey").fetchall():
        edges.add((f"c{c}", f"s{s}"))
        if flag == "R":
            edges.add((f"s{s}", f"c{c}"))
    first = duckdb.sql(f"SELECT min(c_custkey) FROM '{small}/customer.parquet'").fetchall()[0][0]
    assert {r.node: r.hop for r in catalog.QUERIES["bfs_hops"](spark, small).collect()} == plain(edges, f"c{first}")


def test_hub_and_long_chain(spark):
    """A hub that all nodes point at and that points at all, then a chain longer than the slice's 20 hops, with a cycle."""
    edges = [("a", "hub"), *[("hub", f"n{i}") for i in range(2000)], *[(f"n{i}", "hub") for i in range(2000)]]
    edges += [("n7", "p0"), *[(f"p{i}", f"p{i + 1}") for i in range(24)], ("p24", "a"), ("far", "a")]
    found = {r.node: r.hop for r in bfs.hops(spark.createDataFrame(edges, "src string, dst string"), "a").collect()}
    assert found == plain(edges, "a") and found["p24"] == 27 and "far" not in found
