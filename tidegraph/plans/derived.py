"""Follow-graph inputs derived from the driver's tables, so that operators meet real ties and duplicates.

An order is an event: its customer the author, its key the id, its date the time (in
seconds), its status the kind, its priority the relay, its line items' suppliers the
followees.  `events` are signals: the user is the source.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: 1998-01-01 and the day's end in seconds; orders after it count as future.
AS_OF = 883_612_800
NOW = "TIMESTAMP_NTZ'1998-01-01 00:00:00'"
EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(column: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, {column})")


def now() -> Column:
    return F.expr(NOW)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, author, created_at, kind, relay_url, and whether the (simulated) signature holds."""
    o = table(spark, sf_dir, "orders")
    seconds = F.expr(f"timestampdiff(SECOND, {EPOCH}, o_orderdate)")
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("author"), seconds.alias("created_at"), F.col("o_orderstatus").alias("kind"), F.col("o_orderpriority").alias("relay_url"), (F.col("o_orderkey") % 7 != 0).alias("valid"))


def signed(events: DataFrame) -> DataFrame:
    """events (id, author, created_at, valid) as signed ones: `order` is their number, and those that aren't valid were changed after signing.

    An author's secret is the hash of its number; the changed part hangs on the order.
    """
    from ..deploy import ship

    ship(events.sparkSession)
    kinds = "id binary, pubkey binary, created_at long, kind int, tags array<array<string>>, content string, sig binary, author long, order long"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ..functions import schnorr

        for b in batches:
            events = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
            secrets = {author: hashlib.sha256(f"author {author}".encode()).digest() for _, author, _, _ in events}
            keys = dict(zip(secrets, schnorr.public_keys(list(secrets.values())), strict=True))
            tagged = [[["p", hashlib.sha256(f"{order}".encode()).hexdigest()]] for order, _, _, _ in events]
            ids = [schnorr.event_id(keys[author], created, 3, tags, "") for (_, author, created, _), tags in zip(events, tagged, strict=True)]
            sigs = schnorr.sign_all([(i, secrets[author]) for i, (_, author, _, _) in zip(ids, events, strict=True)])
            rows = []
            for (order, author, created, valid), tags, i, sig in zip(events, tagged, ids, sigs, strict=True):
                public, content = keys[author], ""
                if not valid:
                    if order % 3 == 0:
                        content = "changed"
                    elif order % 3 == 1:
                        i = hashlib.sha256(i).digest()
                    else:
                        sig = sig[:40] + bytes([sig[40] ^ 1]) + sig[41:]
                rows.append({"id": i, "pubkey": public, "created_at": created, "kind": 3, "tags": tags, "content": content, "sig": sig, "author": author, "order": order})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("id", pa.binary()), ("pubkey", pa.binary()), ("created_at", pa.int64()), ("kind", pa.int32()), ("tags", pa.list_(pa.list_(pa.string()))), ("content", pa.string()), ("sig", pa.binary()), ("author", pa.int64()), ("order", pa.int64())]))

    # by author, whose key is computed once in a batch
    return events.select("id", "author", "created_at", "valid").repartition(events.sparkSession.sparkContext.defaultParallelism, "author").mapInArrow(sign, kinds)


def requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("author"))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id and followee: the tags of each event, repeats included."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("followee"))


def lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a list: id, author, created_at, followees (distinct, sorted, without the author)."""
    got = tags(spark, sf_dir).groupBy("id").agg(F.array_sort(F.collect_set("followee")).alias("followees"))
    all_events = events(spark, sf_dir).join(got, "id", "left")
    own = F.filter(F.coalesce("followees", F.array().cast("array<long>")), lambda x: x != F.col("author"))
    return all_events.withColumn("followees", own)


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, status, last_fetched_at, claimed_at, fetch_attempts, fetch_count of each customer."""
    last = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_orderdate").alias("last"), F.count(F.lit(1)).alias("n"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    k = F.col("id") % 5
    status = F.when(k == 0, "discovered").when(k == 1, "in_progress").when(k == 2, "fetched").when(k == 3, "not_found").otherwise("failed")
    return c.join(last, "id", "left").select(
        "id",
        status.alias("status"),
        F.when(k >= 2, F.col("last")).alias("last_fetched_at"),
        F.when(k == 1, F.col("last")).alias("claimed_at"),
        (F.col("id") % 3).cast("short").alias("fetch_attempts"),
        F.coalesce("n", F.lit(0)).cast("long").alias("fetch_count"),
    )


def follows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges of winners, as ids."""
    from ..operators import gate
    from ..operators.tags import edges

    e = lists(spark, sf_dir).where("valid")
    winners = gate.resolve(e, requested(spark, sf_dir), "O", AS_OF)
    return edges(winners).select(F.col("author").alias("follower_id"), F.col("followee").alias("followee_id"))


def relay_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pubkey_id, pos, url, marker: a customer's orders name relays, some more than once with different markers."""
    o = table(spark, sf_dir, "orders")
    url = F.concat(F.lit("wss://"), F.lower(F.regexp_replace("o_orderpriority", "[^A-Za-z]", "")), F.lit(".example"))
    m = F.when(F.col("o_orderkey") % 3 == 0, "read").when(F.col("o_orderkey") % 3 == 1, "write").otherwise("both")
    return o.select(F.col("o_custkey").alias("pubkey_id"), F.col("o_orderkey").alias("pos"), url.alias("url"), m.alias("marker"))


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source, ts (microseconds), seq, latency, outcome."""
    e = table(spark, sf_dir, "events")
    outcome = F.when(F.col("event_id") % 4 == 0, "timeout").when(F.col("event_id") % 4 == 1, "rate_limited").otherwise("success")
    return e.select(F.col("user_id").alias("source"), micros("ts").alias("ts"), F.col("event_id").alias("seq"), F.col("value").alias("latency"), outcome.alias("outcome"))


# the same in DuckDB

SQL_SECONDS = "CAST(epoch_us({0}) // 1000000 AS BIGINT)"

SQL = {
    "ev": f"""ev AS (SELECT o_orderkey AS id, o_custkey AS author, {SQL_SECONDS.format('o_orderdate')} AS created_at, o_orderstatus AS kind,
        o_orderpriority AS relay_url, o_orderkey % 7 <> 0 AS valid, o_orderdate FROM orders)""",
    "req": "req AS (SELECT c_custkey AS author FROM customer WHERE c_mktsegment <> 'BUILDING')",
    "win": f"""win AS (SELECT * FROM (SELECT ev.*, row_number() OVER (PARTITION BY author ORDER BY created_at DESC, id) AS rn FROM ev
        WHERE valid AND kind = 'O' AND author IN (SELECT author FROM req) AND created_at <= {AS_OF} + 3600) WHERE rn = 1)""",
    "fol": "fol AS (SELECT DISTINCT author AS follower_id, l_suppkey AS followee_id FROM win JOIN lineitem ON l_orderkey = id WHERE l_suppkey <> author)",
    "li": """li AS (SELECT ev.id, ev.author, ev.created_at, coalesce(t.f, CAST([] AS BIGINT[])) AS followees FROM ev LEFT JOIN
        (SELECT o_orderkey AS k, list_sort(list(DISTINCT l_suppkey)) AS f FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_suppkey <> o_custkey GROUP BY 1) t ON t.k = ev.id)""",
    "st": """st AS (SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN 'discovered' WHEN 1 THEN 'in_progress' WHEN 2 THEN 'fetched' WHEN 3 THEN 'not_found' ELSE 'failed' END AS status,
        CASE WHEN c_custkey % 5 >= 2 THEN d END AS last_fetched_at, CASE WHEN c_custkey % 5 = 1 THEN d END AS claimed_at, CAST(c_custkey % 3 AS SMALLINT) AS fetch_attempts, CAST(coalesce(n, 0) AS BIGINT) AS fetch_count
        FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS d, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey)""",
    "rp": """rp AS (SELECT o_custkey AS pubkey_id, o_orderkey AS pos, 'wss://' || lower(regexp_replace(o_orderpriority, '[^A-Za-z]', '', 'g')) || '.example' AS url,
        CASE o_orderkey % 3 WHEN 0 THEN 'read' WHEN 1 THEN 'write' ELSE 'both' END AS marker FROM orders)""",
    "fm": "fm AS (SELECT pubkey_id, url, marker FROM (SELECT *, row_number() OVER (PARTITION BY pubkey_id, url ORDER BY pos) AS rn FROM rp) WHERE rn = 1)",
    "sg": """sg AS (SELECT user_id AS source, CAST(epoch_us(ts) AS BIGINT) AS ts, event_id AS seq, value AS latency,
        CASE event_id % 4 WHEN 0 THEN 'timeout' WHEN 1 THEN 'rate_limited' ELSE 'success' END AS outcome FROM events)""",
    "smp": "smp AS (SELECT *, CASE outcome WHEN 'success' THEN 1::DOUBLE / (1::DOUBLE + latency / 3::DOUBLE) WHEN 'rate_limited' THEN 0.2::DOUBLE ELSE 0::DOUBLE END AS sample FROM sg)",
}


def with_sql(*names: str, body: str) -> str:
    return "WITH " + ", ".join(SQL[n] for n in names) + " " + body
