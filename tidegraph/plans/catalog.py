"""All registered queries over the driver's tables, and the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import bfs, dictionary, edge_diff, fallback, frontier, gate, limits, metrics, pagination, signals, tags, views
from ..store import settled
from . import derived as D
from .derived import AS_OF, with_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLE_SQL[name or f.__name__] = sql
        return f

    return register


# gate and resolution


@query(with_sql("ev", "req", "win", body="SELECT author, id AS event_id, created_at FROM win"))
def newest_wins_lists(spark, d):
    e = D.events(spark, d).where("valid")
    return gate.resolve(e, D.requested(spark, d), "O", AS_OF).select("author", F.col("id").alias("event_id"), "created_at")


@query(with_sql("ev", "req", "win", "fol", body="SELECT followee_id, count(*) AS in_degree FROM fol GROUP BY 1"))
def follow_in_degree(spark, d):
    """The flagship: gate, clamp, newest wins, tags, self follows, edges, in-degree."""
    e = D.events(spark, d).where("valid")
    winners = gate.resolve(e, D.requested(spark, d), "O", AS_OF).select("author", "id")
    edges = winners.join(D.tags(spark, d), "id").where("author <> followee").select(F.col("author").alias("follower_id"), F.col("followee").alias("followee_id")).distinct()
    return views.in_degree(edges)


@query(
    with_sql(
        "ev", "req",
        body=f"""SELECT CASE WHEN NOT valid THEN 'invalid_signature' WHEN kind <> 'O' OR author NOT IN (SELECT author FROM req) THEN 'unsolicited'
        WHEN created_at > {AS_OF} + 3600 THEN 'future_dated' ELSE 'accepted' END AS reason, count(*) AS n FROM ev GROUP BY 1""",
    )
)
def gate_reject_reasons(spark, d):
    return gate.reject_counts(D.events(spark, d), D.requested(spark, d), "O", AS_OF)


@query(with_sql("ev", "req", body="SELECT id, author FROM ev WHERE kind = 'O' AND author IN (SELECT author FROM req)"))
def solicited_events(spark, d):
    return gate.solicited(D.events(spark, d), D.requested(spark, d), "O").select("id", "author")


@query(with_sql("ev", body=f"SELECT id, created_at FROM ev WHERE created_at <= {AS_OF} + 3600"))
def future_clamp(spark, d):
    return gate.not_future(D.events(spark, d), AS_OF).select("id", "created_at")


@query(with_sql("ev", body="SELECT id, author, created_at FROM ev"))
def dedup_after_verify(spark, d):
    """A forged copy of every event comes first from another relay; the genuine ones survive, once each."""
    e = D.events(spark, d).withColumn("valid", F.lit(True))
    forged = e.withColumn("author", F.lit(-1).cast("long")).withColumn("valid", F.lit(False))
    union = forged.unionByName(e).unionByName(e.withColumn("relay_url", F.lit("other")))
    return gate.distinct_ids(union.where("valid").drop("relay_url")).select("id", "author", "created_at")


@query(with_sql("ev", "li", "req", "win", body="SELECT win.author, li.id AS event_id, CAST(len(li.followees) AS INTEGER) AS followees FROM win JOIN li ON li.id = win.id WHERE len(li.followees) > 4"))
def oversized_lists(spark, d):
    winners = gate.resolve(D.lists(spark, d).where("valid"), D.requested(spark, d), "O", AS_OF)
    return tags.oversized(winners, 4).select("author", F.col("id").alias("event_id"), F.size("followees").alias("followees"))


@query(with_sql("ev", "li", "req", "win", body="SELECT win.author, li.id AS event_id FROM win JOIN li ON li.id = win.id WHERE len(li.followees) <= 4"))
def lists_within_cap(spark, d):
    winners = gate.resolve(D.lists(spark, d).where("valid"), D.requested(spark, d), "O", AS_OF)
    return tags.within_cap(winners, 4).select("author", F.col("id").alias("event_id"))


@query(with_sql("ev", "li", body="SELECT id, array_to_string(followees, ',') AS followees, CAST(len(followees) AS INTEGER) AS n FROM li"))
def self_drop_distinct_tags(spark, d):
    return D.lists(spark, d).select("id", F.array_join("followees", ",").alias("followees"), F.size("followees").alias("n"))


@query(with_sql("ev", "req", "win", "fol", body="SELECT * FROM fol"))
def follow_edges(spark, d):
    return views.follow_edges(D.follows(spark, d))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def tag_json_extract(spark, d):
    return D.table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query(with_sql("ev", body="SELECT relay_url, count(*) AS n, min(id) AS first_id, max(created_at) AS newest FROM (SELECT relay_url, id, created_at FROM ev UNION ALL SELECT 'mirror', id, created_at FROM ev) GROUP BY 1"))
def fanout_union(spark, d):
    """The bag union of the relays' scan and a mirror's: both copies of an event count."""
    e = D.events(spark, d)
    union = e.unionByName(e.withColumn("relay_url", F.lit("mirror")))
    return union.groupBy("relay_url").agg(F.count("id").alias("n"), F.min("id").alias("first_id"), F.max("created_at").alias("newest"))


@query("SELECT o_orderkey AS id, CAST(epoch_us(o_orderdate) AS BIGINT) AS us FROM orders")
def epoch_timestamps(spark, d):
    """Seconds to a timestamp and back to microseconds."""
    stamped = D.events(spark, d).select("id", S.epoch_timestamp(F.col("created_at")).alias("t"))
    return stamped.select("id", F.unix_micros("t").alias("us"))


# signed events and tags

_NEWEST_ORDER = "(SELECT * FROM (SELECT ev.*, row_number() OVER (PARTITION BY author ORDER BY created_at DESC, id) AS rn FROM ev) WHERE rn = 1)"


@query(with_sql("ev", body=f"SELECT author, id, valid FROM {_NEWEST_ORDER}"))
def signature_check(spark, d):
    """Each customer's newest order as an event that the customer signed; of every seventh, content, id or signature was changed after."""
    checked = gate.with_signature_check(D.signed(gate.newest_wins(D.events(spark, d))))
    return checked.select("author", F.col("order").alias("id"), F.col("valid").cast("boolean").alias("valid"))


@query(with_sql("ev", body="SELECT author, id FROM (SELECT *, row_number() OVER (PARTITION BY author ORDER BY created_at DESC, id) AS rn2 FROM (SELECT ev.*, row_number() OVER (PARTITION BY author ORDER BY created_at DESC, id) AS rn FROM ev) WHERE rn <= 2 AND valid) WHERE rn2 = 1"))
def verified_winners(spark, d):
    """The newest genuine one of each customer's two newest orders, when only what can win is verified."""
    from pyspark.sql.window import Window

    rank = F.row_number().over(Window.partitionBy("author").orderBy(F.desc("created_at"), "id"))
    # ids of signed events are hashes, which would break a tie of two orders at random: the newest is made a second newer
    two = D.events(spark, d).withColumn("rn", rank).where("rn <= 2").withColumn("created_at", F.col("created_at") + 2 - F.col("rn"))
    # written, as the gate reads its events more than once
    events = settled(D.signed(two), "signed").withColumnRenamed("author", "customer").withColumnRenamed("pubkey", "author")
    winners = gate.resolve_unverified(events, events.select("author"), 3, 1 << 40)
    return winners.select(F.col("customer").alias("author"), F.col("order").alias("id"))


_P_TAGS = """t AS (SELECT l_orderkey AS id, lpad(lower(to_hex(l_suppkey)), 64, '0') AS k, l_linenumber FROM lineitem)"""


def _p_tags(spark, d):
    """Tag lists of orders: a p tag for each line item, and malformed, short, upper-case and other tags."""
    li = D.table(spark, d, "lineitem")
    name = F.lpad(F.lower(F.hex("l_suppkey")), 64, "0")
    tag = F.when(F.col("l_linenumber") == 2, F.array(F.lit("p"), F.upper(F.concat(F.lit("f"), F.substring(name, 2, 63))))).when(F.col("l_linenumber") == 3, F.array(F.lit("t"), name)).otherwise(F.array(F.lit("p"), name, F.lit("wss://hint")))
    extra = F.array(F.array(F.lit("p")), F.array(F.lit("p"), F.lit("short")), F.array().cast("array<string>"))
    return li.groupBy(F.col("l_orderkey").alias("id")).agg(F.concat(F.collect_list(tag), extra).alias("tags"))


@query(f"WITH {_P_TAGS} SELECT DISTINCT id, k AS followee FROM t WHERE l_linenumber NOT IN (2, 3) AND k <> lpad(lower(to_hex(id % 100)), 64, '0')")
def tag_followees(spark, d):
    """Followees of tag lists, whose author is the order's number modulo 100: the author and what is no key are skipped."""
    author = F.unhex(F.lpad(F.lower(F.hex(F.col("id") % 100)), 64, "0"))
    lists = _p_tags(spark, d).select("id", tags.followees(F.col("tags"), author).alias("followees"))
    return lists.select("id", F.explode("followees").alias("k")).select("id", F.lower(F.hex("k")).alias("followee"))


_R_MARKS = "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'read' WHEN 2 THEN 'write' WHEN 3 THEN 'both' ELSE 'elsewhere' END"
_R_URL = "CASE WHEN o_orderkey % 11 = 0 THEN 'https://x' ELSE 'wss://' || lower(regexp_replace(o_orderpriority, '[^A-Za-z]', '', 'g')) || repeat('/', CAST(o_orderkey % 3 AS INTEGER)) END"
_R_SQL = f"r AS (SELECT o_custkey AS author, o_orderkey AS pos, rtrim({_R_URL}, '/') AS url, coalesce({_R_MARKS}, 'both') AS marker, {_R_URL} AS raw FROM orders)"


def _r_tags(spark, d):
    """A relay list of each customer: an r tag for each of its orders, in their order."""
    o = D.table(spark, d, "orders")
    k = F.col("o_orderkey")
    url = F.when(k % 11 == 0, "https://x").otherwise(F.concat(F.lit("wss://"), F.lower(F.regexp_replace("o_orderpriority", "[^A-Za-z]", "")), F.expr("repeat('/', cast(o_orderkey % 3 as int))")))
    marked = F.element_at(F.array(*map(F.lit, ("read", "write", "both", "elsewhere"))), F.greatest(F.lit(1), (k % 5).cast("int")))
    tag = F.when(k % 5 == 0, F.array(F.lit("r"), url)).otherwise(F.array(F.lit("r"), url, marked))
    listed = F.array_sort(F.collect_list(F.struct(k.alias("k"), tag.alias("tag"))))
    return o.groupBy(F.col("o_custkey").alias("author")).agg(F.concat(F.array(F.array(F.lit("x"), F.lit("wss://no"))), F.transform(listed, lambda e: e["tag"])).alias("tags"))


@query(f"WITH {_R_SQL} SELECT author, CAST(row_number() OVER (PARTITION BY author ORDER BY pos) AS INTEGER) AS pos, url, marker FROM r QUALIFY marker IN ('read', 'write', 'both') AND url LIKE 'wss://_%'")
def tag_relay_pairs(spark, d):
    """(url, marker) of r tags with their places; no marker is both, and unknown markers and other addresses are skipped."""
    pairs = _r_tags(spark, d).select("author", F.explode(tags.relay_pairs(F.col("tags"))).alias("r"))
    return pairs.select("author", F.col("r.pos").alias("pos"), F.col("r.url").alias("url"), F.col("r.marker").alias("marker"))


@query(f"WITH {_R_SQL}, g AS (SELECT * FROM r WHERE marker IN ('read', 'write', 'both') AND url LIKE 'wss://_%') SELECT author, url, marker FROM (SELECT *, row_number() OVER (PARTITION BY author, url ORDER BY pos) AS rn FROM g) WHERE rn = 1")
def relay_list_resolve(spark, d):
    """Relay lists through the gate (an older one of each author loses) to the rows that the table keeps."""
    newest = _r_tags(spark, d).select("author", F.col("author").alias("id"), F.lit(10_002).alias("kind"), F.lit(2).cast("long").alias("created_at"), "tags")
    older = newest.withColumns({"created_at": F.lit(1).cast("long"), "tags": F.array(F.array(F.lit("r"), F.lit("wss://old")))})
    ahead = older.withColumn("created_at", F.lit(1 << 40))
    lists = gate.resolve(newest.unionByName(older).unionByName(ahead), newest.select("author"), 10_002, AS_OF)
    pairs = lists.select("author", F.explode(tags.relay_pairs(F.col("tags"))).alias("r")).select("author", F.col("r.pos").alias("pos"), F.col("r.url").alias("url"), F.col("r.marker").alias("marker"))
    return tags.first_markers(pairs, "author").select("author", "url", "marker")


# relay lists


@query(with_sql("rp", "fm", body="SELECT * FROM fm"))
def relay_list_first_marker(spark, d):
    return tags.first_markers(D.relay_pairs(spark, d), "pubkey_id").select("pubkey_id", "url", "marker")


@query(with_sql("rp", "fm", body="SELECT pubkey_id, url FROM fm WHERE marker IN ('write', 'both')"))
def write_relays(spark, d):
    return tags.write_relays(tags.first_markers(D.relay_pairs(spark, d), "pubkey_id")).select("pubkey_id", "url")


@query(with_sql("rp", "fm", body="SELECT * FROM fm WHERE pubkey_id % 2 = 1 UNION ALL SELECT pubkey_id, url, marker FROM (SELECT *, row_number() OVER (PARTITION BY pubkey_id, url ORDER BY pos) AS rn FROM rp WHERE pubkey_id % 2 = 0 AND pos % 2 = 0) WHERE rn = 1 UNION ALL SELECT * FROM fm WHERE pubkey_id % 2 = 0 AND pubkey_id NOT IN (SELECT pubkey_id FROM rp WHERE pos % 2 = 0)"))
def replace_relay_lists(spark, d):
    """New lists of the even keys replace theirs whole."""
    pairs = D.relay_pairs(spark, d)
    current = tags.first_markers(pairs, "pubkey_id").select("pubkey_id", "url", "marker")
    return tags.replace_relays(current, pairs.where("pubkey_id % 2 = 0 and pos % 2 = 0"))


@query("SELECT page_id, regexp_replace(url, '/+$', '') AS url, CASE WHEN url LIKE 'wss://%' THEN 'https://' || substr(url, 7) WHEN url LIKE 'ws://%' THEN 'http://' || substr(url, 6) ELSE url END AS http_url, CASE WHEN url LIKE 'https://%' THEN 'https://' || substr(url, 9) ELSE 'http://' || substr(url, 8) END AS round_trip FROM pages")
def relay_url_normalise(spark, d):
    p = D.table(spark, d, "pages")
    ws = F.regexp_replace("url", "^http", "ws")
    return p.select("page_id", S.relay_url(F.col("url")).alias("url"), S.http_url(F.col("url")).alias("http_url"), S.http_url(ws).alias("round_trip"))


# dictionary


@query("SELECT row_number() OVER (ORDER BY c_name) AS id, c_name AS pubkey FROM (SELECT DISTINCT c_name FROM customer)")
def dictionary_ids(spark, d):
    return dictionary.numbered(D.table(spark, d, "customer").select(F.col("c_name").alias("pubkey")), "pubkey")


@query(
    """WITH old AS (SELECT row_number() OVER (ORDER BY c_name) AS id, c_name AS pubkey FROM customer WHERE c_mktsegment = 'BUILDING'),
    new AS (SELECT (SELECT coalesce(max(id), 0) FROM old) + row_number() OVER (ORDER BY c_name) AS id, c_name AS pubkey FROM customer WHERE c_mktsegment <> 'BUILDING')
    SELECT * FROM old UNION ALL SELECT * FROM new"""
)
def dictionary_get_or_create(spark, d):
    c = D.table(spark, d, "customer").select("c_mktsegment", F.col("c_name").alias("pubkey"))
    old = dictionary.numbered(c.where("c_mktsegment = 'BUILDING'"), "pubkey")
    return dictionary.get_or_create(old, c.select("pubkey"))


@query(with_sql("ev", "req", "win", "fol", body="SELECT f.c_name AS follower, t.s_name AS followee FROM fol JOIN customer f ON f.c_custkey = follower_id JOIN supplier t ON t.s_suppkey = followee_id"))
def boundary_join(spark, d):
    """Ids resolved to names at the end."""
    c = D.table(spark, d, "customer").select(F.col("c_custkey").alias("follower_id"), F.col("c_name").alias("follower"))
    s = D.table(spark, d, "supplier").select(F.col("s_suppkey").alias("followee_id"), F.col("s_name").alias("followee"))
    return D.follows(spark, d).join(c, "follower_id").join(s, "followee_id").select("follower", "followee")


_DICTIONARY_SQL = "dc AS (SELECT row_number() OVER (ORDER BY k) AS id, k FROM (SELECT c_name AS k FROM customer UNION SELECT s_name FROM supplier))"


@query(with_sql("ev", "req", "win", "fol", body="").strip() + f", {_DICTIONARY_SQL} SELECT a.id AS follower_id, b.id AS followee_id FROM fol JOIN customer ON c_custkey = follower_id JOIN supplier ON s_suppkey = followee_id JOIN dc a ON a.k = c_name JOIN dc b ON b.k = s_name")
def key_resolution(spark, d):
    """Edges of keys to edges of surrogate ids."""
    c, s = (D.table(spark, d, t).select(F.col(f"{t[0]}_{k}").alias("n"), F.col(f"{t[0]}_name").alias("name")) for t, k in (("customer", "custkey"), ("supplier", "suppkey")))
    known = dictionary.numbered(c.union(s).select(F.col("name").alias("pubkey")), "pubkey")
    f = D.follows(spark, d).join(c.toDF("follower_id", "author"), "follower_id").join(s.toDF("followee_id", "followee"), "followee_id")
    return dictionary.resolved(f.select("author", "followee"), known)


@query("SELECT row_number() OVER (ORDER BY c_custkey) AS id, lpad(lower(to_hex(c_custkey)), 64, '0') AS pubkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'fetched' ELSE 'discovered' END AS status FROM customer ORDER BY 1".replace("ORDER BY c_custkey", "ORDER BY c_mktsegment <> 'BUILDING', c_custkey"))
def seeded_vertices(spark, d):
    """New keys become discovered vertices behind the known ones, which stay as they are."""
    from ..schemas import PUBKEYS
    from .ingest import with_keys

    c = D.table(spark, d, "customer").select((F.col("c_mktsegment") == "BUILDING").alias("known"), F.unhex(F.lpad(F.lower(F.hex("c_custkey")), 64, "0")).alias("pubkey"))
    old = dictionary.numbered(c.where("known"), "pubkey")
    values = {"status": F.lit("fetched"), "fetch_count": F.lit(1), "change_count": F.lit(1), "fetch_attempts": F.lit(0)}
    state = old.select(*[F.col(f.name) if f.name in ("id", "pubkey") else values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PUBKEYS.fields])
    return with_keys(state, c.select("pubkey")).select("id", F.lower(F.hex("pubkey")).alias("pubkey"), "status")


_WAVE_SQL = "w AS (SELECT author, followees, rn FROM (SELECT *, row_number() OVER (PARTITION BY author ORDER BY created_at DESC, id) AS rn FROM li) WHERE rn <= 2)"


@query(with_sql("ev", "li", body="").strip() + f", {_WAVE_SQL} SELECT author AS follower_id, unnest(followees) AS followee_id FROM w WHERE rn = CASE WHEN author % 10 = 3 THEN 1 ELSE 2 END")
def wave_apply(spark, d):
    """A store of every author's last list but one, after a wave brought a tenth of the authors their last: written as a layer, read merged."""
    from ..store import Store, fresh

    new, old = _newest_two(spark, d)
    store = Store(spark, fresh(spark, "wave"))
    base = store.commit(store.bootstrap(), follows=old)
    touched = _newest_lists(spark, d).where("author % 10 = 3 and rn = 1").select("author")
    return store.commit(base, follows=(new.where("follower_id % 10 = 3"), touched)).follows


@query(with_sql("ev", "li", body="").strip() + f", {_WAVE_SQL}, n AS (SELECT author, followees FROM w WHERE rn = 1), o AS (SELECT author, followees FROM w WHERE rn = 2) SELECT n.author AS id, 'fetched' AS status, 2 AS fetch_count, CAST(CASE WHEN list_sort(n.followees) <> list_sort(coalesce(o.followees, CAST([] AS BIGINT[]))) THEN 2 ELSE 1 END AS BIGINT) AS change_count FROM n LEFT JOIN o USING (author)".replace("2 AS fetch_count", "CAST(2 AS BIGINT) AS fetch_count"))
def wave_states(spark, d):
    """Vertex rows after a wave of lists: a change counts only if the set of edges moved."""
    from ..schemas import PUBKEYS

    lists = _newest_lists(spark, d)
    values = {"status": F.lit("discovered"), "fetch_count": F.lit(1), "change_count": F.lit(1), "fetch_attempts": F.lit(0), "pubkey": F.lit(b"")}
    state = lists.where("rn = 1").select(F.col("author").alias("id")).select(*[F.col("id") if f.name == "id" else values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PUBKEYS.fields])
    wave = lists.where("rn = 1").select(F.col("author").alias("id"), F.col("id").cast("string").cast("binary").alias("event_id"), F.lit(None).cast("timestamp").alias("created_at"), F.col("followees").alias("followee_ids"))
    _, old = _newest_two(spark, d)
    rows, _, _ = edge_diff.changes(state, lambda who: old.join(who, "follower_id", "left_semi"), wave, F.current_timestamp())
    return rows.select("id", "status", "fetch_count", "change_count")


# edge diffs

_RANKED = "rk AS (SELECT *, row_number() OVER (PARTITION BY author ORDER BY created_at DESC, id) AS rn FROM li)"
_PAIR = f"""{_RANKED}, n AS (SELECT author, unnest(followees) AS f FROM rk WHERE rn = 1), o AS (SELECT author, unnest(followees) AS f FROM rk WHERE rn = 2)"""


def _newest_lists(spark, d):
    from pyspark.sql.window import Window

    rank = F.row_number().over(Window.partitionBy("author").orderBy(F.desc("created_at"), "id"))
    return D.lists(spark, d).select("author", "id", "followees", rank.alias("rn")).where("rn <= 2")


def _newest_two(spark, d):
    both = _newest_lists(spark, d).select("rn", F.col("author").alias("follower_id"), F.explode("followees").alias("followee_id"))
    return both.where("rn = 1").drop("rn"), both.where("rn = 2").drop("rn")


@query(with_sql("ev", "li", body="").strip() + f", {_PAIR} SELECT author AS follower_id, f AS followee_id, 'added' AS op FROM (SELECT * FROM n EXCEPT SELECT * FROM o) UNION ALL SELECT author, f, 'removed' FROM (SELECT * FROM o EXCEPT SELECT * FROM n)")
def edge_diff_latest_vs_previous(spark, d):
    return edge_diff.diff(*_newest_two(spark, d))


_STEPS = "sq AS (SELECT *, coalesce(lag(followees) OVER (PARTITION BY author ORDER BY created_at, id), CAST([] AS BIGINT[])) AS b FROM li)"


@query(with_sql("ev", "li", body="").strip() + f", {_STEPS}, x AS (SELECT author, id, unnest(list_filter(followees, lambda y: NOT list_contains(b, y))) AS followee, 'added' AS op FROM sq UNION ALL SELECT author, id, unnest(list_filter(b, lambda y: NOT list_contains(followees, y))), 'removed' FROM sq) SELECT op, count(*) AS n, CAST(sum(followee) AS BIGINT) AS followees, count(DISTINCT author) AS authors FROM x GROUP BY 1")
def edge_diff_history(spark, d):
    """All steps of every author's lists, by kind of change."""
    steps = edge_diff.diff_by_lists(D.lists(spark, d))
    return steps.groupBy("op").agg(F.count(F.lit(1)).alias("n"), F.sum("followee").alias("followees"), F.countDistinct("author").alias("authors"))


@query(with_sql("ev", "li", body="").strip() + f", {_STEPS} SELECT author, count(*) AS fetch_count, CAST(count(*) FILTER (WHERE followees <> b) AS BIGINT) AS change_count, max(created_at) FILTER (WHERE followees <> b) AS last_changed_at, arg_max(id, created_at * 100000000 + id) AS applied_id FROM sq GROUP BY 1")
def churn_counters(spark, d):
    return edge_diff.churn(D.lists(spark, d))


# frontier


@query(with_sql("st", body="SELECT id FROM st WHERE status = 'discovered' ORDER BY id LIMIT 64"))
def claim_batch(spark, d):
    return frontier.claimable(D.state(spark, d), 64).select("id")


_NOW_SQL = "TIMESTAMP '1998-01-01 00:00:00'"
_COLUMNS = "id, status, last_fetched_at, claimed_at, fetch_attempts, fetch_count"


@query(with_sql("st", body=f"SELECT id, CASE WHEN m THEN 'in_progress' ELSE status END AS status, last_fetched_at, CASE WHEN m THEN {_NOW_SQL} ELSE claimed_at END AS claimed_at, fetch_attempts, fetch_count FROM (SELECT *, id IN (SELECT id FROM st WHERE status = 'discovered' ORDER BY id LIMIT 64) AS m FROM st)"))
def claimed_state(spark, d):
    return frontier.claim(D.state(spark, d), 64, D.now())


@query(with_sql("st", body=f"SELECT id, CASE WHEN status <> 'in_progress' THEN status WHEN fetch_attempts + 1 >= 3 THEN 'failed' ELSE 'discovered' END AS status, CASE WHEN status = 'in_progress' AND fetch_attempts + 1 >= 3 THEN {_NOW_SQL} ELSE last_fetched_at END AS last_fetched_at, CASE WHEN status <> 'in_progress' THEN claimed_at END AS claimed_at, CAST(CASE WHEN status = 'in_progress' THEN fetch_attempts + 1 ELSE fetch_attempts END AS SMALLINT) AS fetch_attempts, fetch_count FROM st"))
def requeue_or_fail(spark, d):
    s = D.state(spark, d)
    return frontier.requeue_or_fail(s, s.where("status = 'in_progress'").select("id"), D.now())


def _reclaim_sql(where: str) -> str:
    return with_sql("st", body=f"SELECT id, CASE WHEN m THEN 'discovered' ELSE status END AS status, last_fetched_at, CASE WHEN NOT m THEN claimed_at END AS claimed_at, CAST(CASE WHEN m THEN 0 ELSE fetch_attempts END AS SMALLINT) AS fetch_attempts, fetch_count FROM (SELECT *, coalesce({where}, false) AS m FROM st)")


_TTL, _AGE = 200 * 86_400, 100 * 86_400


@query(_reclaim_sql("status = 'in_progress'"))
def reclaim_leases(spark, d):
    return frontier.reclaim_at_start(D.state(spark, d))


@query(_reclaim_sql(f"status IN ('fetched', 'not_found', 'failed') AND last_fetched_at < {_NOW_SQL} - INTERVAL {_TTL} SECOND"))
def ttl_reenqueue(spark, d):
    return frontier.reclaim_by_ttl(D.state(spark, d), D.now(), _TTL)


@query(_reclaim_sql(f"status = 'in_progress' AND claimed_at < {_NOW_SQL} - INTERVAL {_AGE} SECOND"))
def reclaim_expired_leases(spark, d):
    return frontier.reclaim_expired(D.state(spark, d), D.now(), _AGE)


@query(with_sql("st", body=f"SELECT count(*) AS affected FROM st WHERE status IN ('fetched', 'not_found', 'failed') AND last_fetched_at < {_NOW_SQL} - INTERVAL {_TTL} SECOND"))
def affected_rows(spark, d):
    s = D.state(spark, d)
    return frontier.affected(s, frontier.reclaim_by_ttl(s, D.now(), _TTL))


@query(with_sql("st", body=f"SELECT id, CASE WHEN status = 'in_progress' THEN 'not_found' ELSE status END AS status, CASE WHEN status = 'in_progress' THEN {_NOW_SQL} ELSE last_fetched_at END AS last_fetched_at, claimed_at, fetch_attempts, fetch_count FROM st"))
def set_fetch_status(spark, d):
    """A status write leaves lease and attempts alone."""
    s = D.state(spark, d)
    return frontier.set_status(s, s.where("status = 'in_progress'").select("id", F.lit("not_found").alias("status")), D.now())


@query(with_sql("st", body="SELECT " + ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in ("discovered", "in_progress", "fetched", "not_found", "failed")) + ", count(*) AS total, CASE WHEN count(*) = 0 THEN 0::DOUBLE ELSE count(*) FILTER (WHERE status = 'fetched')::DOUBLE / count(*) END AS coverage FROM st"))
def coverage_rollup(spark, d):
    return frontier.counts(D.state(spark, d))


@query(with_sql("st", body=f"SELECT id, epoch_us({_NOW_SQL}) / 1e6::DOUBLE - epoch_us(last_fetched_at) / 1e6::DOUBLE AS age FROM st WHERE status IN ('fetched', 'not_found', 'failed') AND last_fetched_at IS NOT NULL ORDER BY last_fetched_at, id LIMIT 1000"))
def stalest_topk(spark, d):
    return frontier.stalest(D.state(spark, d), D.now())


_BOUNDS = (86_400.0, 2_592_000.0, 31_536_000.0, 94_608_000.0, 189_216_000.0)


@query(with_sql("st", body="SELECT le, count(*) FILTER (WHERE age <= le) AS n FROM (SELECT (epoch_us(" + _NOW_SQL + ") - epoch_us(last_fetched_at)) / 1e6::DOUBLE AS age FROM st WHERE last_fetched_at IS NOT NULL), (SELECT unnest([" + ", ".join(f"{b}::DOUBLE" for b in _BOUNDS) + ", 'inf'::DOUBLE]) AS le) GROUP BY 1"))
def staleness_histogram(spark, d):
    ages = D.state(spark, d).where("last_fetched_at is not null").select(S.age_seconds(D.now(), F.col("last_fetched_at")).alias("age"))
    return frontier.histogram(ages, "age", _BOUNDS)


# graph

_EDGES_SQL = """e AS (SELECT DISTINCT 'c' || o_custkey AS src, 's' || l_suppkey AS dst FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    UNION SELECT DISTINCT 's' || l_suppkey, 'c' || o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R')"""


def _graph(spark, d):
    o = D.table(spark, d, "orders").select(F.concat(F.lit("c"), "o_custkey").alias("c"), "o_orderkey")
    li = D.table(spark, d, "lineitem").select("l_orderkey", F.concat(F.lit("s"), "l_suppkey").alias("s"), "l_returnflag")
    both = o.join(li, F.col("o_orderkey") == F.col("l_orderkey"))
    out = both.select(F.col("c").alias("src"), F.col("s").alias("dst"))
    back = both.where("l_returnflag = 'R'").select(F.col("s").alias("src"), F.col("c").alias("dst"))
    return out.union(back).distinct()


@query(f"WITH RECURSIVE {_EDGES_SQL}, r(node, hop) USING KEY (node) AS (SELECT 'c' || (SELECT min(c_custkey) FROM customer), 0 UNION SELECT dst, hop + 1 FROM r JOIN e ON src = node WHERE NOT EXISTS (SELECT 1 FROM recurring.r AS k WHERE k.node = dst)) SELECT node, CAST(hop AS INTEGER) AS hop FROM r")
def bfs_hops(spark, d):
    """From the first customer over the suppliers of its orders, and from these over who returned what they supplied."""
    first = D.table(spark, d, "customer").agg(F.min("c_custkey")).first()[0]
    return bfs.hops(_graph(spark, d), f"c{first}")


# signals


@query(with_sql("sg", "smp", body="SELECT source, list_reduce(list_prepend(1.0::DOUBLE, list(sample ORDER BY ts, seq)), lambda a, x: a * 0.7::DOUBLE + 0.3::DOUBLE * x) AS score, count(*) AS n FROM smp GROUP BY 1"))
def ewma_health(spark, d):
    s = D.signals(spark, d)
    return signals.health(s.withColumn("sample", S.outcome_sample(F.col("outcome"), F.col("latency"))))


@query(with_sql("sg", "smp", body="SELECT seq, outcome, sample FROM smp"))
def health_samples(spark, d):
    return D.signals(spark, d).select("seq", "outcome", S.outcome_sample(F.col("outcome"), F.col("latency")).alias("sample"))


@query(
    with_sql(
        "sg",
        body="""SELECT source, s.admitted AS admitted, s.waited AS waited_us, n FROM (SELECT source, count(*) AS n, list_reduce(list_prepend({'t': 0::BIGINT, 'tat': 0::BIGINT, 'admitted': 0::BIGINT, 'waited': 0::BIGINT},
        list({'t': ts, 'tat': 0::BIGINT, 'admitted': 0::BIGINT, 'waited': 0::BIGINT} ORDER BY ts, seq)), lambda a, x: {'t': x.t, 'tat': greatest(a.tat, x.t) + 250000000000,
        'admitted': a.admitted + CASE WHEN a.tat - 1000000000000 - x.t <= 0 THEN 1 ELSE 0 END, 'waited': a.waited + greatest(0, a.tat - 1000000000000 - x.t)}) AS s FROM (SELECT source, ts * 1000000 // 1 AS ts, seq FROM (SELECT source, ts // 1000000 AS ts, seq FROM sg)) GROUP BY 1)""",
    )
)
def gcra_admission(spark, d):
    """Four requests a million seconds (the signals are that sparse), in integer microseconds."""
    s = D.signals(spark, d).select("source", F.expr("ts div 1000000 * 1000000").alias("ts"), "seq")
    return signals.quota(s, step=250_000_000_000, burst=4)


@query(with_sql("sg", body="SELECT source, seq, failures, least(power(2::DOUBLE, failures - 1), 300::DOUBLE) AS delay FROM (SELECT *, CAST(sum(CASE WHEN outcome = 'rate_limited' THEN 1 ELSE 0 END) OVER (PARTITION BY source, i ORDER BY ts, seq) AS BIGINT) AS failures FROM (SELECT *, sum(CASE WHEN outcome = 'success' AND seq % 8 = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY ts, seq) AS i FROM sg)) WHERE outcome = 'rate_limited'"))
def backoff_schedule(spark, d):
    s = D.signals(spark, d).withColumn("failed", F.col("outcome") == "rate_limited").withColumn("reset", (F.col("outcome") == "success") & (F.col("seq") % 8 == 2))
    return signals.backoff_schedule(s).select("source", "seq", "failures", "delay")


@query(with_sql("sg", body="SELECT coalesce(max(f), 0) AS most FROM (SELECT source, CAST(sum(CASE WHEN outcome = 'rate_limited' THEN 1 ELSE 0 END) OVER (PARTITION BY source, i ORDER BY ts, seq) AS BIGINT) AS f FROM (SELECT *, sum(CASE WHEN outcome = 'success' AND seq % 8 = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY ts, seq) AS i FROM sg))"))
def max_consecutive_failures(spark, d):
    s = D.signals(spark, d).withColumn("failed", F.col("outcome") == "rate_limited").withColumn("reset", (F.col("outcome") == "success") & (F.col("seq") % 8 == 2))
    return signals.failures(s).agg(F.coalesce(F.max("failures"), F.lit(0)).cast("long").alias("most"))


@query("SELECT count(DISTINCT user_id) AS relays FROM events")
def active_relay_count(spark, d):
    return D.signals(spark, d).agg(F.countDistinct("source").alias("relays"))


_PROBE_GAP = 86_400


@query(
    with_sql(
        "sg",
        body=f"""SELECT source, s.allowed AS allowed, s.probed AS probed, n FROM (SELECT source, count(*) AS n, list_reduce(list_prepend({{'t': 0::BIGINT, 'h': false, 'last': -4611686018427387904::BIGINT, 'allowed': 0::BIGINT, 'probed': 0::BIGINT}},
        list({{'t': ts, 'h': (seq % 100)::DOUBLE / 100 >= 0.25, 'last': 0::BIGINT, 'allowed': 0::BIGINT, 'probed': 0::BIGINT}} ORDER BY ts, seq)),
        lambda a, x: {{'t': x.t, 'h': x.h, 'last': CASE WHEN x.h OR x.t - a.last >= {_PROBE_GAP}000000 THEN x.t ELSE a.last END, 'allowed': a.allowed + CASE WHEN x.h OR x.t - a.last >= {_PROBE_GAP}000000 THEN 1 ELSE 0 END,
        'probed': a.probed + CASE WHEN NOT x.h AND x.t - a.last >= {_PROBE_GAP}000000 THEN 1 ELSE 0 END}}) AS s FROM sg GROUP BY 1)""",
    )
)
def probe_gating(spark, d):
    s = D.signals(spark, d).withColumn("score", (F.col("seq") % 100).cast("double") / 100)
    return signals.probes(s, every_seconds=_PROBE_GAP)


@query(with_sql("sg", body="SELECT source, CAST(max(n) AS BIGINT) AS most FROM (SELECT source, sum(d) OVER (PARTITION BY source ORDER BY t, d, seq ROWS UNBOUNDED PRECEDING) AS n FROM (SELECT source, seq, ts AS t, 1 AS d FROM sg UNION ALL SELECT source, seq, ts + 864000000000 + seq % 10 * 86400000000, -1 FROM sg)) GROUP BY 1"))
def concurrency_in_use(spark, d):
    s = D.signals(spark, d)
    return signals.in_use(s.select("source", "seq", F.col("ts").alias("start"), (F.col("ts") + 864_000_000_000 + F.col("seq") % 10 * 86_400_000_000).alias("end")))


@query("SELECT event_id, CAST(greatest(1, round(4::DOUBLE * (event_id % 100)::DOUBLE / 100)) AS INTEGER) AS permits FROM events")
def permits(spark, d):
    return D.table(spark, d, "events").select("event_id", S.permits(4, (F.col("event_id") % 100).cast("double") / 100).alias("permits"))


@query("SELECT event_id, CAST(least(CASE WHEN v > 0 THEN v ELSE 500 END, 5000) AS INTEGER) AS max_limit, CAST(CASE WHEN v > 0 THEN v ELSE 20 END AS INTEGER) AS max_subscriptions FROM (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(event_id % 9000 - 1000 AS INTEGER) END AS v FROM events)")
def limits_clamp(spark, d):
    v = F.when(F.col("event_id") % 11 != 0, (F.col("event_id") % 9000 - 1000).cast("int"))
    return D.table(spark, d, "events").select("event_id", S.clamped(v, S.MAX_LIMIT, S.LARGEST_LIMIT).alias("max_limit"), S.clamped(v, S.MAX_SUBSCRIPTIONS).alias("max_subscriptions"))


@query("SELECT event_id AS url, CAST(CASE WHEN event_id % 3 = 2 OR event_id % 5000 <= 0 THEN 500 ELSE least(event_id % 5000, 5000) END AS INTEGER) AS max_limit, 20 AS max_subscriptions, CAST(CASE WHEN event_id % 3 = 1 THEN 7 ELSE 10 END AS INTEGER) AS max_filters FROM events")
def limits_documents(spark, d):
    """Documents with, without and with a broken limitation block."""
    e = D.table(spark, d, "events")
    n = (F.col("event_id") % 5000).cast("string")
    body = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"name":"x","limitation":{"max_limit":'), n, F.lit("}}"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"limitation":{"max_limit":'), n, F.lit(',"max_filters":7}}'))).otherwise(F.lit("{not json"))
    return limits.parsed(e.select(F.col("event_id").alias("url"), body.alias("body")))


@query("SELECT s_suppkey AS url, CAST(CASE WHEN s_suppkey % 2 = 0 AND s_suppkey > 0 THEN least(s_suppkey * 100, 5000) ELSE 500 END AS INTEGER) AS max_limit, 20 AS max_subscriptions, 10 AS max_filters FROM supplier")
def relay_limits_join(spark, d):
    relays = D.table(spark, d, "supplier").select(F.col("s_suppkey").alias("url"))
    known = relays.where("url % 2 = 0").select("url", (F.col("url") * 100).cast("int").alias("max_limit"), F.lit(None).cast("int").alias("max_subscriptions"), F.lit(0).alias("max_filters"))
    return limits.joined(relays, known)


_NOTICES = [("rate-limited: slow down", "rate_limited"), (" blocked : no", "blocked"), ("restricted", "blocked"), ("hello: rate-limited", "other"), ("", "other")]
_MESSAGE_SQL = "CASE event_id % 5 " + " ".join(f"WHEN {i} THEN '{m}'" for i, (m, _) in enumerate(_NOTICES)) + " END"


def _notices(spark, d):
    message = F.element_at(F.array(*[F.lit(m) for m, _ in _NOTICES]), (F.col("event_id") % 5 + 1).cast("int"))
    e = D.table(spark, d, "events")
    return e.select("event_id", F.col("user_id").alias("source"), D.micros("ts").alias("ts"), F.col("event_id").alias("seq"), S.notice_class(message).alias("kind"))


_CLASS_SQL = f"CASE WHEN trim(split_part({_MESSAGE_SQL}, ':', 1)) = 'rate-limited' THEN 'rate_limited' WHEN trim(split_part({_MESSAGE_SQL}, ':', 1)) IN ('blocked', 'restricted') THEN 'blocked' ELSE 'other' END"


@query(f"SELECT event_id, {_CLASS_SQL} AS kind FROM events")
def notice_classes(spark, d):
    return _notices(spark, d).select("event_id", "kind")


@query(f"SELECT user_id AS source, count(*) FILTER (WHERE k = 'rate_limited') AS failures, count(*) FILTER (WHERE k = 'blocked') AS blocked FROM (SELECT user_id, {_CLASS_SQL} AS k FROM events) WHERE k <> 'other' GROUP BY 1")
def notice_routing(spark, d):
    r = signals.routed(_notices(spark, d))
    return r.groupBy("source").agg(F.count_if("failed").alias("failures"), F.count_if(~F.col("failed")).alias("blocked"))


@query("SELECT event_id, failures, most, most / 2 + (event_id * 7919 % 1000)::DOUBLE / 1000 * most / 2 AS delay FROM (SELECT event_id, event_id % 70 AS failures, CASE WHEN event_id % 70 >= 64 THEN 300::DOUBLE ELSE least(power(2::DOUBLE, event_id % 70), 300::DOUBLE) END AS most FROM events)")
def backoff_jitter(spark, d):
    """Waits between half and the whole delay, by a draw of each source's own."""
    n = F.col("event_id") % 70
    waits = D.table(spark, d, "events").select("event_id", n.alias("failures"), S.backoff(n).alias("most"))
    return waits.withColumn("delay", S.jittered(F.col("most"), draw=(F.col("event_id") * 7919 % 1000).cast("double") / 1000))


# fallback

_SCORES_SQL = "sc AS (SELECT url, round(avg(CASE WHEN pos % 4 = 0 THEN 0 ELSE (pos % 97)::DOUBLE / 97 END), 6) AS score FROM rp GROUP BY 1)"
_MISS_SQL = "mi AS (SELECT c_custkey AS author FROM customer WHERE c_custkey NOT IN (SELECT author FROM win))"


def _scores(spark, d):
    sample = F.when(F.col("pos") % 4 == 0, 0.0).otherwise((F.col("pos") % 97).cast("double") / 97)
    return D.relay_pairs(spark, d).groupBy(F.col("url").alias("source")).agg(F.round(F.avg(sample), 6).alias("score"))


def _missed(spark, d):
    winners = gate.resolve(D.events(spark, d).where("valid"), D.requested(spark, d), "O", AS_OF)
    return fallback.misses(D.table(spark, d, "customer").select(F.col("c_custkey").alias("author")), winners), winners


@query(with_sql("ev", "req", "win", "rp", "fm", body="").strip() + f", {_SCORES_SQL}, {_MISS_SQL} SELECT author, url, score, rank FROM (SELECT pubkey_id AS author, fm.url, score, CAST(row_number() OVER (PARTITION BY pubkey_id ORDER BY score DESC, fm.url) AS INTEGER) AS rank FROM fm JOIN sc ON sc.url = fm.url WHERE marker IN ('write', 'both') AND pubkey_id IN (SELECT author FROM mi)) WHERE rank <= 3")
def fallback_topk_relays(spark, d):
    missed, _ = _missed(spark, d)
    relays = tags.first_markers(D.relay_pairs(spark, d), "pubkey_id").select(F.col("pubkey_id").alias("author"), "url", "marker")
    return fallback.best_relays(relays.join(missed, "author", "left_semi"), _scores(spark, d))


@query(with_sql("ev", "req", "win", body="").strip() + f", {_MISS_SQL}, rec AS (SELECT DISTINCT author FROM ev WHERE valid AND kind = 'F' AND created_at <= {AS_OF} + 3600 AND author IN (SELECT author FROM mi)) SELECT c_custkey AS author, CASE WHEN c_custkey IN (SELECT author FROM win) THEN 'fetched' WHEN c_custkey IN (SELECT author FROM rec) THEN 'recovered' ELSE 'not_found' END AS outcome FROM customer")
def batch_outcomes(spark, d):
    """Each claimed author's outcome; the fallback finds the missed ones' lists of another kind."""
    missed, winners = _missed(spark, d)
    relays = tags.first_markers(D.relay_pairs(spark, d).withColumn("marker", F.lit("both")), "pubkey_id").select(F.col("pubkey_id").alias("author"), "url", "marker")
    found = D.events(spark, d).where("valid")
    got = fallback.recover(missed, relays, _scores(spark, d), lambda asked: found.join(asked.select("author").distinct(), "author", "left_semi"), "F", AS_OF)
    return fallback.outcomes(D.table(spark, d, "customer").select(F.col("c_custkey").alias("author")), winners, got)


@query(with_sql("rp", body="").strip() + f", {_SCORES_SQL} SELECT url, CASE WHEN url LIKE '%urgent%' THEN 1.0::DOUBLE ELSE score END AS score FROM sc")
def relay_health_join(spark, d):
    """Relays with their score; one is unknown and so healthy."""
    scores = _scores(spark, d)
    return signals.with_scores(scores.select(F.col("source").alias("url")), scores.where("source not like '%urgent%'")).select("url", "score")


# pagination


@query(with_sql("ev", body="SELECT chunk, CASE WHEN max(n) >= 3 THEN 'requeue' ELSE 'complete' END AS status, CAST(sum(n) AS BIGINT) AS events FROM (SELECT author // 100 AS chunk, created_at, count(*) AS n FROM ev GROUP BY 1, 2) GROUP BY 1"))
def pagination_stall(spark, d):
    e = D.events(spark, d).withColumn("chunk", F.expr("author div 100"))
    return pagination.stalls(e, 3)


@query(with_sql("ev", body=f"SELECT id, created_at FROM ev WHERE created_at <= {AS_OF} ORDER BY created_at DESC, id LIMIT 500"))
def newest_first_page(spark, d):
    return pagination.page(D.events(spark, d).select("id", "created_at"), AS_OF, 500)


@query(with_sql("ev", body="SELECT relay_url AS page, count(id) AS returned, count(DISTINCT id) AS distinct_ids, min(created_at) AS oldest, CASE WHEN count(id) >= 2990 THEN min(created_at) END AS until FROM ev GROUP BY 1"))
def page_progress(spark, d):
    p = pagination.progress(D.events(spark, d).select(F.col("relay_url").alias("page"), "id", "created_at"))
    return p.withColumn("until", S.page_back(F.col("returned"), F.lit(2990), F.col("oldest")))


@query("SELECT c_custkey AS author, CAST((row_number() OVER (ORDER BY c_custkey) - 1) // 500 AS BIGINT) AS chunk FROM customer")
def author_chunks(spark, d):
    return pagination.chunks(D.table(spark, d, "customer").select(F.col("c_custkey").alias("author")))


# views and consumers


@query(with_sql("st", body="SELECT id, CASE status WHEN 'in_progress' THEN 'discovered' ELSE status END AS status, last_fetched_at FROM st"))
def pubkey_freshness_view(spark, d):
    return views.pubkey_freshness(D.state(spark, d))


@query("SELECT c_custkey AS id, c_name AS pubkey FROM customer")
def pubkey_lookup_view(spark, d):
    return views.pubkey_lookup(D.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("pubkey"), "c_nationkey"))


@query(with_sql("ev", "req", "win", "fol", body="SELECT followee_id FROM fol WHERE follower_id = (SELECT min(follower_id) FROM fol)"))
def consumer_followees(spark, d):
    f = D.follows(spark, d)
    first = f.agg(F.min("follower_id").alias("follower_id"))
    return f.join(first, "follower_id", "left_semi").select("followee_id")


@query(with_sql("ev", "req", "win", "fol", body="SELECT count(*) AS in_degree FROM fol WHERE followee_id = 7"))
def consumer_in_degree(spark, d):
    return D.follows(spark, d).where("followee_id = 7").agg(F.count(F.lit(1)).alias("in_degree"))


@query(with_sql("ev", "req", "win", "fol", body="SELECT follower_id, count(*) AS out_degree FROM fol GROUP BY 1"))
def consumer_out_degree(spark, d):
    return views.out_degree(D.follows(spark, d))


@query(with_sql("ev", "req", "win", "fol", body="SELECT s_suppkey AS id, s_name AS pubkey, n AS in_degree FROM (SELECT followee_id, count(*) AS n FROM fol GROUP BY 1 ORDER BY n DESC, followee_id LIMIT 10) JOIN supplier ON s_suppkey = followee_id"))
def consumer_most_followed(spark, d):
    lookup = D.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("pubkey"))
    return views.most_followed(D.follows(spark, d), lookup, 10)


@query("SELECT s_suppkey AS id, s_name AS pubkey FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 49)")
def consumer_resolve_ids(spark, d):
    lookup = D.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("pubkey"))
    return views.resolve_ids(lookup, D.table(spark, d, "lineitem").where("l_quantity > 49").select(F.col("l_suppkey").alias("id")))


@query(with_sql("st", body=f"SELECT id, status, last_fetched_at FROM st WHERE status = 'fetched' AND last_fetched_at < {_NOW_SQL} - INTERVAL 1 DAY"))
def consumer_stale(spark, d):
    return views.stale_since(views.pubkey_freshness(D.state(spark, d)), D.now() - F.expr("INTERVAL 1 DAY"))


@query(with_sql("st", body="SELECT id FROM st WHERE status IN ('discovered', 'in_progress')"))
def consumer_unfetched(spark, d):
    return views.unfetched(views.pubkey_freshness(D.state(spark, d)))


# dashboard


@query("SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start, count(*) / 300::DOUBLE AS rate FROM events GROUP BY 1, 2")
def rate_5m(spark, d):
    return metrics.rate(D.table(spark, d, "events"), "event_type")


_LE = "(SELECT unnest([1::DOUBLE, 5::DOUBLE, 10::DOUBLE, 50::DOUBLE, 100::DOUBLE, 'inf'::DOUBLE]) AS le)"


@query(f"SELECT time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS window_start, le, count(*) FILTER (WHERE value <= le) / 86400::DOUBLE AS rate FROM events, {_LE} GROUP BY 1, 2")
def histogram_rate(spark, d):
    e = metrics.windows(D.table(spark, d, "events"), seconds=86_400)
    buckets = frontier.histogram(e, "value", (1.0, 5.0, 10.0, 50.0, 100.0), "window_start")
    return buckets.select("window_start", "le", (F.col("n") / F.lit(86_400.0)).alias("rate"))


@query(
    f"""WITH b AS (SELECT event_type, le, count(*) FILTER (WHERE value <= le) AS n FROM events, {_LE} GROUP BY 1, 2),
    w AS (SELECT *, coalesce(lag(le) OVER (PARTITION BY event_type ORDER BY le), 0) AS low, coalesce(lag(n) OVER (PARTITION BY event_type ORDER BY le), 0) AS under, 0.95::DOUBLE * max(n) OVER (PARTITION BY event_type) AS rank FROM b),
    f AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY le) AS k FROM w WHERE n >= rank)
    SELECT event_type, CASE WHEN le = 'inf'::DOUBLE THEN low WHEN n = under THEN le ELSE low + (le - low) * (rank - under) / (n - under) END AS quantile FROM f WHERE k = 1"""
)
def histogram_p95(spark, d):
    buckets = frontier.histogram(D.table(spark, d, "events"), "value", (1.0, 5.0, 10.0, 50.0, 100.0), "event_type")
    return metrics.bucket_quantile(buckets, 0.95, "event_type")


@query(
    """WITH c AS (SELECT event_type, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts)::DOUBLE AS value FROM events),
    w AS (SELECT event_type, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS window_start, value FROM c)
    SELECT event_type, window_start, (max(value) - min(value)) / 86400::DOUBLE AS rate FROM w GROUP BY 1, 2"""
)
def counter_rate(spark, d):
    from pyspark.sql.window import Window

    value = F.row_number().over(Window.partitionBy("event_type").orderBy("ts")).cast("double")
    return metrics.counter_rate(D.table(spark, d, "events").select("event_type", "ts", value.alias("value")), "event_type", seconds=86_400)


@query(with_sql("st", body="SELECT 'frontier_depth{status=\"' || status || '\"} ' || count(*) AS line FROM st GROUP BY status"))
def metrics_exposition(spark, d):
    n = D.state(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("value"))
    return metrics.exposition(n.select(F.lit("frontier_depth").alias("name"), F.create_map(F.lit("status"), F.col("status")).alias("labels"), "value"))
