"""All schemas, explicit and versioned; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

VERSION = 4

EVENT = T.StructType(
    [
        T.StructField("id", T.BinaryType()),
        T.StructField("pubkey", T.BinaryType()),
        T.StructField("created_at", T.LongType()),
        T.StructField("kind", T.IntegerType()),
        T.StructField("tags", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("content", T.StringType()),
        T.StructField("sig", T.BinaryType()),
        T.StructField("relay_url", T.StringType()),
    ]
)

PUBKEYS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("pubkey", T.BinaryType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("last_fetched_at", T.TimestampType()),
        T.StructField("last_confirmed_at", T.TimestampType()),
        T.StructField("last_changed_at", T.TimestampType()),
        T.StructField("fetch_count", T.LongType(), False),
        T.StructField("change_count", T.LongType(), False),
        T.StructField("applied_event_id", T.BinaryType()),
        T.StructField("applied_created_at", T.TimestampType()),
        T.StructField("claimed_at", T.TimestampType()),
        T.StructField("fetch_attempts", T.ShortType(), False),
    ]
)

FOLLOWS = T.StructType([T.StructField("follower_id", T.LongType(), False), T.StructField("followee_id", T.LongType(), False)])

PUBKEY_RELAYS = T.StructType(
    [
        T.StructField("pubkey_id", T.LongType(), False),
        T.StructField("url", T.StringType(), False),
        T.StructField("marker", T.StringType(), False),
        T.StructField("seen_at", T.TimestampType(), False),
    ]
)

TABLES = {"pubkeys": PUBKEYS, "follows": FOLLOWS, "pubkey_relays": PUBKEY_RELAYS}

KIND_FOLLOWS, KIND_RELAYS = 3, 10002
STATUSES = ("discovered", "in_progress", "fetched", "not_found", "failed")
TERMINAL = ("fetched", "not_found", "failed")
MARKERS = ("read", "write", "both")
