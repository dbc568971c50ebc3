"""What relays say about themselves: limits documents, parsed and joined with defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import LARGEST_LIMIT, MAX_FILTERS, MAX_LIMIT, MAX_SUBSCRIPTIONS, clamped

#: Bytes that a document may have (a fixed value).
LARGEST_DOCUMENT = 65_536
DOCUMENT = "limitation struct<max_limit:int,max_subscriptions:int,max_filters:int>"
NAMES = ("max_limit", "max_subscriptions", "max_filters")


def with_defaults(max_limit: Column, max_subscriptions: Column, max_filters: Column) -> list[Column]:
    """The three limits with defaults for what is missing or not positive."""
    return [clamped(max_limit, MAX_LIMIT, LARGEST_LIMIT).alias(NAMES[0]), clamped(max_subscriptions, MAX_SUBSCRIPTIONS).alias(NAMES[1]), clamped(max_filters, MAX_FILTERS).alias(NAMES[2])]


def parsed(documents: DataFrame) -> DataFrame:
    """(url, limits) of documents (url, body); one that is too large or isn't JSON gives the defaults."""
    body = F.when(F.octet_length("body") <= LARGEST_DOCUMENT, F.col("body"))
    d = F.from_json(body, DOCUMENT)
    return documents.select("url", *with_defaults(*[d["limitation"][n] for n in NAMES]))


def joined(relays: DataFrame, limits: DataFrame) -> DataFrame:
    """relays (url) with their limits; a relay without a document has the defaults."""
    known = limits.select("url", *[F.col(n).alias(f"__{n}") for n in NAMES])
    return relays.join(known, "url", "left").select(*[F.col(c) for c in relays.columns], *with_defaults(*[F.col(f"__{n}") for n in NAMES]))
