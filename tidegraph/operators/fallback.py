"""Authors that the curated sources don't know: look up where they write, ask there, resolve again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .gate import FUTURE_CLAMP, resolve
from .signals import with_scores
from .tags import write_relays

MAX_WRITE_RELAYS = 3


def misses(claimed: DataFrame, winners: DataFrame) -> DataFrame:
    return claimed.join(winners.select("author").distinct(), "author", "left_anti")


def best_relays(relays: DataFrame, scores: DataFrame, k: int = MAX_WRITE_RELAYS) -> DataFrame:
    """Of each author (relays: author, url, marker) the k healthiest write relays; ties go to the smaller url."""
    ranked = with_scores(write_relays(relays), scores)
    w = Window.partitionBy("author").orderBy(F.desc("score"), "url")
    return ranked.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("author", "url", "score", "rank")


def outcomes(claimed: DataFrame, winners: DataFrame, recovered: DataFrame, failed: bool = False) -> DataFrame:
    """(author, outcome) of each claimed author: fetched, recovered or not_found; if the scan failed, requeue for all."""
    if failed:
        return claimed.select("author", F.lit("requeue").alias("outcome"))
    a = winners.select("author").distinct().withColumn("__hit", F.lit(True))
    b = recovered.select("author").distinct().withColumn("__got", F.lit(True))
    rows = claimed.select("author").join(a, "author", "left").join(b, "author", "left")
    return rows.select("author", F.when(F.col("__hit"), "fetched").when(F.col("__got"), "recovered").otherwise("not_found").alias("outcome"))


def recover(missed: DataFrame, relays: DataFrame, scores: DataFrame, scan: Callable[[DataFrame], DataFrame], kind, as_of: int, clamp: int = FUTURE_CLAMP, k: int = MAX_WRITE_RELAYS) -> DataFrame:
    """Winners of missed authors from `scan` of their best write relays (author, url); the same gate applies."""
    asked = best_relays(relays.join(missed.select("author"), "author", "left_semi"), scores, k)
    return resolve(scan(asked.select("author", "url")), missed, kind, as_of, clamp)
