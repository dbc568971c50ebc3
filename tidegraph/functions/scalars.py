"""Scalar functions, all as column expressions inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Defaults of a relay's limits, and the largest advertised limit that is honoured (fixed values).
MAX_LIMIT, MAX_SUBSCRIPTIONS, MAX_FILTERS, LARGEST_LIMIT = 500, 20, 10, 5000
#: Seconds of latency that halve a health sample (a fixed value).
LATENCY_SCALE = 3.0
RATE_LIMITED_SAMPLE = 0.2


def epoch_timestamp(seconds: Column) -> Column:
    """Seconds as a timestamp; what no timestamp can hold is the epoch."""
    fits = seconds.between(-62_135_596_800, 253_402_300_799)
    return F.timestamp_seconds(F.when(fits, seconds).otherwise(F.lit(0)))


def saturating_add(a: Column, b: Column) -> Column:
    """a + b of non-negative longs, at most the largest long."""
    return F.coalesce(F.try_add(a, b), F.lit((1 << 63) - 1))


def marker(tag: Column) -> Column:
    """A relay tag's marker: none is both; an unknown one is null."""
    m = F.coalesce(tag, F.lit("both"))
    return F.when(m.isin("read", "write", "both"), m)


def relay_url(url: Column) -> Column:
    return F.regexp_replace(url, "/+$", "")


def http_url(url: Column) -> Column:
    """Where a relay's limits document lies: ws is http, wss https, anything else as it is."""
    return F.when(url.startswith("wss://"), F.concat(F.lit("https://"), F.substring(url, 7, 1 << 30))).when(url.startswith("ws://"), F.concat(F.lit("http://"), F.substring(url, 6, 1 << 30))).otherwise(url)


def notice_class(message: Column) -> Column:
    prefix = F.trim(F.split_part(message, F.lit(":"), F.lit(1)))
    return F.when(prefix == "rate-limited", "rate_limited").when(prefix.isin("blocked", "restricted"), "blocked").otherwise("other")


def clamped(value: Column, default: int, largest: int | None = None) -> Column:
    """A limit: null and non-positive ones are the default."""
    v = F.when(value > 0, value).otherwise(F.lit(default))
    return F.least(v, F.lit(largest)) if largest else v


def backoff(failures: Column, base: float = 1.0, cap: float = 300.0) -> Column:
    """Seconds to wait after so many failures: base doubled each time, at most cap."""
    doubled = F.lit(float(base)) * F.pow(F.lit(2.0), F.least(failures, F.lit(64)).cast("double"))
    return F.when(failures >= 64, F.lit(float(cap))).otherwise(F.least(doubled, F.lit(float(cap))))


def jittered(delay: Column, seed: int | None = None, draw: Column | None = None) -> Column:
    """Uniform between half the delay and the delay; `draw`, from 0 to 1, stands for a random number."""
    return delay / 2 + (F.rand(seed) if draw is None else draw) * delay / 2


def latency_sample(seconds: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + seconds / F.lit(LATENCY_SCALE))


def outcome_sample(outcome: Column, seconds: Column) -> Column:
    """The health sample of a fetch: by latency if it succeeded, 0.2 when rate-limited, else nothing."""
    return F.when(outcome == "success", latency_sample(seconds)).when(outcome == "rate_limited", F.lit(RATE_LIMITED_SAMPLE)).otherwise(F.lit(0.0))


def permits(capacity: int, score: Column) -> Column:
    """max(1, round(capacity x score)), halves away from zero."""
    return F.greatest(F.lit(1), F.round(F.lit(float(capacity)) * score).cast("int"))


def age_seconds(as_of: Column, then: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", then, as_of).cast("double") / F.lit(1e6)


def page_back(returned: Column, cap: Column, oldest: Column) -> Column:
    """The next, inclusive, upper bound of a scan; null ends it."""
    return F.when(returned >= cap, oldest)
