"""Monitoring: counter rates, quantiles of histograms, text exposition."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Metric names (fixed values).
COUNTERS = ("ingest_invalid_signature", "ingest_unsolicited", "ingest_future_dated", "ingest_oversized_follow_list", "relay_rate_limited", "relay_blocked", "nip65_recovered", "staleness_reenqueued", "in_run_reclaimed")
GAUGES = ("frontier_depth", "crawl_coverage_ratio", "relay_active_count", "relay_consecutive_failures", "relay_health", "relay_concurrency_in_use")
HISTOGRAMS = ("fetch_duration_seconds", "staleness_age_seconds")
WINDOW_SECONDS = 300


class Registry:
    """The process's metric families: each has a series from the start, as far as its labels are known."""

    def __init__(self) -> None:
        self.lock = threading.Lock()
        self.values: dict[tuple[str, tuple[tuple[str, str], ...]], float] = {(n, ()): 0.0 for n in (*COUNTERS, *GAUGES) if not n.startswith("relay_") or n in ("relay_active_count", "relay_consecutive_failures")}
        self.buckets: dict[str, dict[float, int]] = {n: {float("inf"): 0} for n in HISTOGRAMS}
        self.sums = dict.fromkeys(HISTOGRAMS, 0.0)

    def count(self, name: str, n: float = 1, **labels: str) -> None:
        """Adds to a counter."""
        at = (name, tuple(sorted(labels.items())))
        with self.lock:
            self.values[at] = self.values.get(at, 0.0) + n

    def set(self, name: str, value: float, **labels: str) -> None:
        """A gauge's new value."""
        with self.lock:
            self.values[name, tuple(sorted(labels.items()))] = float(value)

    def observe(self, name: str, buckets: list[tuple[float, int]], total: float) -> None:
        """Adds cumulative buckets (bound, number) and their sum to a histogram."""
        with self.lock:
            held = self.buckets[name]
            for le, n in buckets:
                held[le] = held.get(le, 0) + n
            self.sums[name] += total

    def samples(self) -> list[tuple[str, dict[str, str], float]]:
        """(name, labels, value) of all series."""
        with self.lock:
            out = [(name, dict(labels), v) for (name, labels), v in sorted(self.values.items())]
            for name, held in self.buckets.items():
                out += [(f"{name}_bucket", {"le": "+Inf" if le == float("inf") else str(le)}, float(n)) for le, n in sorted(held.items())]
                out += [(f"{name}_sum", {}, self.sums[name]), (f"{name}_count", {}, float(held[float("inf")]))]
        return out

    def text(self) -> str:
        """The exposition of all series; the same format as `exposition` gives of a DataFrame."""
        escape = lambda v: v.replace("\\", "\\\\").replace('"', '\\"')
        line = lambda name, labels, v: name + ("{" + ",".join(f'{k}="{escape(x)}"' for k, x in sorted(labels.items())) + "}" if labels else "") + f" {v}"
        return "".join(line(*s) + "\n" for s in self.samples())


def windows(rows: DataFrame, ts: str = "ts", seconds: int = WINDOW_SECONDS) -> DataFrame:
    return rows.withColumn("window_start", F.window(ts, f"{seconds} seconds").start)


def rate(events: DataFrame, *by: str, ts: str = "ts", seconds: int = WINDOW_SECONDS) -> DataFrame:
    """(by, window_start, rate): events a second in each tumbling window that has any."""
    return windows(events, ts, seconds).groupBy(*by, "window_start").agg((F.count(F.lit(1)) / F.lit(float(seconds))).alias("rate"))


def counter_rate(samples: DataFrame, *by: str, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """(by, window_start, rate) of a counter's samples (ts, value): the rise within a window, resets counted from zero."""
    w = Window.partitionBy(*by, "window_start").orderBy("ts")
    step = F.when(F.col("value") < F.lag("value").over(w), F.col("value")).otherwise(F.col("value") - F.lag("value").over(w))
    return windows(samples, "ts", seconds).withColumn("__d", step).groupBy(*by, "window_start").agg((F.coalesce(F.sum("__d"), F.lit(0.0)) / F.lit(float(seconds))).alias("rate"))


def bucket_quantile(buckets: DataFrame, q: float, *by: str) -> DataFrame:
    """(by, quantile) of cumulative buckets (le, n), linear within a bucket; in the last, open one its lower bound."""
    w = Window.partitionBy(*by).orderBy("le")
    total = F.max("n").over(Window.partitionBy(*by))
    rows = buckets.withColumn("__low", F.coalesce(F.lag("le").over(w), F.lit(0.0))).withColumn("__under", F.coalesce(F.lag("n").over(w), F.lit(0)))
    rows = rows.withColumn("__total", total).withColumn("__rank", F.lit(float(q)) * F.col("__total")).where("n >= __rank and __total > 0")
    first = rows.withColumn("__first", F.row_number().over(w)).where("__first = 1")
    inside = F.col("n") - F.col("__under")
    value = F.when(F.col("le") == float("inf"), F.col("__low")).when(inside == 0, F.col("le")).otherwise(F.col("__low") + (F.col("le") - F.col("__low")) * (F.col("__rank") - F.col("__under")) / inside)
    return first.select(*by, value.alias("quantile"))


def exposition(samples: DataFrame) -> DataFrame:
    """(line): samples (name, labels map, value) in the text format."""
    pairs = F.array_join(F.transform(F.array_sort(F.map_entries("labels")), lambda e: F.concat(e["key"], F.lit('="'), F.regexp_replace(e["value"], r'(["\\])', r"\\$1"), F.lit('"'))), ",")
    return samples.select(F.concat("name", F.when(F.size("labels") > 0, F.concat(F.lit("{"), pairs, F.lit("}"))).otherwise(""), F.lit(" "), F.col("value").cast("string")).alias("line"))
