"""Benchmark decontamination: training token windows against a broadcast hash set of test n-grams.

The benchmark's windows are few and checked to be few: beyond `most_bytes` of window
text they are dealt into several broadcasts, each of which scans all documents, and
the hits are united by a row key, so that null and repeated ids stay rows of their own.
Documents are never shuffled for the scan.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .shared import map_batches, pick, spread, without, written

WIDTH = 13
#: Contaminated: hit words are at least one in so many.
SHARE = 20
#: Window text per broadcast.
MOST_BYTES = 32 << 20
FILTER_BITS = 24
HITS = "doc_id long, n_words long, covered array<int>, items array<string>"
TOTALS = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string"


def _normal(text: str | None) -> list[bytes]:
    raw = T.LOWER[np.frombuffer((text or "").encode(), dtype=np.uint8)]
    return np.where(T.ALNUM[raw], raw, 0x20).astype(np.uint8).tobytes().split()


def _hash(words: list[bytes]) -> int:
    data = np.frombuffer(b" ".join(words), dtype=np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    return int(T.rolling(T.word_hashes(data, np.array([0, *(ends[:-1] + 1)]), ends), len(words))[0])


class Windows:
    """The n-grams of some benchmark items: width -> hash -> (the words, ids of the items)."""

    def __init__(self, found: dict[bytes, set[str]]):
        self.of: dict[int, dict[int, list[tuple[bytes, frozenset[str]]]]] = defaultdict(lambda: defaultdict(list))
        for joined, items in found.items():
            words = joined.split()
            self.of[len(words)][_hash(words)].append((joined, frozenset(items)))
        self.of = {w: dict(x) for w, x in self.of.items()}
        self.filters = {}
        for width, known in self.of.items():
            seen = np.zeros(1 << FILTER_BITS, dtype=bool)
            seen[np.fromiter(known, np.uint64, len(known)) >> np.uint64(64 - FILTER_BITS)] = True
            self.filters[width] = np.packbits(seen, bitorder="little")

    def hits(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[int, int, frozenset[str]]]:
        """(first word, width, items) of each window that occurs; rows: of each word."""
        for width, known in self.of.items():
            rolled = T.rolling(hashes, width)
            top = rolled >> np.uint64(64 - FILTER_BITS)
            bits = self.filters[width][top >> np.uint64(3)] >> (top & np.uint64(7)).astype(np.uint8) & 1
            for i in np.flatnonzero(bits).tolist():
                if rows[i] == rows[i + width - 1] and (same := known.get(int(rolled[i]))):
                    words = b" ".join(data[a:b].tobytes() for a, b in zip(starts[i : i + width], ends[i : i + width], strict=True))
                    for joined, items in same:
                        if joined == words:
                            yield i, width, items


def _parts(benchmark: DataFrame, most: int) -> Iterator[Windows]:
    """The benchmark's windows, in parts of about `most` bytes of window text; at least one."""
    found: dict[bytes, set[str]] = defaultdict(set)
    size, any_part = 0, False
    for item, text in pick(benchmark, "item_id", "text").where("item_id is not null and text is not null").toLocalIterator():
        words = _normal(text)
        for i in range(max(1, len(words) - WIDTH + 1) if words else 0):
            joined = b" ".join(words[i : i + WIDTH])
            size += len(joined) if joined not in found else 0
            found[joined].add(str(item))
        if size > most:
            yield Windows(found)
            found, size, any_part = defaultdict(set), 0, True
    if found or not any_part:
        yield Windows(found)


def _scan(docs: DataFrame, windows: Windows, only: bool) -> DataFrame:
    """doc_id, n_words, covered ([first, end) of runs of hit words), items of every row of docs; their totals if this is the only scan."""
    shared = docs.sparkSession.sparkContext.broadcast(windows)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        overlap = max(windows.of, default=1) - 1
        for b in batches:
            counts, items = np.zeros(len(b), np.int64), [set() for _ in range(len(b))]
            spans: dict[int, list[tuple[int, int]]] = defaultdict(list)
            for row, data, starts, ends, first, base in T.pieces(b.column(1), T.ALNUM, overlap, T.LOWER):
                counts[row : row + len(first) - 1] += np.diff(first) - (overlap if base else 0)
                rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
                for i, width, of in windows.hits(data, starts, ends, rows, T.word_hashes(data, starts, ends)):
                    at = int(i - first[rows[i]]) + (base or 0)
                    spans[row + int(rows[i])].append((at, at + width))
                    items[row + rows[i]] |= of
            covered = [[x for span in united(spans[i]) for x in span] if i in spans else [] for i in range(len(b))]
            found = pa.RecordBatch.from_arrays([b.column(0), pa.array(counts), pa.array(covered, pa.list_(pa.int32())), pa.array([sorted(x) for x in items], pa.list_(pa.string()))], names=["doc_id", "n_words", "covered", "items"])
            yield from _totals(iter([found])) if only else [found]

    return map_batches(spread(pick(docs, "doc_id", "text")), scan, TOTALS if only else HITS)


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans [first, end) with those that meet made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        hit, count, digest = [], [], []
        for covered, items in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            hit.append(sum(z - a for a, z in united(list(zip(covered[::2], covered[1::2], strict=True)))))
            names = sorted(set(items))
            count.append(len(names))
            digest.append(hashlib.sha256(",".join(names).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(hit, pa.int64()), pa.array(count, pa.int64()), pa.array(digest)], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256"])


def contamination(docs: DataFrame, benchmark: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of docs.

    Null texts have no words; a document or item without words has no windows; items
    with a null id or text are left out; null ids of documents pass through and repeated
    rows stay repeated; with an empty benchmark nothing is hit; other columns are ignored.
    """
    windows = _parts(benchmark, most_bytes)
    first, second = next(windows), next(windows, None)
    if second is None:
        totals = _scan(docs, first, True)
    else:  # every row has its part of the hits in each scan; the key is written, so that all scans see the same
        keyed = written(pick(docs, "doc_id", "text").withColumn("__row", F.monotonically_increasing_id()), "scanned")
        by_row = keyed.select(F.col("__row").alias("doc_id"), "text")
        rows = _scan(by_row, first, False).unionByName(_scan(by_row, second, False))
        for w in windows:
            rows = rows.unionByName(_scan(by_row, w, False))
        found = rows.groupBy("doc_id").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("covered")).alias("covered"), F.flatten(F.collect_list("items")).alias("items"))
        hits = map_batches(found, _totals, TOTALS).withColumnRenamed("doc_id", "__row")
        totals = keyed.select("__row", F.col("doc_id").cast("long")).join(hits, "__row").drop("__row")
    return totals.withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the contaminated documents; rows without doc_id stay."""
    return without(docs, contamination(docs, benchmark).where("contaminated and doc_id is not null").select(F.col("doc_id").alias("__id")).distinct())
