"""Exact substring dedup behind a count-min prefilter.

Every window of `width` words belongs to one anchor: the smallest of the shorter word
runs inside it, a rule that depends on its words alone.  So a window is repeated only
if its anchor occurs at least twice.

1. Each partition makes a count-min sketch of its anchors (the cells it fills, with
   their counts); the sketches are merged by cell.  The merged counts overestimate.
2. Windows whose anchor's estimate is at least two go out as one row per anchor
   occurrence and are grouped exactly, by 128 bits of anchor and window hash.  An anchor
   estimated to be frequent is dealt over several lots by document, and what a lot
   can't decide meets in a second round with at most one row per lot.

Only cells with an estimate of two or more reach the workers, as bitmaps whose size is
bounded by `SKETCH_BITS`; beyond it, more rows pass the filter but none is lost.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .shared import column, map_batches, numbered, pick, spread, written

WIDTH = 35
ANCHOR = 18
#: Rows of the sketch.
DEPTH = 2
#: Words of a run have so many places at most.
PLACE_BITS = 20
#: The sketch has up to 2 ** SKETCH_BITS cells a row: a bitmap of 64 MB.
SKETCH_BITS = 29
#: Cells of one merged block.
BLOCK_BITS = 16
#: Anchor occurrences that one lot should hold, at least; lots grow so that at most HEAVY cells a row exceed one.
LOT, HEAVY = 500, 1 << 21
#: Spans (a document counts as two) that are broadcast at most: about 16 MB.
FEW_SPANS = 400_000
MERGED = "line int, block int, cells binary, heavy binary, counts binary"
RUNS = "anchor long, lot int, doc_id long, of long, first int, keys binary"
FOUND = "doc_id long, of long, first int, end int, anchor long, key long, sure boolean"


def anchored(hashes: np.ndarray, rows: np.ndarray, width: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each run of windows with one anchor occurrence: first window, end, anchor's hash; and all windows' hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),) * 2
    short = T.rolling(hashes, anchor, 1)
    place = np.uint64((1 << PLACE_BITS) - 1)  # the same for all runs, so that equal windows have equal anchors
    lowest = T.sliding((short & ~place) | np.arange(len(short), dtype=np.uint64), width - anchor + 1, np.minimum) & place
    valid = rows[:n] == rows[width - 1 :]
    new = np.ones(n, dtype=bool)
    new[1:] = (lowest[1:] != lowest[:-1]) | ~valid[:-1]
    first = np.flatnonzero(new & valid)
    last = np.ones(n, dtype=bool)
    last[:-1] = new[1:] | ~valid[1:]
    return first, np.flatnonzero(last & valid) + 1, short[lowest[first].astype(np.int64)], T.rolling(hashes, width)


def _cells(anchors: np.ndarray, line: int, bits: int) -> np.ndarray:
    return (anchors * np.uint64((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)[line]) >> np.uint64(64 - bits)).astype(np.int64)


def _runs(texts: pa.Array, width: int, anchor: int) -> Iterator[tuple]:
    """(first row, words before the piece, first word of each row, row of each word, *anchored) of runs of rows and pieces of long texts."""
    for row, data, starts, ends, first, base in T.pieces(texts, T.NON_SPACE, width - 1):
        rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
        yield row, base or 0, first, rows, *anchored(T.word_hashes(data, starts, ends), rows, width, anchor)


def _sketch(docs: DataFrame, bits: int, width: int, anchor: int, lot: int) -> DataFrame:
    """The merged sketch by block: a bit for each cell counted twice or more, and the cells beyond `lot` with their counts."""
    block_bits = min(BLOCK_BITS, bits)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """This partition's sketch: the filled cells of each block; a batch's worth of anchors at a time, so memory is bounded."""
        held, n = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            anchors = np.concatenate(held)
            for line in range(DEPTH):
                cells, counts = np.unique(_cells(anchors, line, bits), return_counts=True)
                blocks = cells >> block_bits
                cuts = np.flatnonzero(np.diff(blocks, prepend=-1))
                inside = (cells & ((1 << block_bits) - 1)).astype("<u2" if block_bits <= 16 else "<u4")
                ends = [*cuts[1:].tolist(), len(cells)]
                few = np.minimum(counts, 1 << 30).astype("<i4")
                more = counts > 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(cuts), line, np.int32)),
                        pa.array(blocks[cuts].astype(np.int32)),
                        pa.array([inside[a:z].tobytes() for a, z in zip(cuts.tolist(), ends, strict=True)], pa.binary()),
                        pa.array([inside[a:z][more[a:z]].tobytes() + few[a:z][more[a:z]].tobytes() for a, z in zip(cuts.tolist(), ends, strict=True)], pa.binary()),
                    ],
                    names=["line", "block", "cells", "more"],
                )

        for b in batches:
            for *_, anchors, _ in _runs(b.column(0), width, anchor):
                held.append(anchors)
                n += len(anchors)
            if n > 4_000_000:
                yield from out()
                held, n = [], 0
        if n:
            yield from out()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds up the rows of each (line, block), which come sorted."""
        kind = np.dtype("<u2" if block_bits <= 16 else "<u4")
        at, count = None, np.zeros(1 << block_bits, dtype=np.int64)

        def out() -> pa.RecordBatch:
            heavy = np.flatnonzero(count > lot)
            row = [at[0], at[1], np.packbits(count > 1, bitorder="little").tobytes(), heavy.astype("<i4").tobytes(), np.minimum(count[heavy], 1 << 30).astype("<i4").tobytes()]
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=["line", "block", "cells", "heavy", "counts"])

        for b in batches:
            for line, block, cells, more in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if at != (line, block):
                    if at:
                        yield out()
                    at = (line, block)
                    count[:] = 0
                count[np.frombuffer(cells, kind)] += 1
                m = len(more) // (kind.itemsize + 4)
                count[np.frombuffer(more, kind, m)] += np.frombuffer(more, "<i4", m, m * kind.itemsize) - 1
        if at:
            yield out()

    cells = map_batches(docs.select("text"), fill, "line int, block int, cells binary, more binary")
    return map_batches(cells.repartition("line", "block").sortWithinPartitions("line", "block"), merge, MERGED)


class Sketch:
    """Cells counted twice or more, a bitmap a line, and the heavy cells of each line with their counts."""

    def __init__(self, rows: Iterator, bits: int, lot: int):
        self.bits, self.lot = bits, lot
        block = min(BLOCK_BITS, bits)
        self.maps = [np.zeros(max(1, (1 << bits) // 8), np.uint8) for _ in range(DEPTH)]
        heavy: list[list] = [[(np.empty(0, np.int64), np.empty(0, np.int32))] for _ in range(DEPTH)]
        for line, at, cells, places, counts in rows:
            got = np.frombuffer(cells, np.uint8)
            self.maps[line][at * len(got) : (at + 1) * len(got)] = got
            if places:
                heavy[line].append((np.frombuffer(places, "<i4").astype(np.int64) + (at << block), np.frombuffer(counts, "<i4")))
        self.heavy = []
        for found in heavy:
            cells, counts = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(cells)
            self.heavy.append((cells[order], counts[order]))

    def repeated(self, anchors: np.ndarray) -> np.ndarray:
        out = np.ones(len(anchors), dtype=bool)
        for line in range(DEPTH):
            c = _cells(anchors, line, self.bits)
            out &= (self.maps[line][c >> 3] >> (c & 7).astype(np.uint8) & 1).astype(bool)
        return out

    def lots(self, anchors: np.ndarray) -> np.ndarray:
        """How many lots each anchor is dealt over."""
        least = np.full(len(anchors), np.iinfo(np.int64).max)
        for line, (cells, counts) in enumerate(self.heavy):
            estimate = np.zeros(len(anchors), np.int64)
            if len(cells):
                c = _cells(anchors, line, self.bits)
                i = np.minimum(np.searchsorted(cells, c), len(cells) - 1)
                estimate = np.where(cells[i] == c, counts[i], 0)
            least = np.minimum(least, estimate)
        return np.maximum(1, -(-least // self.lot))


def _group(batches: Iterator[pa.RecordBatch], keyed: int, work) -> Iterator[pa.RecordBatch]:
    """work(table) on runs of whole groups; rows come sorted by the first `keyed` columns."""
    held: list[pa.RecordBatch] = []  # of the last group, which may go on
    for b in batches:
        if not len(b):
            continue
        same = np.ones(len(b), dtype=bool)
        for c in range(keyed):
            values = b.column(c).to_numpy()
            same &= values == values[-1]
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut or (held and any(held[0].column(c)[0] != b.column(c)[0] for c in range(keyed))):
            yield from work(pa.Table.from_batches([*held, b.slice(0, cut)]).combine_chunks())
            held = []
        held.append(b.slice(cut))
    if held:
        yield from work(pa.Table.from_batches(held).combine_chunks())


def _spans(doc_id, of, first, end) -> dict:
    n = len(first)
    return {"doc_id": doc_id, "of": of, "first": pa.array(first, pa.int32()), "end": pa.array(end, pa.int32()), "anchor": pa.nulls(n, pa.int64()), "key": pa.nulls(n, pa.int64()), "sure": pa.nulls(n, pa.bool_())}


def _decide(width: int):
    """Exact groups of one lot of an anchor's windows."""

    def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        anchor, lot = rows.column("anchor").to_numpy(), rows.column("lot").to_numpy()
        first = rows.column("first").to_numpy().astype(np.int64)
        binary = rows.column("keys").combine_chunks()
        sizes = pc.binary_length(binary).to_numpy(zero_copy_only=False).astype(np.int64) // 8
        keys = np.frombuffer(b"".join(binary.to_pylist()), "<i8")
        row = np.repeat(np.arange(len(rows)), sizes)
        start = first[row] + np.arange(len(keys)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        group = np.cumsum((np.diff(anchor, prepend=anchor[:1]) != 0) | (np.diff(lot, prepend=lot[:1]) != 0))[row]
        order = np.lexsort((keys, group))
        same = (keys[order][1:] == keys[order][:-1]) & (group[order][1:] == group[order][:-1])
        twice = np.zeros(len(keys), dtype=bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        # runs of repeated windows cover spans of words
        hit = np.flatnonzero(twice)
        if len(hit):
            new = np.ones(len(hit), dtype=bool)
            new[1:] = (np.diff(hit) != 1) | (np.diff(row[hit]) != 0)
            a = np.flatnonzero(new)
            z = np.append(a[1:], len(hit)) - 1
            at = pa.array(row[hit[a]])
            yield pa.RecordBatch.from_pydict(_spans(rows.column("doc_id").combine_chunks().take(at), rows.column("of").combine_chunks().take(at), start[hit[a]], start[hit[z]] + width), schema=None)
        # what other lots may hold too: each window that isn't repeated here, and one of each that is
        dealt = (lot >= 0)[row]
        firsts = np.ones(len(keys), dtype=bool)
        firsts[order[1:]] = ~same
        ask = np.flatnonzero(dealt & (~twice | firsts))
        if len(ask):
            at = pa.array(row[ask])
            yield pa.RecordBatch.from_pydict(
                _spans(rows.column("doc_id").combine_chunks().take(at), rows.column("of").combine_chunks().take(at), start[ask], start[ask] + width)
                | {"anchor": pa.array(anchor[row[ask]]), "key": pa.array(keys[ask]), "sure": pa.array(twice[ask])}
            )

    return work


def repeated_spans(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, of (hash of the text), spans (first and end of runs of words to remove) of documents that have any."""
    rows = spread(pick(docs, "doc_id", "text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # about 6 bytes a word and an anchor each 9 words; some 8 cells an anchor
    bits = min(SKETCH_BITS, max(12, int(size / 6 / 9 * 8).bit_length()))
    lot = max(LOT, int(size / 6 / 9) // HEAVY)
    shared = rows.sparkSession.sparkContext.broadcast(Sketch(written(_sketch(rows, bits, width, anchor, lot), "sketch").coalesce(4).toLocalIterator(), bits, lot))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value
        for b in batches:
            for row, base, start, of_row, first, end, anchors, keys in _runs(b.column(2), width, anchor):
                keep = np.flatnonzero(sketch.repeated(anchors))
                if not len(keep):
                    continue
                first, end, anchors = first[keep], end[keep], anchors[keep]
                doc = row + of_row[first]
                lots = sketch.lots(anchors)
                place = first - start[of_row[first]] + base
                # by place as well, as one text, or equal texts without ids, may hold many
                ids = b.column(0).fill_null(-1).to_numpy(zero_copy_only=False)[doc].view(np.uint64) ^ b.column(1).to_numpy()[doc].view(np.uint64)
                dealt = T.mix(T.mix(ids) + place.astype(np.uint64))
                lot = np.where(lots > 1, (dealt % lots.astype(np.uint64)).astype(np.int64), -1)
                raw = keys.astype("<u8").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchors.view(np.int64)),
                        pa.array(lot.astype(np.int32)),
                        b.column(0).take(pa.array(doc)),
                        b.column(1).take(pa.array(doc)),
                        pa.array(place.astype(np.int32)),
                        pa.array([raw[8 * a : 8 * z] for a, z in zip(first.tolist(), end.tolist(), strict=True)], pa.binary()),
                    ],
                    names=["anchor", "lot", "doc_id", "of", "first", "keys"],
                )

    source = rows.select("doc_id", F.xxhash64("text").alias("of"), "text")
    runs = map_batches(source, candidates, RUNS).repartition("anchor", "lot").sortWithinPartitions("anchor", "lot")
    found = written(map_batches(runs, lambda b: _group(b, 2, _decide(width)), FOUND), "spans")
    # a window that several lots hold is repeated; the counts are partial sums, so that no window's rows meet in one task
    asked = found.where("anchor is not null")
    several = asked.groupBy("anchor", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor", "key")
    met = asked.where("not sure").join(several, ["anchor", "key"], "left_semi")
    spans = found.where("anchor is null").unionByName(met.select(*found.columns)).select("doc_id", "of", F.struct("first", "end").alias("span"))
    return map_batches(spans.groupBy("doc_id", "of").agg(F.collect_list("span").alias("spans")), _united, "doc_id long, of long, spans array<struct<first:int,end:int>>")


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their spans (column 2) in order, and those that meet made one."""
    for b in batches:
        sizes = pc.list_value_length(b.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
        first, end = (x.to_numpy().astype(np.int64) for x in b.column(2).flatten().flatten())
        row = np.repeat(np.arange(len(b)), sizes)
        order = np.lexsort((first, row))
        row, first, end = row[order], first[order], end[order]
        reach = np.maximum.accumulate(end + (row << 32))  # the rows' spans lie apart
        new = np.ones(len(row), dtype=bool)
        new[1:] = first[1:] + (row[1:] << 32) > reach[:-1]
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(row)) - 1
        span = pa.StructArray.from_arrays([pa.array(first[at].astype(np.int32)), pa.array((reach[last] - (row[last] << 32)).astype(np.int32))], names=["first", "end"])
        offsets = np.searchsorted(row[at], np.arange(len(b) + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(offsets), span)], names=["doc_id", "of", "spans"])


def _chunks(raw: bytes, most: int = T.PIECE) -> Iterator[bytes]:
    """The text in parts of about `most` bytes that end where a word does."""
    at = 0
    while at < len(raw):
        stop = at + most
        if stop < len(raw):
            m = _SPACE.search(raw, stop)
            stop = m.start() if m else len(raw)
        yield raw[at:stop]
        at = stop


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _kept(raw: bytes, spans: list[dict] | None) -> Iterator[tuple[int, list[bytes]]]:
    """For each part of a text how many words it has and which of them stay."""
    n, gone = 0, iter(spans or ())
    span = next(gone, None)
    for part in _chunks(raw):
        words = part.split()
        out, at = [], 0
        while span and span["first"] < n + len(words):
            out += words[at : max(at, span["first"] - n)]
            at = max(at, min(span["end"] - n, len(words)))
            if span["end"] > n + len(words):
                break
            span = next(gone, None)
        yield len(words), out + words[at:]
        n += len(words)


def _with_spans(docs: DataFrame, width: int) -> DataFrame:
    """numbered(docs) with the text and its spans behind; rows of one id and text share theirs.

    The spans are written and counted first: only if there are few are they sent to all
    tasks, else the texts are shuffled to them.
    """
    spans = written(repeated_spans(docs, width), "spans-of-documents").select(F.col("doc_id").alias("__id"), F.col("of").alias("__of"), F.col("spans").alias("__spans"))
    n, size = spans.agg(F.count(F.lit(1)), F.sum(F.size("__spans"))).first()
    spans = spans.hint("broadcast" if 2 * n + (size or 0) <= FEW_SPANS else "shuffle_hash")
    rows = numbered(docs)
    same = column(docs, "doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(column(docs, "text")) == F.col("__of"))
    return rows.join(spans, same, "left").drop("__id", "__of").withColumn("__text", column(docs, "text"))


def substring_digests(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of docs.

    A word is removed if it lies in a window of `width` words that also starts anywhere
    else, in this row or another; so of repeated rows no window is left.  Null texts have
    no words; texts of fewer words have no windows; null ids pass through.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, removed, digest = [], [], []
            for text, spans in zip(b.column(1).cast(pa.large_binary()), b.column(2).to_pylist(), strict=True):
                sha, n, stay = hashlib.sha256(), 0, 0
                for size, words in _kept(text.as_py() or b"", spans):
                    if words:
                        sha.update((b" " if stay else b"") + b" ".join(words))
                    n, stay = n + size, stay + len(words)
                counts.append(n)
                removed.append(n - stay)
                digest.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    rows = _with_spans(spread(pick(docs, "doc_id", "text")), width).select("__c0", "__text", "__spans")
    return map_batches(rows, digests, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def substring_dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """docs without their repeated passages: changed texts are the kept words joined by one space.

    Texts without a repeated window stay as they are; documents of which no word is
    left go.  `n_chars`, where there is such a column, follows the text.
    """

    def shorter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            old = b.column(b.num_columns - 2).cast(pa.large_binary())
            texts, gone = [], []
            for text, spans in zip(old, b.column(b.num_columns - 1).to_pylist(), strict=True):
                if not spans:  # without one, no word goes
                    texts.append(text.as_py())
                    gone.append(False)
                else:
                    kept = b" ".join(b" ".join(words) for _, words in _kept(text.as_py() or b"", spans) if words)
                    texts.append(kept or None)
                    gone.append(not kept)
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(texts, pa.binary()).cast(pa.string()), pa.array(gone, pa.bool_())], names=[*b.schema.names[:-2], "__text", "__gone"])

    rows = _with_spans(docs, width)
    rows = rows.select(*[c for c in rows.columns if c not in ("__text", "__spans")], "__text", "__spans")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-2]) + ", __text string, __gone boolean"
    cut = map_batches(rows, shorter, schema).where("not __gone")
    names = docs.columns
    out = []
    for i, n in enumerate(names):
        c = F.col(f"__c{i}")
        if i == names.index("text"):
            c = F.col("__text")
        elif n == "n_chars" and i == names.index(n):
            c = F.when(F.col("__text").eqNullSafe(column(docs, "text")), c).otherwise(F.length("__text").cast(docs.schema[i].dataType))
        out.append(c.alias(f"__o{i}"))
    return cut.select(*out).toDF(*names)
