"""SimHash near-duplicates, found by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut in four segments of 16 bits.  Two fingerprints that
differ in at most three bits agree wholly on at least one of them.  The other 48
bits then hold all the (at most three) errors, so one of their two halves of 24
bits holds at most one.  Of that half, 23 bits are decoded by the perfect binary
Golay code: the keys of a half are the 12-bit indices of the codewords that it, or
any vector one bit away, decodes to (one key if it lies within two bits of its
codeword, six otherwise).  Vectors one bit apart always share an index, so
(segment, its value, half, index) - 28 bits of information - loses no pair.

Fingerprints that share a key are compared; only a chain that joins each bucket's
linked members is kept, never all pairs.  Equal fingerprints are one node, so a
large group of copies costs one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .components import components
from .shared import map_batches, numbered, pick, spread, without, written

BITS = 64
RADIUS = 3
SEED = 42
#: Buckets of up to this many fingerprints are compared by shifted rows, up to so many by a search from seeds; larger
#: ones are divided, and those over HOT_BUCKET dealt anew under longer keys.
SMALL_BUCKET, SEARCHED, HOT_BUCKET = 32, 2000, 100_000
LINKS = "a long, b long, key long, print long, node long"
#: Generator of the (23, 12) binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 (a fixed value).
GENERATOR = 0b110001110101


@lru_cache(maxsize=1)
def _corrections() -> np.ndarray:
    """The error pattern of at most three bits for each of the 2048 syndromes."""
    patterns = [0]
    for weight in (1, 2, 3):
        patterns += [sum(1 << i for i in at) for at in combinations(range(23), weight)]
    table = np.zeros(2048, dtype=np.int64)
    table[_syndrome(np.array(patterns))] = patterns
    return table


def _syndrome(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.int64)
    for i in range(22, 10, -1):
        v = v ^ (((v >> i) & 1) * (GENERATOR << (i - 11)))
    return v


def golay_index(v: np.ndarray) -> np.ndarray:
    """The 12 message bits of the codeword nearest to each 23-bit vector."""
    return (v ^ _corrections()[_syndrome(v)]) >> 11


def bucket_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, key) of every key of every fingerprint, without repeats."""
    segments = [((prints >> np.uint64(16 * i)) & np.uint64(0xFFFF)).astype(np.int64) for i in range(4)]
    at, keys = [], []
    place = np.arange(len(prints))
    for a in range(4):
        p, q, r = (segments[i] for i in range(4) if i != a)
        rest = p | q << 16 | r << 32
        for half in (0, 1):
            v = (rest >> (24 * half)) & 0x7FFFFF
            near = [golay_index(v)] + [golay_index(v ^ (1 << i)) for i in range(23)]
            near = np.sort(np.stack(near, axis=1), axis=1)
            new = np.ones(near.shape, dtype=bool)
            new[:, 1:] = near[:, 1:] != near[:, :-1]
            at.append(np.repeat(place, new.sum(axis=1)))
            keys.append(np.repeat((a * 2 + half << 28) | segments[a] << 12, new.sum(axis=1)) | near[new])
    return np.concatenate(at), np.concatenate(keys)


def _spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words with one space for whatever stands between two of them, and where each starts."""
    kept = T.NON_SPACE[data]
    gap = ends[:-1] < starts[1:]  # rows may meet without one
    joined = np.where(kept, data, np.uint8(0x20))
    kept[ends[:-1][gap]] = True
    return joined[kept], np.concatenate([[0], np.cumsum(ends[:-1] - starts[:-1] + gap)])


def _set_bits(hashes: np.ndarray, before: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """[row, bit] how many of a row's `sizes` hashes, from `before` on, have the bit; each row has some."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(np.uint64)
    groups = -(-sizes // 255)  # a byte counts up to 255, and eight bytes are added at once
    first = np.cumsum(groups) - groups
    at = np.repeat(before - 255 * first, groups) + 255 * np.arange(groups.sum())
    sums = np.ascontiguousarray(np.add.reduceat(bits, at, axis=0)).view(np.uint8)
    return np.add.reduceat(sums, first, axis=0, dtype=np.int64)


def fingerprints(texts: pa.Array, words_per_shingle: int = 3) -> np.ndarray:
    """A fingerprint for each text."""
    out, k = np.zeros(len(texts), dtype=np.uint64), words_per_shingle
    at, total, size = -1, np.zeros(BITS, np.int64), 0  # of a long text, whose pieces follow each other

    def finish() -> None:
        if at >= 0:
            out[at] = np.packbits(2 * total > size, bitorder="little").view(np.uint64)[0]

    for row, data, starts, ends, first, base in T.pieces(texts, T.NON_SPACE, k - 1, T.LOWER):
        n = np.diff(first)
        shingles = np.where(n >= k, n - k + 1, np.minimum(n, 1))
        if base and n[0] < k:
            continue  # no word that wasn't in the piece before
        rows = np.flatnonzero(shingles)
        if not len(rows):
            continue
        joined, to = _spaced(data, starts, ends)
        before = np.cumsum(shingles) - shingles
        begin = np.arange(shingles.sum()) + np.repeat(first[:-1] - before, shingles)
        last = np.minimum(begin + k, np.repeat(first[1:], shingles)) - 1
        hashes = T.xxh64(joined, to[begin], to[last] + ends[last] - starts[last], SEED)
        counts = _set_bits(hashes, before[rows], shingles[rows])
        if base is not None:
            if at != row:
                finish()
                at, total, size = row, np.zeros(BITS, np.int64), 0
            total, size = total + counts[0], size + int(shingles[0])
        else:
            out[row + rows] = np.packbits(2 * counts > shingles[rows, None], axis=1, bitorder="little").view(np.uint64).ravel()
    finish()
    return out


def _print_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        prints = fingerprints(b.column(1)).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints)], names=["doc_id", "print"])


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        prints = b.column(0).to_numpy(zero_copy_only=False)
        at, keys = bucket_keys(prints.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(prints[at]), b.column(1).take(pa.array(at))], names=["key", "print", "node"])


def spanning_links(keys: np.ndarray, prints: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Positions of linked pairs in rows sorted by key, enough to connect all that link within a bucket."""
    edges = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
    sizes = np.diff(edges, append=len(keys))
    left, right = [], []
    small = np.repeat(sizes <= SMALL_BUCKET, sizes)
    for step in range(1, min(int(sizes.max(initial=0)), SMALL_BUCKET)):
        i = np.flatnonzero((keys[step:] == keys[:-step]) & small[step:])
        i = i[np.bitwise_count(prints[i] ^ prints[i + step]) <= radius]
        left.append(i)
        right.append(i + step)
    for start, size in zip(edges[sizes > SMALL_BUCKET].tolist(), sizes[sizes > SMALL_BUCKET].tolist(), strict=True):
        i, j = _searched(prints[start : start + size], radius) if size <= SEARCHED else _divided(prints[start : start + size], radius)
        left.append(start + i)
        right.append(start + j)
    none = np.empty(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _searched(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The links of one bucket, found from seeds: fewer than it has rows."""
    left, right = [], []
    todo = np.arange(len(prints))
    while len(todo):
        queue, todo = [todo[0]], todo[1:]
        while queue and len(todo):
            one = queue.pop()
            near = np.bitwise_count(prints[todo] ^ prints[one]) <= radius
            left.append(np.full(near.sum(), one))
            right.append(todo[near])
            queue += todo[near].tolist()
            todo = todo[~near]
    none = np.empty(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _divided(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The links of one large bucket: the bits in which its prints differ are dealt into radius + 1 parts, on one of which linked prints agree."""
    differ = int(np.bitwise_or.reduce(prints ^ prints[0]))
    bits = [i for i in range(BITS) if differ >> i & 1]
    if len(bits) <= radius:  # all link
        return np.zeros(len(prints) - 1, np.int64), np.arange(1, len(prints))
    left, right = [], []
    for k in range(radius + 1):
        part = prints & np.uint64(sum(1 << i for i in bits[k :: radius + 1]))
        order = np.argsort(part, kind="stable")
        i, j = spanning_links(part[order].view(np.int64), prints[order], radius)
        left.append(order[i])
        right.append(order[j])
    return np.concatenate(left), np.concatenate(right)


def _again(rows: pa.Table) -> pa.RecordBatch:
    """Rows of a hot bucket under four longer keys, each with twelve more bits: prints that link agree on one of the four parts."""
    key, prints = rows.column(0).to_numpy(), rows.column(1).to_numpy().view(np.uint64)
    low = (key >> 29) * 16  # where the segment that the bucket shares lies
    rest = (prints & ((np.uint64(1) << low.astype(np.uint64)) - np.uint64(1))) | (prints >> np.uint64(16) & ~((np.uint64(1) << low.astype(np.uint64)) - np.uint64(1)))
    keys = [key << 14 | i << 12 | (rest >> np.uint64(12 * i) & np.uint64(0xFFF)).astype(np.int64) for i in range(4)]
    n = 4 * len(key)
    return pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(np.concatenate(keys)), pa.array(np.tile(prints.view(np.int64), 4)), pa.array(np.tile(rows.column(2).to_numpy(), 4))], names=["a", "b", "key", "print", "node"])


def _link_batches(batches: Iterator[pa.RecordBatch], hot: int | None = None) -> Iterator[pa.RecordBatch]:
    """Links of rows (key, print, node) sorted by key; a bucket of more than `hot` rows comes back under longer keys instead."""
    held: list[pa.RecordBatch] = []  # of the last bucket, which may go on
    n, over = 0, None
    for b in batches:
        if not len(b):
            continue
        keys = b.column(0).to_numpy()
        if over is not None:
            more = int(np.searchsorted(keys, over, side="right"))
            if more:
                yield _again(pa.Table.from_batches([b.slice(0, more)]))
            if more == len(b):
                continue
            b, keys, over = b.slice(more), keys[more:], None
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut or (held and keys[0] != held[0].column(0)[0].as_py()):
            yield _links(pa.Table.from_batches([*held, b.slice(0, cut)]).combine_chunks())
            held, n = [], 0
        held.append(b.slice(cut))
        n += len(b) - cut
        if hot is not None and n > hot:
            yield _again(pa.Table.from_batches(held).combine_chunks())
            held, n, over = [], 0, int(keys[-1])
    if held:
        yield _links(pa.Table.from_batches(held).combine_chunks())


def _links(rows: pa.Table) -> pa.RecordBatch:
    node = rows.column(2).to_numpy()
    i, j = spanning_links(rows.column(0).to_numpy(), rows.column(1).to_numpy().view(np.uint64))
    none = pa.nulls(len(i), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(node[i], node[j])), pa.array(np.maximum(node[i], node[j])), none, none, none], names=["a", "b", "key", "print", "node"])


def simhash_components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links) of every row of docs.

    Null and empty texts have fingerprint zero and link like any other; rows without a
    doc_id get a fingerprint but no part in links (component_id null); repeated rows stay
    repeated; an empty table gives an empty result; other columns are ignored.
    """
    prints = written(map_batches(spread(pick(docs, "doc_id", "text")), _print_batches, "doc_id long, print long"), "prints")
    nodes = written(prints.where("doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("node")), "nodes")
    keyed = map_batches(nodes, _key_batches, "key long, print long, node long")
    first = written(map_batches(keyed.repartition("key").sortWithinPartitions("key"), lambda b: _link_batches(b, HOT_BUCKET), LINKS), "links")
    again = first.where("key is not null").select("key", "print", "node")
    second = map_batches(again.repartition("key").sortWithinPartitions("key"), _link_batches, LINKS)
    links = first.where("key is null").unionByName(second).select("a", "b")
    labels = components(links.distinct())
    found = nodes.join(labels, nodes["node"] == labels["id"], "left").select(F.col("print").alias("p"), F.coalesce("label", "node").alias("component"))
    return prints.join(found, F.col("print") == F.col("p"), "left").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id")
    )


def simhash_dedup(docs: DataFrame) -> DataFrame:
    """docs without the near-copies: of each component the row of the smallest doc_id stays, once; rows without doc_id stay."""
    found = written(simhash_components(docs), "components").where("doc_id is not null")
    copies = found.where("doc_id <> component_id").select(F.col("doc_id").alias("__id")).distinct()
    kept = without(docs, copies)
    if found.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1").isEmpty():
        return kept
    rows, one = numbered(kept), f"__c{docs.columns.index('doc_id')}"
    return rows.where(F.col(one).isNotNull()).dropDuplicates([one]).unionByName(rows.where(F.col(one).isNull())).toDF(*docs.columns)
