"""Nearest neighbours by a block matrix join of int8 tiles.

Queries and candidates are dealt into blocks, and each pair of blocks is a tile.  In a
tile the vectors are quantised to int8 (a scale each) and multiplied; with q and c the
vectors, q', c' their quantised forms and e = |q - q'|, f = |c - c'| the errors,

    |q.c - q'.c'| <= |q'| f + e |c'| + e f.

A pair survives if its upper bound reaches the k-th largest lower bound of its query in
the tile.  Bounds are of vectors scaled by powers of two (each query by its own, the
candidates of a tile by one), so that no finite component overflows; what underflows is
covered by a slack.  Survivors are recomputed in double precision on the original
vectors, and heaps merge the tiles' k best.  So nothing is lost: the result is exact.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_batches, pick, written

#: Vectors per block at least, how many blocks there should be, and components per block at most: blocks
#: grow with the table, as each vector is sent once to every block of the other side, until memory bounds them.
BLOCK, BLOCKS, COMPONENTS = 8192, 64, 8 << 20
#: Products that a tile holds at once.
PRODUCTS = 2 << 20
#: Survivors that are recomputed at once.
PAIRS = 1 << 16
BEST = "query_id long, vec_id long, score double"


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, norms of the quantised vectors and norms of the errors."""
    most = np.abs(x).max(axis=1, initial=0)
    most = np.where(most > 0, most, 1)
    unit = x / most[:, None]  # so that no square underflows
    codes = np.rint(unit * 127).astype(np.int8)
    near = codes / 127.0
    return codes, most / 127, np.linalg.norm(near, axis=1) * most, np.linalg.norm(unit - near, axis=1) * most


def scaled(x: np.ndarray, each: bool) -> tuple[np.ndarray, np.ndarray]:
    """x times a power of two, of each row or of all, that brings the largest component under 1; and the exponents."""
    exponent = np.frexp(np.abs(x).max(axis=1, initial=0))[1].astype(np.int64)
    if not each:
        exponent = np.full_like(exponent, exponent.max(initial=-1100))
    return np.ldexp(x, -exponent[:, None]), exponent


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact int8 products a @ b.T: sums of up to 1024 products of 127 x 127 are whole numbers that float32 holds."""
    out = np.zeros((len(a), len(b)))
    for i in range(0, a.shape[1], 1024):
        out += a[:, i : i + 1024].astype(np.float32) @ b[:, i : i + 1024].astype(np.float32).T
    return out


def ranked(score: np.ndarray) -> np.ndarray:
    """Scores to rank by: one that is no number, as infinities of both signs met in its sum, comes last."""
    return np.where(np.isnan(score), -np.inf, score)


def inner(q: np.ndarray, r: np.ndarray, c: np.ndarray, s: np.ndarray) -> np.ndarray:
    """q[r].c[s] for each pair, added up in the order of the components, so that equal vectors give equal scores anywhere."""
    out = np.zeros(len(r))
    with np.errstate(over="ignore", invalid="ignore"):
        for i in range(0, len(r), PAIRS):
            at = slice(i, i + PAIRS)
            for j in range(q.shape[1]):
                out[at] += q[r[at], j] * c[s[at], j]
    return out


def tile(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query ids, candidate ids, scores) of the k best candidates in the tile of each query."""
    (q1, power), (c1, to) = scaled(q, True), scaled(c, False)
    qc, qs, qn, qe = quantised(q1)
    cc, cs, cn, ce = quantised(c1)
    slack = 1 + 1e-9
    # what underflows, here or in the scores; where scores may overflow, all candidates survive
    power = power + to[0]
    with np.errstate(over="ignore"):
        lost = np.where(power > 1020 - q.shape[1].bit_length(), np.inf, q.shape[1] * (2.0**-1000 + np.ldexp(1.0, -1074 - power)))
    step = max(1, PRODUCTS // len(c))
    for i in range(0, len(q), step):
        rows = slice(i, i + step)
        near = products(qc[rows], cc) * qs[rows, None] * cs[None, :]
        error = (qn[rows, None] * ce + qe[rows, None] * (cn + ce)) * slack + 1e-12 * (qn[rows, None] + qe[rows, None]) * (cn + ce) + lost[rows, None]
        low, high = near - error, near + error
        own = qid[rows, None] == cid[None, :]
        low[own], high[own] = -np.inf, -np.inf
        if len(c) > k:
            kth = np.partition(low, len(c) - k, axis=1)[:, len(c) - k]
            r, s = np.nonzero((high >= kth[:, None]) & ~own)
        else:
            r, s = np.nonzero(~own)
        score = inner(q[rows], r, c, s)
        order = np.lexsort((cid[s], -ranked(score), r))
        r, s, score = r[order], s[order], score[order]
        start = np.searchsorted(r, np.arange(r[-1] + 1 if len(r) else 0))
        keep = np.arange(len(r)) - start[r] < k
        yield qid[rows][r[keep]], cid[s[keep]], score[keep]


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, dimension, vector as bytes of float64 or float32) of vectors that take part."""
    for b in batches:
        lists = b.column(1)
        size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten()
        ends = np.cumsum(size)
        x = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False)
        x = x.astype(x.dtype.newbyteorder("<"), copy=False)
        good = np.concatenate([[0], np.cumsum(np.isfinite(x))])
        some = np.concatenate([[0], np.cumsum(x != 0)])
        start = ends - size
        takes = (good[ends] - good[start] == size) & (some[ends] > some[start]) & b.column(0).is_valid().to_numpy(zero_copy_only=False)
        at, raw, width = np.flatnonzero(takes), x.tobytes(), x.dtype.itemsize
        vectors = [raw[a:z] for a, z in zip((start[at] * width).tolist(), (ends[at] * width).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(size[at].astype(np.int32)), pa.array(vectors, pa.binary())], names=["vec_id", "dim", "vector"])


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, block: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of largest inner product with each query, all if fewer.

    Queries are the rows whose vec_id is divisible by `every`, candidates every other row
    of the same dimension.  Vectors that are null, empty, zero or hold a null or non-finite
    component take no part, nor rows without vec_id.  Different vectors under one vec_id are
    rows of their own: each is a candidate of the other ids, and a repeated query has the k
    best of all its rows' pairs.  Equal copies under one vec_id count once.  An empty table
    gives an empty result.
    """
    kind = "<f8" if "double" in dict(vectors.dtypes)["embedding"] else "<f4"
    rows = map_batches(pick(vectors, "vec_id", "embedding"), _usable, "vec_id long, dim int, vector binary")
    rows = written(rows.distinct(), "vectors")
    is_query = F.col("vec_id") % every == 0
    n, m, dim = rows.agg(F.count("vec_id"), F.count_if(is_query), F.max("dim")).first()
    block = block or max(1, min(max(BLOCK, n // BLOCKS), COMPONENTS // (dim or 1)))
    across, down = max(1, -(-n // block)), max(1, -(-m // block))

    def dealt(df: DataFrame, own: int, other: int, query: bool) -> DataFrame:
        """Each vector once in each tile of its block."""
        mine = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(own))
        tiles = F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias("o")
        at = (F.col("mine") * other + F.col("o")) if query else (F.col("o") * own + F.col("mine"))
        return df.select("vec_id", "dim", "vector", mine.alias("mine"), tiles).select("dim", at.alias("tile"), "vec_id", "vector")

    def work(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(candidates):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        q, c = (np.frombuffer(b"".join(x["vector"]), kind).reshape(len(x), -1).astype(np.float64) for x in (queries, candidates))
        parts = list(zip(*tile(queries["vec_id"].to_numpy(), q, candidates["vec_id"].to_numpy(), c, k), strict=True))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, parts), strict=True)))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A heap of the k best for the query at hand; rows come sorted by query."""
        now, heap = None, []

        def out() -> pa.RecordBatch:
            best = sorted(heap, reverse=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([now] * len(best), pa.int64()), pa.array(range(1, len(best) + 1), pa.int32()), pa.array([-x[1] for x in best], pa.int64()), pa.array([x[2] for x in best], pa.float64())], names=["query_id", "rank", "vec_id", "score"]
            )

        for b in batches:
            for query, vec, score in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if query != now:
                    if heap:
                        yield out()
                    now, heap = query, []
                score = float("nan") if score is None else score  # pandas made it null
                entry = (float("-inf") if score != score else score, -vec, score)
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                else:
                    heapq.heappushpop(heap, entry)
        if heap:
            yield out()

    queries = dealt(rows.where(is_query), down, across, True)
    found = queries.groupBy("dim", "tile").cogroup(dealt(rows, across, down, False).groupBy("dim", "tile")).applyInPandas(work, BEST)
    return map_batches(found.repartition("query_id").sortWithinPartitions("query_id"), merge, "query_id long, rank int, vec_id long, score double")
