"""Sum-of-squares packing of documents into sequences of a fixed length.

Pieces are dealt into lots of about `lot` pieces by a hash; each lot is packed by
itself, so a task's memory is bounded and lots run side by side.  Within a lot, pieces
come from long to short and each goes where the sum of the squared counts of open
sequences per residual gap becomes smallest; a sequence is opened when none has room.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .shared import map_batches, pick, spread, written

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"
#: Pieces that are packed together.
LOT = 20_000


def pieces(docs: DataFrame, vocabulary: str, size: int, end_id: int) -> DataFrame:
    """Each document's ids and the end id, cut into pieces of `size` tokens of which the first may be shorter."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokens.path(vocabulary))
        for b in batches:
            ids, out = b.column(0).to_pylist(), []
            for row, texts in tokens.balanced(b.column(1)):
                values, ends = encoder.ended(texts, end_id)
                values, ends = values.astype("<u4"), ends.tolist()
                for i, (a, z) in enumerate(pairwise(ends), row):
                    all_ids = values[a:z]
                    at, stop, k = 0, len(all_ids) % size or size, 0
                    while at < len(all_ids):
                        out.append((ids[i], k, at, stop - at, zlib.crc32(all_ids[at:stop])))
                        at, stop, k = stop, stop + size, k + 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], t) for t in kinds], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_batches(spread(pick(docs, "doc_id", "text")), cut, PIECES, tokens=True)


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece, placed in the order given.

    Moving one sequence from gap g to gap g - s changes the sum of squares by
    2 (N[g - s] - N[g]) + 2, and by 1 - 2 N[g] if it becomes full, as full ones
    aren't open.  Of equal changes the smallest gap wins.
    """
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    count = np.zeros(size + 1, dtype=np.int64)  # open sequences by gap
    at: list[list[int]] = [[] for _ in range(size + 1)]
    opened = 0
    absent = np.iinfo(np.int64).max
    for i, s in enumerate(lengths.tolist()):
        best = 0
        if s < size:
            here = count[s:size]
            change = np.where(here > 0, 2 * (count[: size - s] - here) + 2, absent)
            change[0] = 1 - 2 * here[0] if here[0] else absent
            g = int(change.argmin())
            best = g + s if change[g] != absent else 0
        if best:
            k = at[best].pop()
            count[best] -= 1
        else:
            k, best, opened = opened, size, opened + 1
        sequence[i], offset[i] = k, size - best
        if best > s:
            at[best - s].append(k)
            count[best - s] += 1
    return sequence, offset


def pack(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", size: int = 2048, end_id: int = 0, lot: int = LOT) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every row of docs.

    Null and empty texts are the end id alone.  Null ids pass through and repeated rows are
    separate documents (with equal pieces).  An empty table gives an empty result.
    """
    cut = written(pieces(docs, vocabulary, size, end_id), "pieces")
    lots = max(1, -(-cut.count() // lot))

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable", ignore_index=True)
        sequence, offset = sum_of_squares(rows["length"].to_numpy(), size)
        rows["sequence_id"] = (int(key[0]) << 32) + sequence
        rows["offset"] = offset
        return rows.drop(columns="lot")

    return cut.withColumn("lot", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(lots))).groupBy("lot").applyInPandas(place, PACKED)
