"""Flat token-id files with 64-bit document offsets.

A folder holds shards: `NAME.ids`, unsigned little-endian integers (16 bits if the
vocabulary allows, else 32), and `NAME.idx`, for each document its id and the 64-bit
place of its first token within the shard, then one last place.  Shards follow each
other in ascending doc_id; the base of a shard is the sum of the tokens before it.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .shared import fresh, map_batches, pick, spread, written

MANIFEST = "part int, name string, docs long, tokens long, width int"
#: Rows and tokens that are read back at once.
READ_ROWS, READ_TOKENS = 4096, 4 << 20
#: Uncompressed text that a shard should hold at least, and how many shards there are at most: beyond, shards grow.
SHARD_BYTES, SHARDS = 24 << 20, 16_384
NULL_ID = -(1 << 63)


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")


def write_token_files(docs: DataFrame, folder: str, vocabulary: str = "word_bpe_49k.json", end_id: int = 1) -> DataFrame:
    """Writes the shards of all rows of docs; returns their manifest with `base`, the tokens before each.

    The ids cross the one shuffle, not the texts, and as 16-bit integers where they fit.
    Each attempt of a task writes under its own name, and only the names that finished
    tasks return are in the manifest, so a lost executor leaves at most unread files.
    Null texts are empty documents (the end id alone); rows without doc_id come first,
    under the smallest 64-bit integer; repeated rows are separate documents, the shorter
    first; of an id that fills several shards, the shorter first within each.
    """
    spark = docs.sparkSession
    files, root = _store(folder)
    files.create_dir(root, recursive=True)

    rows = pick(docs, "doc_id", "text")
    size = rows.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 64)).first()[0] or 0
    shards = max(1, min(SHARDS, -(-size // SHARD_BYTES)))
    bounds = np.empty(0, np.int64)
    if shards > 1:  # an id that stands at several bounds is dealt over the shards between them
        at = F.percentile_approx(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), [i / shards for i in range(1, shards)], max(10_000, 8 * shards))
        bounds = np.array(rows.agg(at).first()[0], dtype=np.int64)
    hot = len(np.unique(bounds)) < len(bounds)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokens.path(vocabulary))
        turn = 0
        for b in batches:
            doc = b.column(0).cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            low, high = (np.searchsorted(bounds, doc, side=s) for s in ("left", "right"))
            part = low + (turn + np.arange(len(doc))) % (high - low + 1) if hot else low
            turn += len(doc)
            for row, texts in tokens.balanced(b.column(1)):
                values, at = encoder.ended(texts, end_id)
                ends = (at * encoder.dtype.itemsize).astype(np.int32)
                ids = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(values)])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(row, len(texts)), ids, pa.array(part[row : row + len(texts)].astype(np.int32))], names=["doc_id", "ids", "part"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _store(folder)
        width = tokens.encoder(tokens.path(vocabulary)).dtype.itemsize
        part, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        at, ids = [np.zeros(1, np.int64)], []
        total = 0
        with files.open_output_stream(f"{root}/{name}.ids") as out:
            for b in batches:
                sizes = pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False).astype(np.int64) // width
                ids.append(b.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False))
                at.append(total + np.cumsum(sizes))
                total = int(at[-1][-1]) if len(sizes) else total
                for x in b.column(1):
                    out.write(x.as_buffer())
        index = np.concatenate([*ids, np.empty(0, np.int64)]).astype("<i8")
        with files.open_output_stream(f"{root}/{name}.idx") as out:
            out.write(np.concatenate([index, np.concatenate(at).astype("<i8")]).tobytes())
        if len(index):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name]), pa.array([len(index)]), pa.array([total]), pa.array([width], pa.int32())], names=["part", "name", "docs", "tokens", "width"])

    encoded = map_batches(spread(rows), encode, "doc_id long, ids binary, part int", tokens=True)
    if hot:  # which shard a row takes hangs on its turn: written, it stays so if a task runs again
        encoded = written(encoded, "encoded")
    dealt = encoded.repartitionById(shards, F.col("part"))
    sorted_rows = dealt.sortWithinPartitions("doc_id", F.length("ids")).select("doc_id", "ids")
    found = sorted(map_batches(sorted_rows, write, MANIFEST).collect(), key=lambda r: r["part"])  # one row a shard
    bases = [0, *accumulate(r["tokens"] for r in found)]
    return spark.createDataFrame([(*r, base) for r, base in zip(found, bases, strict=False)], MANIFEST + ", base long")


class TokenShard:
    """One shard, memory-mapped where the store is a local or mounted folder."""

    def __init__(self, folder: str, name: str, docs: int, width: int):
        files, root = _store(folder)
        local = isinstance(files, fs.LocalFileSystem)

        def values(end: str, dtype: str) -> np.ndarray:
            path = f"{root}/{name}.{end}"
            if local:
                return np.memmap(path, dtype=dtype, mode="r")
            with files.open_input_file(path) as f:
                return np.frombuffer(f.read(), dtype=dtype)

        index = values("idx", "<i8")
        self.doc_ids, self.offsets = index[:docs], index[docs:]
        self.ids = values("ids", f"<u{width}") if self.offsets[-1] else np.empty(0, f"<u{width}")

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.offsets[i] : self.offsets[i + 1]]


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens, ids_crc32 of every document in the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard in b.to_pylist():
                s = TokenShard(folder, shard["name"], shard["docs"], shard["width"])
                for i in range(0, shard["docs"], READ_ROWS):
                    j = min(i + READ_ROWS, shard["docs"])
                    at = np.asarray(s.offsets[i : j + 1])
                    crc = [zlib.crc32(s.ids[a:z].astype("<u4")) for a, z in zip(at[:-1], at[1:], strict=True)]
                    ids = np.asarray(s.doc_ids[i:j])
                    yield pa.RecordBatch.from_arrays([pa.array(ids, mask=ids == NULL_ID), pa.array(at[:-1] + shard["base"]), pa.array(np.diff(at)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(1, manifest.count())
    return map_batches(manifest.repartitionByRange(n, "part"), read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame) -> DataFrame:
    """Writes docs as token files in the shared folder and returns what they hold."""
    spark = docs.sparkSession
    folder = fresh(spark, "token-files")
    return read_token_files(spark, folder, write_token_files(docs, folder))
