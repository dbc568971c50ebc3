"""Token counts of whole texts, in Arrow functions that return lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .shared import map_batches, pick, spread


def token_counts(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of docs.

    One pass without a shuffle.  Batches are cut to about equal bytes, long texts at
    places no token spans.  Null texts count as empty (0 bytes, 0 tokens); null ids and
    repeated rows pass through; an empty table gives an empty result.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokens.path(vocabulary))
        for b in batches:
            n = np.concatenate([np.empty(0, np.int64), *(np.diff(encoder.arrays(texts)[1]) for _, texts in tokens.balanced(b.column(1)))])
            size = pc.fill_null(pc.binary_length(b.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return map_batches(spread(pick(docs, "doc_id", "text")), count, "doc_id long, n_bytes long, n_tokens long", tokens=True).withColumn("over_limit", F.col("n_tokens") > limit)
