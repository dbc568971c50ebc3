"""What the operators share: column choice, cut lineage, Arrow batches."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..deploy import ship

#: Arrow batches carry at most about this many bytes to a Python worker.
BATCH_BYTES = 8 << 20
BATCH_ROWS = 4000


_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or where that is unset (as in tests) a temporary one for the application."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or _local.get(sc.applicationId)
    if not found:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = _local[sc.applicationId] = tempfile.mkdtemp(prefix="shared-")  # Spark lets nobody set it later
    return found.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


_open: list[list[str]] = []


def fresh(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver exits, or before by the `passing` that it is made in."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(delete, spark, path)
    if _open:
        _open[-1].append(path)
    return path


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[list[str]]:
    """The paths made inside, which are deleted at the end; one that is taken off the list stays."""
    paths: list[str] = []
    _open.append(paths)
    try:
        yield paths
    finally:
        _open.remove(paths)
        for path in paths:
            delete(spark, path)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: later steps start from it, and a lost executor costs no more than its own tasks."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> DataFrame:
    """df with its columns named by place, so that clashing names can't be ambiguous."""
    return df.toDF(*[f"__c{i}" for i in range(len(df.columns))])


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Just these columns.  Of several of one name (or of names that differ in case) the first exact one counts."""
    at = [df.columns.index(n) for n in names]
    return numbered(df).select(*[F.col(f"__c{i}").alias(n) for i, n in zip(at, names, strict=True)])


def column(df: DataFrame, name: str) -> Column:
    """The column of numbered(df) that has this name in df."""
    return F.col(f"__c{df.columns.index(name)}")


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs without the rows whose doc_id is among ids (__id); rows of no id stay.

    The ids are written first, so that Spark knows how many there are when it plans: it
    broadcasts them if they are few, and only otherwise shuffles the documents.
    """
    return numbered(docs).join(written(ids, "ids"), column(docs, "doc_id") == F.col("__id"), "left_anti").toDF(*docs.columns)


def trim() -> None:
    """Gives freed memory back, as a Python worker outlives its task and several share an executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, tokens: bool = False) -> DataFrame:
    """mapInArrow with batches bounded by bytes as well as rows.

    A worker that turns to an operator without `tokens` drops the words it remembers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not tokens and (module := sys.modules.get("tidegraph.llm.tokens")):
            module.forget()
        yield from f(batches)
        trim()

    spark = df.sparkSession
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(run, schema)


def spread(df: DataFrame) -> DataFrame:
    """df over all cores, if a small table's few files leave some without work; never so on a large one."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def held_out(modulus: int, remainder: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder
