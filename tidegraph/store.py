"""The three tables as versioned snapshots, written by key.

Every table has a key (a vertex's id, a follower, a relay list's owner), and a change
replaces all rows of some keys.  A commit writes just these rows and keys, as a layer
over the base; readers take a key's rows from the newest layer that names it, else from
the base.  When layers have grown to a part of the base, they are folded into those of
its buckets (by a hash of the key) that they touch; the number of buckets follows the
table.  So what a commit writes follows what changed, not the size of the graph.

A version is one small file that is created exclusively, so of two writers that start
from one version only one succeeds, and readers see all tables of one version or all of
another and are never blocked.  The newest versions are kept, with the files they need.
"""

from __future__ import annotations

import atexit
import contextlib
import json
import os
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import TABLES, VERSION

#: The key of each table.
KEYS = {"pubkeys": "id", "follows": "follower_id", "pubkey_relays": "pubkey_id"}
#: Buckets of a new table, and rows that one should hold; a table of twice as many rows gets twice the buckets.
BUCKETS, BUCKET_ROWS = 16, 4_000_000
#: Layers are folded when there are more than so many, or their rows exceed this part of the base and this number.
LAYERS, PART, FEW = 12, 0.25, 100_000
#: The version that wrote a layer's row.
LAYER = T.StructField("__layer", T.LongType())
#: Versions that are kept.
RETAINED = 32


_local: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or where that is unset (as in tests) a temporary one for the application."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or _local.get(sc.applicationId)
    if not found:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = _local[sc.applicationId] = tempfile.mkdtemp(prefix="shared-")  # Spark lets nobody set it later
    return found.rstrip("/")


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended
        fs, where = _files(spark, path)
        fs.delete(where, True)


def fresh(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver exits."""
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(delete, spark, path)
    return path


def settled(df: DataFrame, name: str) -> DataFrame:
    """df as a written table: the lineage before it is cut."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Conflict(RuntimeError):
    """Another commit came first."""


@dataclass(frozen=True)
class Table:
    """Where a table lies: its base by bucket, and layers (rows and keys), oldest first."""

    buckets: int = BUCKETS
    rows: int = 0
    base: dict[str, str] = field(default_factory=dict)
    layers: tuple[dict, ...] = ()

    def folders(self) -> set[str]:
        return {*self.base.values(), *(x["at"] for x in self.layers)}


@dataclass(frozen=True)
class Snapshot:
    """One version of all tables."""

    spark: SparkSession
    version: int
    tables: dict[str, Table]

    def _read(self, name: str, *paths: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(*paths) if paths else self.spark.createDataFrame([], TABLES[name])

    def _layers(self, name: str, part: str, schema: T.StructType) -> DataFrame:
        """All layers' rows or keys, in one read: each row carries its layer."""
        return self.spark.read.schema(T.StructType([*schema.fields, LAYER])).parquet(*[f"{x['at']}/{part}" for x in self.tables[name].layers])

    def _newest(self, name: str) -> DataFrame:
        """(key, __layer): the newest layer that names each key of any."""
        key = KEYS[name]
        return self._layers(name, "keys", T.StructType([TABLES[name][key]])).groupBy(key).agg(F.max("__layer").alias("__layer"))

    def _merged(self, name: str, base: DataFrame) -> DataFrame:
        key = KEYS[name]
        if not self.tables[name].layers:
            return base
        newest = self._newest(name)
        over = self._layers(name, "rows", TABLES[name]).join(newest, [key, "__layer"], "left_semi").select(*base.columns)
        return base.join(newest, key, "left_anti").select(*base.columns).unionByName(over)

    def table(self, name: str) -> DataFrame:
        return self._merged(name, self._read(name, *sorted(self.tables[name].base.values())))

    def of_keys(self, name: str, keys: DataFrame) -> DataFrame:
        """The rows of some keys (one column): only their buckets are read."""
        t, key = self.tables[name], KEYS[name]
        keys = keys.toDF(key).distinct()
        touched = [str(r[0]) for r in keys.select(bucket(key, t.buckets)).distinct().collect()]  # at most the number of buckets
        return self._merged(name, self._read(name, *sorted(t.base[b] for b in touched if b in t.base))).join(keys, key, "left_semi")

    @property
    def pubkeys(self) -> DataFrame:
        return self.table("pubkeys")

    @property
    def pubkey_relays(self) -> DataFrame:
        return self.table("pubkey_relays")

    @property
    def follows(self) -> DataFrame:
        return self.table("follows")


def bucket(column: str, buckets: int):
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # versions

    def _versions(self) -> list[int]:
        fs, where = _files(self.spark, f"{self.root}/versions")
        if not fs.exists(where):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(where)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _pointer(self, version: int) -> str:
        return f"{self.root}/versions/{version:012d}.json"

    def _load(self, version: int) -> tuple[int, dict[str, Table]]:
        """The schema and the tables of a version."""
        fs, where = _files(self.spark, self._pointer(version))
        stream = fs.open(where)
        try:
            at = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return at["schema"], {name: Table(t["buckets"], t["rows"], t["base"], tuple(t["layers"])) for name, t in at["tables"].items()}

    def _create(self, version: int, tables: dict[str, Table]) -> None:
        """The version's file, whole or not at all; fails if there is one."""
        text = json.dumps({"schema": VERSION, "tables": {n: {"buckets": t.buckets, "rows": t.rows, "base": t.base, "layers": list(t.layers)} for n, t in tables.items()}})
        jvm = self.spark._jvm
        fs, final = _files(self.spark, self._pointer(version))
        temporary = jvm.org.apache.hadoop.fs.Path(f"{self.root}/versions/.{uuid.uuid4().hex}")
        out = fs.create(temporary, True)
        out.write(text.encode())
        out.close()
        try:
            if (fs.getUri().getScheme() or "file") == "file":  # a local rename would replace the other's file
                os.link(temporary.toUri().getPath(), final.toUri().getPath())
            else:
                none = jvm.java.lang.reflect.Array.newInstance(jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.spark._jsc.hadoopConfiguration()).rename(temporary, final, none)
        except FileExistsError as e:
            raise Conflict(f"version {version} is another's") from e
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                raise Conflict(f"version {version} is another's") from e
            raise
        finally:
            fs.delete(temporary, False)

    def bootstrap(self) -> Snapshot:
        """Empty tables unless there are some, and those of an older schema made new; may run any number of times."""
        versions = self._versions()
        if not versions:
            with contextlib.suppress(Conflict):
                self._create(0, {name: Table() for name in TABLES})
        elif self._load(versions[-1])[0] < VERSION:
            with contextlib.suppress(Conflict):
                self._upgrade(versions[-1])
        return self.current()

    def _upgrade(self, version: int) -> None:
        """Columns and tables that an older schema lacks: files don't change, as readers fill in what is missing."""
        _, tables = self._load(version)
        self._create(version + 1, {name: tables.get(name, Table()) for name in TABLES})

    def current(self) -> Snapshot:
        """The newest version; a reader that holds it isn't affected by commits."""
        version = self._versions()[-1]
        schema, tables = self._load(version)
        if schema != VERSION:
            raise ValueError(f"schema {schema}, not {VERSION}; bootstrap the store" if schema < VERSION else f"schema {schema} is newer than {VERSION}")
        return Snapshot(self.spark, version, tables)

    # commits

    def commit(self, base: Snapshot, **changes: DataFrame | tuple[DataFrame, DataFrame]) -> Snapshot:
        """The next version: `changes` are by table the new rows of some keys, or these rows and the keys.

        A table's keys are those of its rows if they aren't given; a key without rows loses
        its own.  Raises Conflict if someone else committed since `base` was read.
        """
        home = f"{self.root}/v={base.version + 1}-{uuid.uuid4().hex}"
        tables = dict(base.tables)
        for name, change in changes.items():
            rows, keys = change if isinstance(change, tuple) else (change, None)
            tables[name] = self._layered(tables[name], name, f"{home}/{name}", base.version + 1, rows, keys)
        after = Snapshot(self.spark, base.version + 1, tables)
        for name in changes:
            t = tables[name]
            if len(t.layers) > LAYERS or sum(x["rows"] for x in t.layers) > max(PART * t.rows, FEW):
                tables[name] = self._folded(after, name, f"{home}/{name}-base")
                delete(self.spark, f"{home}/{name}")  # no version refers to this layer
        try:
            self._create(base.version + 1, tables)
        except Conflict:
            delete(self.spark, home)
            raise
        self._expire(base.version + 1)
        return Snapshot(self.spark, base.version + 1, tables)

    def update(self, change: Callable[[Snapshot], dict], tries: int = 20) -> Snapshot:
        """commit(base, **change(base)), from the start again if another commit came first; nothing if change gives nothing."""
        for n in range(tries):
            base = self.current()
            changes = change(base)
            if not changes:
                return base
            try:
                return self.commit(base, **changes)
            except Conflict:
                if n == tries - 1:
                    raise
        raise AssertionError

    def _layered(self, t: Table, name: str, at: str, version: int, rows: DataFrame, keys: DataFrame | None) -> Table:
        key, layer = KEYS[name], F.lit(version).cast("long").alias("__layer")
        rows.select(*TABLES[name].names, layer).write.parquet(f"{at}/rows")
        written = self.spark.read.schema(TABLES[name]).parquet(f"{at}/rows")
        (written.select(key) if keys is None else keys.toDF(key)).distinct().select(key, layer).write.parquet(f"{at}/keys")
        return Table(t.buckets, t.rows, t.base, (*t.layers, {"at": at, "rows": written.count()}))

    def _folded(self, after: Snapshot, name: str, at: str) -> Table:
        """The table with its layers in the base; only buckets that they touch are written, or all if there are too few."""
        t, key = after.tables[name], KEYS[name]
        total, buckets = t.rows + sum(x["rows"] for x in t.layers), t.buckets
        while total > 2 * BUCKET_ROWS * buckets:
            buckets *= 2
        if buckets == t.buckets:
            touched = sorted(r[0] for r in after._newest(name).select(bucket(key, buckets)).distinct().collect())  # at most the number of buckets
        else:
            touched = list(range(buckets))
        old = [str(b) for b in (touched if buckets == t.buckets else range(t.buckets))]
        rows = after._merged(name, after._read(name, *[t.base[b] for b in old if b in t.base])).withColumn("b", bucket(key, buckets))
        rows.repartition(len(touched), "b").sortWithinPartitions("b", *TABLES[name].names[:2]).write.partitionBy("b").parquet(at)
        fs, _ = _files(self.spark, at)
        base = {} if buckets != t.buckets else {b: f for b, f in t.base.items() if b not in old}
        for b in touched:  # a bucket may be left empty
            if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{at}/b={b}")):
                base[str(b)] = f"{at}/b={b}"
        n = self.spark.read.schema(TABLES[name]).parquet(*base.values()).count() if base else 0  # of the files' footers
        return Table(buckets, n, base)

    def _expire(self, version: int) -> None:
        """Deletes versions beyond the newest ones, and files that only they needed."""
        old = [v for v in self._versions() if v <= version - RETAINED]
        if not old:
            return
        keep = {f for v in self._versions() if v > version - RETAINED for t in self._load(v)[1].values() for f in t.folders()}
        for v in old:
            for t in self._load(v)[1].values():
                for folder in t.folders() - keep:
                    delete(self.spark, folder)
            delete(self.spark, self._pointer(v))
