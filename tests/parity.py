"""Spark results against DuckDB: columns by name, rows as sorted values."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if path.is_dir() else ''}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def rows(names: list[str], values) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=lambda r: tuple((x is None, str(x)) for x in r))


KINDS = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean", "SMALLINT": "smallint", "TIMESTAMP": "timestamp_ntz"}


def compare(df, con, sql: str) -> None:
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    assert sorted(df.columns) == sorted(names)
    for name, kind in df.dtypes:
        want = KINDS.get(kinds[name], kinds[name])
        assert kind == want or {kind, want} <= {"timestamp", "timestamp_ntz"}, f"{name}: {kind}, {want}"
    a, b = rows(df.columns, [tuple(r) for r in df.collect()]), rows(names, result.fetchall())
    assert len(a) == len(b), f"{len(a)} rows, {len(b)} expected"
    for x, y in zip(a, b, strict=True):
        assert x == y, f"{x} is not {y}"
