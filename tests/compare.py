"""Runs registered queries next to their SQL and compares schemas and row multisets."""

from __future__ import annotations

import collections
import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 8) + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


_FAMILY = {"bigint": "long", "int": "int", "double": "double", "string": "text", "date": "date", "boolean": "bool",
           "timestamp_ntz": "time", "timestamp": "timetz"}
_DUCK = {"BIGINT": "long", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "text", "DATE": "date", "BOOLEAN": "bool",
         "TIMESTAMP": "time"}


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences as text; empty when schema and rows agree."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    duck_types = {d[0]: _DUCK.get(str(d[1]), str(d[1])) for d in cursor.description}
    expected = cursor.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    types = {n: _FAMILY.get(t, t) for n, t in df.dtypes}
    problems += [f"type of {n}: {types[n]} against {duck_types[n]}" for n in names if types[n] != duck_types[n]]
    got = collections.Counter(tuple(_plain(v) for v in r) for r in df.select(*(f"`{n}`" for n in names)).collect())
    want = collections.Counter(tuple(_plain(v) for v in r) for r in expected)
    if got != want:
        extra, lost = got - want, want - got
        problems.append(f"{sum(got.values())} rows against {sum(want.values())}; {sum(extra.values())} differ")
        problems.append(f"only Spark: {list(extra)[:3]}")
        problems.append(f"only SQL: {list(lost)[:3]}")
    return problems
