"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
KIND = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _ordered(rows):
    return sorted(rows, key=lambda row: tuple((value is not None, str(type(value)), value) for value in row))


def differences(frame, con, sql: str, limit: int = 5) -> list[str]:
    """Problems found, empty when both sides agree exactly."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    problems = []
    if sorted(names) != sorted(frame.columns):
        return [f"columns differ: spark {sorted(frame.columns)} duckdb {sorted(names)}"]
    for name, kind in frame.dtypes:
        if KIND.get(kind, kind) != kinds[name]:
            problems.append(f"type of {name}: spark {kind} duckdb {kinds[name]}")
    columns = sorted(names)
    got = _ordered(tuple(row[c] for c in columns) for row in frame.collect())
    index = [names.index(c) for c in columns]
    want = _ordered(tuple(row[i] for i in index) for row in expected)
    if len(got) != len(want):
        problems.append(f"rows: spark {len(got)} duckdb {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        problems.append(f"{len(bad)} rows differ; columns {columns}")
        problems += [f"  spark {g}\n  duck  {w}" for g, w in bad[:limit]]
    return problems
