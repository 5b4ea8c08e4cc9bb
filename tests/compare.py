"""Exact comparison of a Spark result with an independent SQL result."""

from __future__ import annotations

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()

_SAME_TYPE = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def differences(df, con, sql: str) -> list[str]:
    """Empty when schema and the multiset of rows agree."""
    relation = con.execute(sql)
    other = {d[0]: str(d[1]) for d in relation.description}
    expected = relation.fetchall()
    found = []
    names = sorted(df.columns)
    if names != sorted(other):
        return [f"columns {sorted(set(names) ^ set(other))}"]
    for name, kind in df.dtypes:
        if _SAME_TYPE.get(kind) != other[name]:
            found.append(f"type of {name}: {kind} / {other[name]}")
    place = {name: i for i, name in enumerate(other)}
    theirs = sorted((tuple(row[place[n]] for n in names) for row in expected), key=repr)
    ours = sorted((tuple(row[n] for n in names) for row in df.collect()), key=repr)
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} / {len(theirs)}")
    for a, b in zip(ours, theirs):
        if a != b:
            pairs = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
            found.append(f"first difference {pairs[:4]} in {a[:6]}")
            break
    return found
