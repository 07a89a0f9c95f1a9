"""Compare a Spark result with DuckDB's for the same query."""

from __future__ import annotations

import math

import duckdb

from tasteline.plans.catalog import TABLES

KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((value is None, str(type(value)) if value is None else "", value if value is not None else 0) for value in row)


def mismatch(con: duckdb.DuckDBPyConnection, sql: str, df) -> str | None:
    """None if schema and bag of rows agree, else what differs first."""
    relation = con.sql(sql)
    wanted = dict(zip(relation.columns, map(str, relation.types)))
    got = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    if got != wanted:
        return f"schema: spark {got}, sql {wanted}"
    names = sorted(got)
    ours = sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=_key)
    place = [relation.columns.index(n) for n in names]
    theirs = sorted((tuple(r[i] for i in place) for r in relation.fetchall()), key=_key)
    if len(ours) != len(theirs):
        return f"rows: spark {len(ours)}, sql {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b and not all(
            x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
            for x, y in zip(a, b)
        ):
            return f"values: spark {dict(zip(names, a))}, sql {dict(zip(names, b))}"
    return None
