"""Compare catalogue queries with their SQL restatements in DuckDB."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 6) + 0.0
    return value


KINDS = {
    "bigint": "int", "int": "int", "smallint": "int", "INTEGER": "int", "BIGINT": "int",
    "double": "float", "DOUBLE": "float", "string": "text", "VARCHAR": "text",
    "boolean": "bool", "BOOLEAN": "bool",
}


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    result = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    ours = dict(df.dtypes)
    if sorted(theirs) != sorted(ours):
        return f"columns {sorted(ours)} != {sorted(theirs)}"
    for name in ours:
        if KINDS.get(ours[name], ours[name]) != KINDS.get(theirs[name], theirs[name]):
            return f"type of {name}: {ours[name]} != {theirs[name]}"
    names = sorted(ours)
    order = [list(theirs).index(n) for n in names]
    expected = Counter(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    actual = Counter(tuple(plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    if expected == actual:
        return None
    missing, extra = list((expected - actual).elements()), list((actual - expected).elements())
    return (
        f"{sum(actual.values())} rows, {sum(expected.values())} expected; "
        f"missing {sorted(missing, key=str)[:3]}, extra {sorted(extra, key=str)[:3]}"
    )
