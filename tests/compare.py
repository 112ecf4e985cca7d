"""Compares a Spark result with a DuckDB result, value by value."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _type(name: str) -> str:
    name = str(name).lower()
    same = {
        "int": "integer", "byte": "tinyint", "short": "smallint", "long": "bigint", "string": "varchar",
        "timestamp_ntz": "timestamp",
    }
    return same.get(name, name)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs; empty if names, types and all rows are equal."""
    problems = []
    columns = sorted(spark_df.columns)
    spark_types = {f.name: _type(f.dataType.simpleString()) for f in spark_df.schema.fields}
    relation = con.sql(sql)
    duck_types = dict(zip(relation.columns, [_type(t) for t in relation.types]))
    if sorted(duck_types) != columns:
        return [f"columns differ: {sorted(set(duck_types) ^ set(columns))}"]
    for c in columns:
        if spark_types[c] != duck_types[c]:
            problems.append(f"type of {c}: {spark_types[c]} / {duck_types[c]}")
    mine = Counter(
        tuple(_plain(v) for v in row) for row in map(tuple, spark_df.select(*columns).collect())
    )
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = Counter(
        tuple(_plain(v) for v in row)
        for row in con.execute(f"SELECT {quoted} FROM ({sql}) q").fetchall()
    )
    if sum(mine.values()) != sum(theirs.values()):
        problems.append(f"rows: {sum(mine.values())} / {sum(theirs.values())}")
    if mine != theirs:
        extra, lacking = mine - theirs, theirs - mine
        problems.append(
            f"{sum(extra.values())} rows differ; columns {columns}; "
            f"first {next(iter(extra), None)} / {next(iter(lacking), None)}"
        )
        if extra and lacking:
            a = sorted(extra, key=repr)
            b = sorted(lacking, key=repr)
            bad = Counter(c for x, y in zip(a, b) for c, v, w in zip(columns, x, y) if v != w)
            problems.append(f"columns at fault: {bad.most_common(8)}")
    return problems
