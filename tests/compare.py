"""Comparing a Spark frame with a DuckDB result as multisets of rows."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return f"{value:f}"
    if isinstance(value, datetime):
        return value.isoformat(" ")
    if isinstance(value, date):
        return value.isoformat()
    return value


def of_spark(df: DataFrame) -> tuple[list[str], Counter]:
    order = sorted(df.columns)
    rows = df.select(*[f"`{c}`" for c in order]).collect()
    return order, Counter(tuple(plain(v) for v in r) for r in rows)


def of_duckdb(con: duckdb.DuckDBPyConnection, text: str) -> tuple[list[str], Counter]:
    result = con.execute(text)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = result.fetchall()
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


# Spark type -> DuckDB type, so that a column cannot differ in type and agree in text.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def type_differences(df: DataFrame, con: duckdb.DuckDBPyConnection, text: str) -> list[str]:
    found = {d[0]: str(d[1]) for d in con.execute(f"SELECT * FROM ({text}) LIMIT 0").description}
    differences = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        want = SAME_TYPE.get(kind, kind.upper())
        if found.get(f.name) != want:
            differences.append(f"{f.name}: spark {want}, duckdb {found.get(f.name)}")
    return differences
