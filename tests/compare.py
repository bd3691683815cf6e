"""Compare a registered query with its SQL twin in DuckDB, value by value."""

from __future__ import annotations

import math

import duckdb

from workload.tables import TABLES


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def table_of(columns, rows):
    """Column names in order, and the rows as sorted text: independent of row order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(plain(row[i]) for i in order) for row in rows)


def spark_table(df):
    return table_of(df.columns, df.collect())


def sql_table(con, sql):
    cur = con.execute(sql)
    return table_of([d[0] for d in cur.description], cur.fetchall())


def first_difference(got, want) -> str:
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}"
    pairs = [(a, b) for a, b in zip(got[1], want[1]) if a != b][:3]
    return f"rows {len(got[1])} / {len(want[1])}; " + "; ".join(f"{a} / {b}" for a, b in pairs)
