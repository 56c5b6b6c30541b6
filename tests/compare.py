"""Compare published queries with their DuckDB twins, row for row, and look at plans."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def oracle_rows(folder: str, sql: str) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    cursor = connection.execute(sql)
    return [c[0] for c in cursor.description], cursor.fetchall()


def _bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    def cell(value):
        return 0.0 if value == 0 and isinstance(value, float) else value
    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


def difference(df, folder: str, sql: str) -> str | None:
    """None when equal, else a short description of the first differences."""
    columns, expected = oracle_rows(folder, sql)
    if sorted(columns) != sorted(df.columns):
        return f"columns: {sorted(df.columns)} vs {sorted(columns)}"
    got = _bag(df.columns, [tuple(r) for r in df.collect()])
    want = _bag(columns, expected)
    if got == want:
        return None
    return (f"{sum(got.values())} vs {sum(want.values())} rows; "
            f"only spark: {list((got - want).items())[:3]}; "
            f"only oracle: {list((want - got).items())[:3]}")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
