"""Compare a Spark query with its SQL oracle over the same files."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return None if value is None else str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    key = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(key, key=lambda r: tuple((c is None, c or "") for c in r))


def spark_rows(df):
    table = df.toArrow()
    return rows_of(table.column_names, zip(*[c.to_pylist() for c in table.columns]))


def oracle_rows(con, sql):
    cursor = con.execute(sql)
    return rows_of([d[0] for d in cursor.description], cursor.fetchall())


def difference(spark_result, oracle_result) -> str | None:
    names, rows = spark_result
    other_names, other_rows = oracle_result
    if names != other_names:
        return f"columns {names} != {other_names}"
    if rows == other_rows:
        return None
    extra, lost = set(rows) - set(other_rows), set(other_rows) - set(rows)
    return (
        f"{len(rows)} and {len(other_rows)} rows; only spark {len(extra)} {sorted(extra, key=str)[:2]}; "
        f"only sql {len(lost)} {sorted(lost, key=str)[:2]}"
    )
