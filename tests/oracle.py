"""Side-by-side comparison of registered queries with their SQL."""

from __future__ import annotations

import duckdb

from curatrix.registry.base import TABLE_NAMES


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if hasattr(value, "item"):
        return value.item()
    return str(value) if isinstance(value, (list, tuple, dict)) else value


def _rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    plain = [tuple(_plain(row[n]) for n in order) for row in rows]
    return [columns[n] for n in order], sorted(plain, key=repr)


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql: str):
    result = con.execute(sql)
    return _rows([d[0] for d in result.description], result.fetchall())


def first_difference(left, right) -> str:
    if left[0] != right[0]:
        return f"columns {left[0]} against {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows against {len(right[1])}"
    for a, b in zip(left[1], right[1], strict=True):
        if a != b:
            return f"{a!r:.600} against {b!r:.600}"
    return ""
