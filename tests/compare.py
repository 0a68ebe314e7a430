"""Row-for-row comparison of a Spark result with SQL run on the same files."""

from __future__ import annotations

from pathlib import Path

import duckdb


def oracle_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    found = con.execute(sql)
    return [c[0] for c in found.description], found.fetchall()


def by_name(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def assert_same(df, sql: str, sf_dir: str) -> int:
    columns, rows = oracle_rows(sql, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    got = by_name(df.columns, [tuple(r) for r in df.collect()])
    want = by_name(columns, rows)
    assert len(got) == len(want), (len(got), len(want))
    assert got == want, next((g, w) for g, w in zip(got, want) if g != w)
    return len(got)
