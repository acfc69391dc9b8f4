"""Runs a query and its SQL on the same tables and compares all rows."""

from __future__ import annotations

from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for p in Path(sf_dir).iterdir():
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def rows(frame, columns):
    out = frame[columns].astype(object).where(frame[columns].notna(), None)
    return sorted(tuple("%.9g" % x if isinstance(x, float) else str(x) for x in r) for r in out.itertuples(index=False))


def same(df, sql: str, sf_dir: str) -> None:
    a, b = df.toPandas(), connect(sf_dir).execute(sql).df()
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    assert rows(a, columns) == rows(b, columns)
