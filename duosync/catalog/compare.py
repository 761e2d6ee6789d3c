"""Comparing a query's rows with those of its SQL."""

from __future__ import annotations

import datetime
import decimal
import math

from duosync.catalog.standins import TABLES


def canonical(value):
    if value is None:
        return None
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.6f}"
    if isinstance(value, datetime.datetime):
        return value.isoformat(timespec="microseconds")
    return str(value)


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(canonical(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, v or "") for v in r))


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def difference(df, con, sql: str) -> str | None:
    """None when the rows are equal, else a short description."""
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(cols)}"
    want = rows_of(cols, cur.fetchall())
    got = rows_of(df.columns, df.collect())
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for g, w in zip(got, want, strict=True):
        if g != w:
            return f"{sorted(cols)}: {g} against {w}"
    return None
