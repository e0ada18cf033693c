"""Compare registered queries with their SQL on the driver's tables."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        v = float(v)
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short account of the difference."""
    cur = con.execute(sql)
    want_cols, want = rows_of([c[0] for c in cur.description], cur.fetchall())
    got_cols, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        return f"{len(bad)} of {len(got)} rows differ; first: {[(c, x, y) for c, x, y in zip(got_cols, g, w) if x != y]}"
    return None
