"""Run a query in Spark and its oracle in DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

GIVEN = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(v):
    if v is None:
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        f = float(v)
        return "nan" if math.isnan(f) else repr(round(f, 6) + 0.0)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(plain(x) for x in v) + "]"
    return str(v)


def spark_rows(df):
    names = sorted(df.columns)
    rows = [tuple(plain(r[n]) for n in names) for r in df.collect()]
    return names, sorted(rows)


def oracle_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(plain(r[i]) for i in order) for r in cur.fetchall()]
    return sorted(cols), sorted(rows)


def difference(df, con, sql) -> str | None:
    """None when equal, else a short account of the first difference."""
    names, got = spark_rows(df)
    want_names, want = oracle_rows(con, sql)
    if names != want_names:
        return f"columns {set(names) ^ set(want_names)}"
    if len(got) != len(want):
        extra = [r for r in got if r not in set(want)][:2]
        missing = [r for r in want if r not in set(got)][:2]
        return f"rows {len(got)} != {len(want)}; extra {extra}; missing {missing}"
    for a, b in zip(got, want):
        if a != b:
            cells = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
            return f"cells {cells[:6]}"
    return None
