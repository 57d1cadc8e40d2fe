"""Side-by-side run of a registered query in Spark and its SQL in DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple(map(repr, r)))


def spark_result(df):
    return _sorted(df.columns, [tuple(r) for r in df.collect()])


def sql_result(con, sql):
    cur = con.execute(sql)
    return _sorted([d[0] for d in cur.description], cur.fetchall())


def differences(df, con, sql) -> str | None:
    cols, rows = spark_result(df)
    want_cols, want = sql_result(con, sql)
    if cols != want_cols:
        return f"columns {cols} != {want_cols}"
    if len(rows) != len(want):
        extra = [r for r in rows if r not in set(map(lambda x: x, want))][:2] if len(rows) < 2000 else ""
        return f"{len(rows)} rows != {len(want)}; first extra {str(extra)[:600]}"
    bad = [(a, b) for a, b in zip(rows, want) if a != b or list(map(type, a)) != list(map(type, b))]
    if bad:
        return f"{len(bad)} of {len(rows)} rows differ, first\n  spark {str(bad[0][0])[:800]}\n  sql   {str(bad[0][1])[:800]}"
    return None
