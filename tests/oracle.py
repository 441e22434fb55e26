"""Runs queries beside their SQL and compares rows as multisets."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(x):
    if isinstance(x, Decimal):
        x = float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 9)
    return tuple(map(_value, x)) if isinstance(x, (list, tuple)) else x


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = _rows(names, cursor.fetchall())
    got = _rows(df.columns, df.collect())
    if want == got:
        return None
    return (
        f"rows {sum(got.values())} != {sum(want.values())}; "
        f"extra {list((got - want).items())[:3]}; missing {list((want - got).items())[:3]}"
    )
