"""Compare a Spark result with a SQL result: columns, rows, types and values, in any order."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return "D" + str(value)
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, int):
        return f"i{value}"
    if isinstance(value, datetime.datetime):
        return "T" + value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return "d" + value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def database(folder: str):
    """A connection with the sample tables of a folder as views."""
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return db


def difference(got_columns, got, want_columns, want) -> str:
    """What differs, '' if nothing does."""
    gc, gr = rows_of(got_columns, [tuple(r) for r in got])
    wc, wr = rows_of(want_columns, want)
    if gc != wc:
        return f"columns only-spark {set(gc) - set(wc)} only-sql {set(wc) - set(gc)}"
    if len(gr) != len(wr):
        return f"rows {len(gr)} / {len(wr)}"
    if gr != wr:
        a, b = set(gr) - set(wr), set(wr) - set(gr)
        return f"{len(a)} of {len(gr)} rows differ\n   {gc}\n   spark {sorted(a)[:2]}\n   sql   {sorted(b)[:2]}"
    return ""
