"""Rows of a query and of its SQL, made comparable."""

import decimal
import math
from pathlib import Path

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, (int, float)):
        return "nan" if math.isnan(v) else repr(round(float(v), 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(sorted(f"{k}:{plain(x)}" for k, x in v.items())) + "}"
    if hasattr(v, "asDict"):
        return plain(v.asDict())
    if hasattr(v, "isoformat"):
        return v.isoformat(" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str:
    """Empty if equal, else what differs first."""
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    theirs = rows_of(rel.columns, rel.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} and {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} and {len(theirs[1])} rows"
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            return f"{str(a)[:700]}\n{str(b)[:700]}"
    return ""
