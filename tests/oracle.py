"""Compare a registered query with its SQL check in DuckDB."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def differences(spark_frame, con, text: str) -> str | None:
    """None when columns, row count, Python types and values agree; else a short description."""
    result = con.execute(text)
    names = [d[0] for d in result.description]
    if sorted(spark_frame.columns) != sorted(names):
        return f"columns {sorted(spark_frame.columns)} != {sorted(names)}"
    order = sorted(names)
    want = sorted((repr(tuple(row[names.index(c)] for c in order)) for row in result.fetchall()))
    got = sorted((repr(tuple(row[c] for c in order)) for row in spark_frame.collect()))
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    unlike = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(unlike)} of {len(got)} rows differ, first {order}: {unlike[0]}" if unlike else None
