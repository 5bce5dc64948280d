"""Strict comparison of a registered query with its SQL."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return f"{type(value).__name__}:{value}"


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=str)


def compare(df, con, sql: str) -> list[str]:
    """Differences found; empty when both sides agree."""
    got_names = df.columns
    got = df.collect()
    cursor = con.execute(sql)
    want_names = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    if sorted(got_names) != sorted(want_names):
        return [f"columns {sorted(got_names)} != {sorted(want_names)}"]
    if len(got) != len(want):
        return [f"rows {len(got)} != {len(want)}"]
    if not got:
        return ["no rows"]
    left, right = _rows(got_names, got), _rows(want_names, want)
    differences = [(a, b) for a, b in zip(left, right, strict=True) if a != b]
    return [f"{len(differences)} rows differ, first: {a} != {b}" for a, b in differences[:1]]
