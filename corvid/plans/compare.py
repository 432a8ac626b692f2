"""Order-insensitive comparison of two result frames (pandas).

Used by the tests and ``tools/check_oracle.py`` to hold a Spark result
against its DuckDB oracle: same column names, same row count, and the same
multiset of rows after sorting columns by name and rounding floats.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd

from corvid.sources.tables import TABLES


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int):
    if v is None:
        return None
    if isinstance(v, float | np.floating):
        if math.isnan(v):
            return "nan"
        return round(float(v), digits)
    if isinstance(v, np.integer):
        return int(v)
    if isinstance(v, list | tuple | np.ndarray):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    if v is pd.NaT:
        return None
    return v


def frame_rows(df: pd.DataFrame, digits: int = 9) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c], digits) for c in cols) for r in df[cols].to_dict("records")]
    return sorted(rows, key=repr)


def frame_hash(df: pd.DataFrame, digits: int = 9) -> str:
    return hashlib.sha256(repr(frame_rows(df, digits)).encode()).hexdigest()[:16]


def compare_frames(a: pd.DataFrame, b: pd.DataFrame, digits: int = 9) -> tuple[bool, str]:
    if sorted(a.columns) != sorted(b.columns):
        return False, f"columns differ: {sorted(a.columns)} vs {sorted(b.columns)}"
    if len(a) != len(b):
        return False, f"row counts differ: {len(a)} vs {len(b)}"
    ra, rb = frame_rows(a, digits), frame_rows(b, digits)
    if ra != rb:
        diff = [(x, y) for x, y in zip(ra, rb) if x != y][:3]
        return False, f"values differ, e.g. {diff}"
    return True, f"hash={frame_hash(a, digits)}"
