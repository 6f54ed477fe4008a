"""Compares a query's rows with DuckDB's rows of its SQL."""

from __future__ import annotations

import os

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(p := f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def rows(df) -> list[tuple]:
    import pandas as pd

    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "~"
        return f"{v:.6g}" if isinstance(v, float) else str(v)

    df = df[sorted(df.columns)]
    return sorted(tuple(map(plain, r)) for r in df.itertuples(index=False))
