"""Compare a query with its SQL twin, row by row."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].astype(object).where(lambda d: d.notna(), None)
    rows = sorted(df.itertuples(index=False, name=None), key=lambda r: tuple((v is None, str(v)) for v in r))
    return pd.DataFrame(rows, columns=df.columns, dtype=object)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """What differs, or None. Values are compared exactly."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} and {len(want)} rows"
    a, b = canonical(got), canonical(want)
    for c in a.columns:
        same = [x == y for x, y in zip(a[c], b[c])]
        if not all(same):
            at = same.index(False)
            return f"{same.count(False)} values of {c}, first {a.iloc[at].to_dict()} and {b.iloc[at].to_dict()}"
    return None
