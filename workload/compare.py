"""Compare a query's rows with those of its SQL, in any order."""

from pathlib import Path

import duckdb
import pandas as pd

from workload.registry import QUERIES, SQL


def _rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(_plain(v) for v in row) for row in frame.itertuples(index=False)]
    return sorted(rows, key=repr)


def _plain(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return None
    if hasattr(v, "date") and callable(v.date):
        return v.date()
    if hasattr(v, "item"):
        v = v.item()
    return v + 0.0 if isinstance(v, float) else v


def database(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        db.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return db


def spark_rows(spark, folder: str, name: str) -> pd.DataFrame:
    df = QUERIES[name](spark, folder)
    return pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object)


def sql_rows(db: duckdb.DuckDBPyConnection, name: str) -> pd.DataFrame:
    cursor = db.execute(SQL[name])
    return pd.DataFrame(cursor.fetchall(), columns=[c[0] for c in cursor.description], dtype=object)


def difference(mine: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """What differs, or nothing."""
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} and {sorted(theirs.columns)}"
    a, b = _rows(mine), _rows(theirs)
    if a == b:
        return None
    pairs = [(x, y) for x, y in zip(a, b) if x != y][:3]
    return f"rows {len(a)} and {len(b)}, {sorted(mine.columns)}: {pairs}"
