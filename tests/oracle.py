"""Hold a query's rows against DuckDB's."""

import math
from pathlib import Path

import duckdb


def connect(sf_dir):
    db = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        where = f"{path}/*.parquet" if path.is_dir() else str(path)
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{where}'")
    return db


def value(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6) + 0.0
    return x


def differences(df, db, sql, n=3):
    """[] if names and rows agree, else what differs."""
    names = sorted(df.columns)
    mine = sorted((tuple(value(r[c]) for c in names) for r in df.collect()), key=repr)
    result = db.execute(sql)
    theirs_names = [d[0] for d in result.description]
    if sorted(theirs_names) != names:
        return [names, theirs_names]
    at = [theirs_names.index(c) for c in names]
    theirs = sorted((tuple(value(r[i]) for i in at) for r in result.fetchall()), key=repr)
    if mine == theirs:
        return []
    return [len(mine), len(theirs), *[(a, b) for a, b in zip(mine, theirs) if a != b][:n]]
